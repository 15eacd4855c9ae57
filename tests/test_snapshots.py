"""A load of several tables is seen whole or not at all."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql.readwriter import DataFrameWriter

from tripflow import files
from tripflow.operators import snapshots as snap
from tripflow.plans import pipeline
from tripflow.plans.pipeline import build_facts
from tripflow.plans.trips import raw_trips, taxi_trips
from tripflow.sources import raw as rawsrc

RUN = "2024-01-15"


class Died(Exception):
    pass


def load(spark, root, trips, run_date=RUN):
    one = snap.Load(spark, root)
    one.write("taxi_trips", trips)
    for name, fact in build_facts(one.read("taxi_trips")).items():
        one.write(name, fact)
    version = one.commit([run_date])
    snap.vacuum(spark, root)
    return version


def state(spark, root, version=None):
    """Trips per date of each table; all four must agree."""
    t = snap.read(spark, root, version=version)
    n = {"taxi_trips": F.count(F.lit(1)), "agg_by_zone": F.sum("total_trips"), "agg_by_hour": F.sum("trip_count"),
         "agg_payment": F.sum("trips")}
    got = [{r[0]: r[1] for r in t[name].groupBy("pickup_date").agg(n[name]).collect()} for name in n]
    assert got[0] == got[1] == got[2] == got[3]
    return got[0]


def two_days(spark, sf0001):
    trips = taxi_trips(spark, sf0001)
    day = trips.where(F.col("pickup_date") == F.lit(RUN).cast("date"))
    both = trips.where(F.col("pickup_date").isin([F.lit(x).cast("date") for x in (RUN, "2024-01-16")]))
    return both, day.limit(20)


def test_load_reload_clear_and_versions(spark, sf0001, tmp_path):
    root, (both, some) = str(tmp_path / "lake"), two_days(spark, sf0001)
    assert all(df.isEmpty() for df in snap.read(spark, root).values())
    load(spark, root, both)
    first = state(spark, root)
    assert len(first) == 2 and sum(first.values()) == both.count()
    one = snap.Load(spark, root)
    one.write("taxi_trips", some)
    for name, fact in build_facts(some).items():
        one.write(name, fact)
    assert one.commit([RUN]) == 2
    second = state(spark, root)
    assert sorted(second.values())[0] == 20 and len(second) == 2
    assert state(spark, root, version=1) == first  # until vacuum
    before = snap.read(spark, root)["taxi_trips"]
    assert load(spark, root, some.limit(0), "2024-01-16") == 3
    assert list(state(spark, root).values()) == [20]
    assert snap.versions(spark, root) == [3]
    with pytest.raises(Exception):  # its files are gone: an error, not other rows
        before.collect()
    rows = {(r["table"], r["rows"]) for r in snap.manifest(spark, root).collect()}
    assert ("taxi_trips", 20) in rows


def test_null_dates_are_a_date(spark, sf0001, tmp_path):
    root, (both, some) = str(tmp_path / "lake"), two_days(spark, sf0001)
    undated = some.withColumn("pickup_date", F.lit(None).cast("date"))
    load(spark, root, both.unionByName(undated))
    assert state(spark, root)[None] == 20
    load(spark, root, undated.limit(7))
    assert state(spark, root)[None] == 7 and len(state(spark, root)) == 2  # the run date is cleared


def test_a_load_that_dies_leaves_the_old_or_the_new_state(spark, sf0001, tmp_path, monkeypatch):
    root, (both, some) = str(tmp_path / "lake"), two_days(spark, sf0001)
    load(spark, root, both)
    old = state(spark, root)
    steps = [0, -1]

    def dying(method):
        def call(*args, **kw):
            steps[0] += 1
            if steps[0] == steps[1]:  # after the step before, in front of this one
                raise Died
            return method(*args, **kw)
        return call

    for owner, name in ((DataFrameWriter, "parquet"), (DataFrameWriter, "json"), (files, "delete")):
        monkeypatch.setattr(owner, name, dying(getattr(owner, name)))
    seen = []
    for step in (*range(1, 8), 10, 99):  # four tables, the manifest, then removals
        steps[:] = [0, step]
        try:
            load(spark, root, some)
        except Died:
            steps[1] = -1
            seen.append(sorted(state(spark, root).values()))
            if seen[-1] != sorted(old.values()):
                load(spark, root, both)  # back to the old state for the next step
                assert state(spark, root) == old
    assert steps[0] < 99  # the last one ran to its end
    assert seen[:4] == [sorted(old.values())] * 4  # while the tables are written
    new = sorted(state(spark, root).values())
    assert all(s in (sorted(old.values()), new) for s in seen) and new in seen
    assert new[0] == 20


def test_one_writer_of_a_version(spark, sf0001, tmp_path, monkeypatch):
    root, (both, some) = str(tmp_path / "lake"), two_days(spark, sf0001)
    load(spark, root, both)
    old = state(spark, root)
    late = snap.Load(spark, root)
    late.write("taxi_trips", some)
    have = files.matching(spark, f"{root}/_manifests/v=*")
    have_marks = files.matching(spark, f"{root}/_manifests/v=*/_SUCCESS")
    load(spark, root, both)
    monkeypatch.setattr(files, "matching", lambda s, p: have_marks if p.endswith("_SUCCESS") else have)
    with pytest.raises(AnalysisException):
        late.commit([RUN])
    monkeypatch.undo()
    assert state(spark, root) == old


def test_a_failed_run_leaves_the_tables(spark, sf0001, tmp_path, monkeypatch):
    layout = pipeline.Layout(str(tmp_path / "lake"))

    def run():
        with pipeline.audited(spark, RUN, layout) as m:
            pipeline.process(spark, RUN, layout, None, 100, m)
        return m

    day = rawsrc.day_slice(raw_trips(spark, sf0001), RUN)
    rawsrc.write_raw_csv(day, layout.raw, RUN)
    n = run()["loaded_rows"]
    rawsrc.write_raw_csv(day.limit(150), layout.raw, RUN)
    written = snap.Load.write

    def fails(self, name, batch):
        if name == "agg_payment":
            raise Died
        return written(self, name, batch)

    monkeypatch.setattr(snap.Load, "write", fails)
    with pytest.raises(Died):
        run()
    monkeypatch.undo()
    assert sum(state(spark, layout.root).values()) == n
    assert spark.read.parquet(layout.path("pipeline_runs")).where("status = 'failed'").count() == 1
    m = run()
    assert sum(state(spark, layout.root).values()) == m["loaded_rows"] < n
    assert not files.matching(spark, f"{layout.root}/agg_by_hour/load=*/x")
    assert len(files.matching(spark, f"{layout.root}/agg_by_hour/load=*")) == 1  # the lost load is removed

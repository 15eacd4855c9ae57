"""Gates that plans carry, range checks on extreme values, reports read back."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from helpers import trips_df
from tripflow.operators import snapshots as snap
from tripflow.operators import validate as val
from tripflow.operators.clean import row_gate, row_gate_plan
from tripflow.plans import registry
from tripflow.plans.trips import raw_trips, taxi_trips
from tripflow.sources import raw as rawsrc


def findings(df):
    return {(r.check, r.column): r.violation_count for r in val.validate(df).collect()}


def test_ranges_see_huge_and_infinite_text(spark):
    rows = rawsrc.as_text(trips_df(spark, [{}] * 100))
    fares = ["1e13"] * 7 + ["Infinity"] * 5 + ["5000"] * 3 + ["-Infinity"] * 2 + ["NaN", "abc", "", "1000", "1000.01"]
    odd = rawsrc.as_text(trips_df(spark, [{}])).drop("fare_amount").crossJoin(
        spark.createDataFrame([(f,) for f in fares], "fare_amount string")).select(*rows.columns)
    got = findings(rows.unionByName(odd))
    assert got[("max_value", "fare_amount")] == 7 + 5 + 3 + 1
    assert got[("min_value", "fare_amount")] == 2
    people = rows.limit(1).withColumn("passenger_count", F.lit("9.5"))  # a fraction above the bound counts
    assert findings(rows.unionByName(people))[("max_value", "passenger_count")] == 1


def test_verdict_per_date_equals_validating_each_date(spark, sf0001):
    trips = registry._faulty(spark, sf0001)
    day = F.to_date(rawsrc.PICKUP)
    got = {r.run_date: r for r in val.verdicts(trips, day).collect()}
    dates = [d for d in got if d is None or d.day in (3, 15)]
    assert None in dates and len(got) == 32
    for d in dates:
        of = trips.where(day.eqNullSafe(F.lit(d).cast("date")))
        one = val.summary(val.validate(of), "x").first()
        assert (got[d].error_count, got[d].warning_count, got[d].status) == (
            one.error_count, one.warning_count, one.status)
        assert got[d].proceed == (one.status != "FAILED") and got[d].n_rows == of.count()


def test_a_failed_summary_fails_the_write(spark, sf0001, tmp_path):
    root = str(tmp_path / "lake")
    trips = taxi_trips(spark, sf0001).limit(50)
    ok, bad = (val.summary(val.validate(trips_df(spark, rows)), "x") for rows in ([{}] * 100, [{}]))
    load = snap.Load(spark, root)
    load.write("taxi_trips", val.gated(trips, ok))
    load.commit()
    for rows in (trips, trips.limit(0)):  # also with nothing to write
        again = snap.Load(spark, root)
        with pytest.raises(Exception, match="Schema validation FAILED — 1 hard errors"):
            again.write("taxi_trips", val.gated(rows, bad))
    with pytest.raises(Exception, match="FAILED — no hard"):
        val.gated(trips, bad.limit(0)).collect()
    assert snap.read(spark, root)["taxi_trips"].count() == 50


def test_reports_come_back_whole(spark, sf0001, tmp_path):
    for name, rows, status in (("good", [{"tip_amount": float(i)} | {"total_amount": 100.0 + i} for i in range(100)], "PASSED"),
                               ("odd", [{}] * 100 + [{"vendor_id": 6, "fare_amount": -1.0}], "WARNED"),
                               ("few", [{"tpep_pickup_datetime": None}], "FAILED")):
        found = val.validate(trips_df(spark, rows))
        val.write_report(val.report(found, name), str(tmp_path / name))
        back = val.read_reports(spark, str(tmp_path / name))
        one = back.first()
        assert (one.status, one.dataset, one.report_path) == (status, name, str(tmp_path / name))
        assert one.validated_at is not None and one.schema_version == "1.0"
        got = {tuple(r)[4:] for r in val.report_findings(back).collect()}
        want = {tuple(r) for r in found.collect()} or {(None,) * 6}
        assert got == want
    three = val.read_reports(spark, [str(tmp_path / n) for n in ("good", "odd", "few")])
    assert {r.status for r in val.report_findings(three).collect()} == {"PASSED", "WARNED", "FAILED"}


def test_the_row_gate_stops_early(spark, tmp_path):
    path = str(tmp_path / "big")
    spark.range(0, 640_000, numPartitions=64).withColumn("x", F.col("id") * 2).write.parquet(path)
    obs = Observation()
    df = spark.read.option("maxPartitionBytes", 1).parquet(path)
    assert row_gate(df.observe(obs, F.count(F.lit(1)).alias("n")), 100)
    assert obs.get["n"] <= 10_000  # one of 64 files
    assert not row_gate(df, 640_001) and row_gate(df, 640_000)
    assert not row_gate(df.limit(0), 1) and row_gate(df.limit(0), 0)
    assert tuple(row_gate_plan(df, 100).first()) == (100, True)
    assert tuple(row_gate_plan(df.where("id < 7"), 100).first()) == (7, False)


def test_day_slice_reads_one_partition(spark, sf0001):
    plan = registry.queries()["day_slice"](spark, sf0001)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(staged_day" in plan
    assert "staged_day" not in raw_trips(spark, sf0001).columns

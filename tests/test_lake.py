"""The raw CSV layer, the choice of sources and the catalog tables."""

import pytest
from pyspark.sql import functions as F

from tripflow.contract import TRIP_CONTRACT
from tripflow.functions.guards import has_rows, require
from tripflow.plans import lake, pipeline, registry, report_sql
from tripflow.plans.trips import raw_trips
from tripflow.sources import raw as rawsrc

from helpers import trips_df

RUN = "2024-01-15"


def test_broken_lines_go_to_the_dead_letter(spark, sf0001, tmp_path):
    layout = pipeline.Layout(str(tmp_path / "lake"))
    day = rawsrc.day_slice(raw_trips(spark, sf0001), RUN)
    rawsrc.write_raw_csv(day, layout.raw, RUN)
    plain = day.count()
    header = ",".join(TRIP_CONTRACT.column_names)
    full = "1,2024-01-15 10:00:00,2024-01-15 10:20:00,1,3.0,1,15.0,3.0,20.0,1,1,2"
    quoted = '"1","2024-01-15 11:00:00","2024-01-15 11:20:00","1","3.0","1","15.0","3.0","20.0","1","1","2"'
    short, long = full.rsplit(",", 3)[0], full + ",extra"
    (tmp_path / "lake" / "raw" / f"run_date={RUN}" / "part-x.csv").write_text(
        "\n".join([header, full, quoted, short, long, "", "junk", '1,"2024', ""]))
    with pipeline.audited(spark, RUN, layout) as m:
        pipeline.process(spark, RUN, layout, None, 100, m)
    dead = spark.read.parquet(layout.path("dead_letter"))
    broken = dead.where(F.array_contains("reject_reasons", "corrupt_line"))
    assert sorted(r.raw_line for r in broken.collect()) == sorted([short, long, "junk", '1,"2024'])
    assert broken.where("fare_amount is not null or vendor_id is not null").isEmpty()
    assert m["corrupt_row_count"] == 4 and m["raw_row_count"] == plain + 2 + 4
    assert dead.count() + m["loaded_rows"] == m["raw_row_count"]
    trips = pipeline.read_tables(spark, layout)["taxi_trips"]
    assert trips.where("trip_distance = 3.0 and fare_amount = 15.0 and total_amount = 20.0").count() >= 2


def test_scan_keeps_every_line(spark, sf0001):
    got = lake.raw_csv_scan(spark, sf0001)
    trips = raw_trips(spark, sf0001)
    assert got.count() == trips.count()
    by = {r["n_fields"]: r["count"] for r in got.groupBy("n_fields").count().collect()}
    assert set(by) == {None, 9, 14}
    good = got.where(~F.col("corrupt")).select(*TRIP_CONTRACT.column_names)
    assert good.exceptAll(trips).isEmpty() and by[None] == good.count()


def test_ingest_plan_takes_one_branch(spark):
    real, other = trips_df(spark, [{"vendor_id": 1}, {"vendor_id": 1}]), trips_df(spark, [{"vendor_id": 2}])
    tags = lambda df: sorted((r.source, r.vendor_id) for r in df.collect())
    assert tags(rawsrc.ingest_plan(real, other)) == [("real", 1)] * 2
    assert tags(rawsrc.ingest_plan(real.limit(0), other)) == [("synthetic", 2)]
    assert tags(rawsrc.ingest_plan(real, other.limit(0))) == [("real", 1)] * 2
    with pytest.raises(Exception, match="Ingestion produced 0 rows"):
        rawsrc.ingest_plan(real.limit(0), other.limit(0)).collect()
    with pytest.raises(Exception, match="Ingestion produced 0 rows"):
        rawsrc.ingest_dates(real.limit(0), other.limit(0)).write.format("noop").mode("overwrite").save()


def test_require_adds_nothing_and_fails_in_the_write(spark):
    df = spark.createDataFrame([(1, ["a"], {"k": 2.0}), (2, None, None)], "a int, b array<string>, c map<string,double>")
    assert require(df, F.lit(True), "x").collect() == df.collect()
    assert require(df, has_rows(df.where("a = 2")), "x").count() == 2
    for bad in (F.lit(False), F.lit(None).cast("boolean"), has_rows(df.where("a = 3"))):
        with pytest.raises(Exception, match="no go"):
            require(df, bad, "no go").write.format("noop").mode("overwrite").save()
        with pytest.raises(Exception, match="no go"):
            require(df.limit(0), bad, "no go").collect()


def test_sources_per_date(spark, sf0001):
    got = {(r.run_date.isoformat(), r.source) for r in lake.source_choice(spark, sf0001).collect()}
    assert {s for d, s in got if d <= "2024-01-31"} == {"real"} and ("2024-01-20", "real") in got
    assert {d for d, s in got if s == "synthetic"} == {f"2024-02-{i:02d}" for i in range(1, 9)}


def test_ddl_keeps_rows_and_load_replaces_dates(spark, sf0001):
    database = lake.catalog(spark, sf0001)
    count = lambda: spark.sql(f"SELECT count(*) FROM `{database}`.taxi_trips").first()[0]
    n = count()
    assert n > 0
    assert lake.catalog(spark, sf0001) == database and count() == n
    spark.sql(report_sql.ddl("taxi_trips", database, "/nowhere"))
    assert count() == n
    day = spark.table(f"`{database}`.taxi_trips").where(F.col("pickup_date") == F.lit(RUN).cast("date"))
    assert spark.sql(f"SHOW PARTITIONS `{database}`.taxi_trips").count() == 31
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_date" in plan
    kept = spark.createDataFrame(day.collect(), day.schema)
    report_sql.load(kept, database, "taxi_trips")
    assert count() == n


@pytest.mark.parametrize("name", sorted(report_sql.REPORTS))
def test_sql_reports_equal_the_plans(spark, sf0001, name):
    q = registry.queries()
    assert q[f"sql_{name}"](spark, sf0001).collect() == q[name](spark, sf0001).collect()

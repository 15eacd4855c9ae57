import datetime as dt

from pyspark.sql import functions as F

from tripflow.operators import audit as aud
from tripflow.operators import tables as tbl
from tripflow.plans.trips import taxi_trips

RUN = "2024-01-15"


def test_reload_twice_is_once(spark, sf0001):
    trips = taxi_trips(spark, sf0001)
    batch = trips.where(F.col("pickup_date") == F.lit(RUN).cast("date"))
    once = tbl.reload(trips, batch, RUN)
    twice = tbl.reload(once, batch, RUN)
    doubled = tbl.reload(trips.unionByName(batch), batch, RUN)
    n = trips.count()
    assert once.count() == twice.count() == doubled.count() == n
    assert tbl.load_counts(doubled, RUN).first().loaded_rows == batch.count()


def test_empty_batch_clears_run_date_other_dates_stay(spark, sf0001):
    trips = taxi_trips(spark, sf0001)
    empty = trips.limit(0)
    out = tbl.reload(trips, empty, RUN)
    assert out.where(F.col("pickup_date") == F.lit(RUN).cast("date")).count() == 0
    assert out.count() == trips.where(F.col("pickup_date") != F.lit(RUN).cast("date")).count()


def test_batch_holding_another_date_replaces_it(spark, sf0001):
    trips = taxi_trips(spark, sf0001)
    other = trips.where(F.col("pickup_date") == F.lit("2024-01-03").cast("date"))
    out = tbl.reload(trips.unionByName(other), other, RUN)
    # both 01-03 (in batch) and the run date are replaced
    assert out.where(F.col("pickup_date") == F.lit("2024-01-03").cast("date")).count() == other.count()
    assert out.where(F.col("pickup_date") == F.lit(RUN).cast("date")).count() == 0


def test_file_reload_partitions(spark, sf0001, tmp_path):
    path = str(tmp_path / "taxi_trips")
    trips = taxi_trips(spark, sf0001)
    n = tbl.write_table(trips, path, ["pickup_date"])
    assert n == trips.count()
    batch = trips.where(F.col("pickup_date") == F.lit(RUN).cast("date"))
    for _ in range(2):
        tbl.reload_partitions(spark, batch, path, RUN)
    assert spark.read.parquet(path).count() == n
    tbl.reload_partitions(spark, batch.limit(0), path, RUN)
    left = spark.read.parquet(path)
    assert left.where(F.col("pickup_date") == F.lit(RUN).cast("date")).count() == 0
    assert left.count() == n - batch.count()


def test_init_table_and_schema(spark, tmp_path):
    path = str(tmp_path / "agg_by_hour")
    tbl.init_table(spark, "agg_by_hour", path)
    tbl.init_table(spark, "agg_by_hour", path)
    df = spark.read.parquet(path)
    assert df.count() == 0 and df.columns[:3] == ["pickup_date", "pickup_hour", "time_of_day"]


def test_audit_latest_and_fresh_dates(spark, tmp_path):
    path = str(tmp_path / "runs")
    t0 = dt.datetime(2024, 1, 15, 1)
    for i, status in enumerate(["failed", "success"]):
        aud.append_audit(aud.audit_record(spark, "run_20240115", RUN, t0, t0 + dt.timedelta(hours=i + 1),
                                          100, 90 * i, "WARNED", status), path)
    aud.append_audit(aud.audit_record(spark, "run_20240116", "2024-01-16", t0, t0, 5, 0,
                                      "FAILED", "failed"), path)
    audit = spark.read.parquet(path)
    latest = {r.run_id: r for r in aud.audit_latest(audit).collect()}
    assert latest["run_20240115"].status == "success" and latest["run_20240115"].clean_row_count == 90
    dates = spark.createDataFrame([(dt.date(2024, 1, 15),), (dt.date(2024, 1, 16),)], "run_date date")
    assert [r.run_date for r in aud.fresh_dates(dates, audit).collect()] == [dt.date(2024, 1, 16)]


def test_reload_keeps_null_dates_apart(spark):
    day = dt.date(2024, 1, 15)
    table = lambda rows: spark.createDataFrame(rows, "pickup_date date, v int")
    existing = table([(day, 1), (dt.date(2024, 1, 14), 2), (None, 3)])
    kept = lambda batch: sorted(r["v"] for r in tbl.reload(existing, table(batch), RUN).collect())
    assert kept([(day, 9)]) == [2, 3, 9]
    assert kept([(None, 9)]) == [2, 9]
    assert kept([]) == [2, 3]

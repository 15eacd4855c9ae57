import os
import shutil

from pyspark.sql import functions as F

from tripflow.operators import snapshots as snap
from tripflow.plans import lake, trips
from tripflow.plans import staged as stg
from tripflow.sources.fixture import spread


def test_staged_builds_once_and_reads_back(spark, tmp_path):
    src = str(tmp_path / "src")
    spark.range(1000).withColumn("d", F.expr("date_add(DATE'2024-01-01', CAST(id % 3 AS INT))")) \
        .write.parquet(src)
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(src).withColumn("x", F.col("id") * 2)

    a = stg.staged(spark, "t_test", build, [src], partition_by=["d"], cluster_by=["id"])
    b = stg.staged(spark, "t_test", build, [src], partition_by=["d"], cluster_by=["id"])
    assert len(calls) == 1
    assert a.count() == b.count() == 1000
    assert a.agg(F.sum("x")).first()[0] == 2 * sum(range(1000))
    # a changed input builds a new table
    spark.range(10).withColumn("d", F.lit("2024-01-01").cast("date")).write.mode("append").parquet(src)
    c = stg.staged(spark, "t_test", build, [src], partition_by=["d"])
    assert len(calls) == 2 and c.count() == 1010
    # no private build directories are left behind
    root = spark.conf.get("spark.checkpoint.dir")
    left = [p for p in os.listdir(f"{root}/tripflow-staged") if ".tmp-" in p]
    assert left == []


def test_spread_only_narrow_inputs(spark):
    narrow = spark.range(0, 100, 1, 1)
    assert spread(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 100, 1, spark.sparkContext.defaultParallelism * 2)
    assert spread(wide).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism * 2


def test_staged_write_splits_a_hot_date(spark, tmp_path):
    """A date holding a third of all rows is written by several tasks (AQE
    splits the rebalanced partition), and no row is lost or repeated."""
    src = str(tmp_path / "hot")
    (spark.range(0, 90000, 1, 8)
     .withColumn("d", F.expr("CASE WHEN id % 3 = 0 THEN DATE'2024-01-15' "
                             "ELSE date_add(DATE'2024-01-01', CAST(id % 10 AS INT)) END"))
     .withColumn("pad", F.sha2(F.col("id").cast("string"), 256))
     .write.parquet(src))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        out = stg.staged(spark, f"t_hot_{os.getpid()}_{id(tmp_path)}",
                         lambda: spark.read.parquet(src), [src], partition_by=["d"],
                         cluster_by=["id"])
    finally:
        spark.conf.set(key, old)
    hot_files = [f for f in out.inputFiles() if "d=2024-01-15" in f]
    assert len(hot_files) > 1
    assert out.count() == 90000 and out.select("id").distinct().count() == 90000


def test_version_tag_replaces_the_listing(spark, tmp_path):
    """With a version tag the signature ignores the files; a new tag (a new
    input snapshot) builds a new table."""
    src = str(tmp_path / "v")
    spark.range(10).write.parquet(src)
    calls = []

    def build():
        calls.append(1)
        return spark.read.parquet(src)

    name = f"t_ver_{os.getpid()}_{id(tmp_path)}"
    stg.staged(spark, name, build, [src], version="snap-1")
    spark.range(20).write.mode("append").parquet(src)
    assert stg.staged(spark, name, build, [src], version="snap-1").count() == 10
    assert stg.staged(spark, name, build, [src], version="snap-2").count() == 30
    assert len(calls) == 2


def test_what_lies_by_date_is_not_shuffled_again(spark, sf0001, tmp_path):
    """The trips table is written from the raw trips, and copied, in jobs of one
    stage: the raw trips lie by the same date."""
    for t in (*trips.TRIP_INPUTS, *trips.ZONE_INPUTS):  # a new input, so a new table
        shutil.copy(f"{sf0001}/{t}.parquet", tmp_path)
    d = str(tmp_path)
    trips.raw_trips(spark, d), trips.zones(spark, d)
    spark.sparkContext.setJobGroup("laid-out", "one stage each")
    try:
        table = trips.taxi_trips(spark, d)
        load = snap.Load(spark, f"{d}/lake")
        n = load.write("taxi_trips", table, laid_out=True)
    finally:
        spark.sparkContext.setJobGroup("other", "")
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("laid-out")]
    assert jobs and all(len(j.stageIds) == 1 for j in jobs)
    want = trips.build_taxi_trips(spark, d)
    assert n == want.count()
    for got in (table.select(*want.columns), load.read("taxi_trips").select(*want.columns)):
        assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_buckets_grow_with_the_trips(spark, sf0001, tmp_path, monkeypatch):
    for t in (*trips.TRIP_INPUTS, *trips.ZONE_INPUTS):
        shutil.copy(f"{sf0001}/{t}.parquet", tmp_path)
    monkeypatch.setattr(lake, "BUCKET_ROWS", 400)
    got = lake.zone_join_bucketed(spark, str(tmp_path), buckets=4)
    assert got.count() == trips.build_taxi_trips(spark, str(tmp_path)).count()
    table = f"`{lake.catalog(spark, str(tmp_path))}`.`trips_by_pickup`"
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    assert described["Num Buckets"] == "15"  # of 6,000 trips

"""Plan shapes that must hold at any scale, for every registered query.

* no cartesian product and no nested-loop join (a one-row statistic is a
  scalar subquery, not a join);
* no window fed by a single-partition exchange (a grand total is a scalar
  subquery, never a window that gathers every row into one task);
* the queries read only the columns they use (trips table and daily facts).
"""
import contextlib
import io
import re

import pytest

import __spark_entry__ as entry
from tripflow.plans import registry

SF = "/root/testdata/sf0.001"
KEYS = sorted(registry.queries())  # the text operators have tests of their own


def physical_plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


@pytest.mark.parametrize("key", KEYS)
def test_no_pairs_and_no_single_task_window(spark, key):
    plan = physical_plan(entry.queries()[key](spark, SF))
    assert "CartesianProduct" not in plan
    assert "NestedLoopJoin" not in plan
    lines = [ln.strip(" :+-") for ln in plan.splitlines() if ln.strip()]
    for above, below in zip(lines, lines[1:]):
        if above.startswith("Window ["):
            assert "SinglePartition" not in below, f"{key}: unpartitioned window"


@pytest.mark.parametrize("key,cols", [
    # trips table
    ("agg_by_hour", {"pickup_date", "pickup_hour", "time_of_day", "fare_amount",
                     "passenger_count"}),
    ("top_hours", {"pickup_hour", "fare_amount", "pickup_date"}),
    # staged daily facts (avg_passengers is not read)
    ("hourly_heatmap", {"pickup_hour", "time_of_day", "trip_count", "avg_fare"}),
])
def test_trips_scan_is_pruned(spark, key, cols):
    plan = physical_plan(entry.queries()[key](spark, SF))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas
    for s in schemas:
        read = {f.split(":")[0] for f in s.split(",") if f}
        assert read <= cols, (key, read - cols)


def test_run_date_query_reads_one_partition(spark):
    plan = physical_plan(entry.queries()["health_for_date"](spark, SF))
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_date", plan)


def test_zone_dimension_is_broadcast_once(spark):
    """Both role-playing joins use one dimension plan: after execution the
    second broadcast is a reused exchange, and no join shuffles the trips."""
    df = entry.queries()["zone_join"](spark, SF)
    df.collect()
    plan = physical_plan(df)
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and "BroadcastHashJoin" in final
    assert "SortMergeJoin" not in final


def test_strict_filter_reaches_the_scan(spark):
    """The strict profile's range, IN and NOT NULL predicates are Parquet
    pushed filters on the staged raw table (row groups can be skipped)."""
    key = "spark.sql.maxMetadataStringLength"  # explain truncates long lists
    old = spark.conf.get(key)
    spark.conf.set(key, "4000")
    try:
        plan = physical_plan(entry.queries()["filter_strict"](spark, SF))
    finally:
        spark.conf.set(key, old)
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", plan).group(1)
    for f in ("GreaterThanOrEqual(trip_distance,0.01)", "LessThanOrEqual(trip_distance,500.0)",
              "GreaterThanOrEqual(fare_amount,0.0)", "LessThanOrEqual(fare_amount,1000.0)",
              "GreaterThanOrEqual(total_amount,0.0)", "In(vendor_id, [1,2])",
              "IsNotNull(tpep_dropoff_datetime)"):
        assert f in pushed, f


@pytest.mark.parametrize("hot_id", [1, None])
def test_hot_location_splits_in_the_shuffled_zone_join(spark, hot_id):
    """Past the broadcast bound the zone joins are sort-merge joins; a pickup
    id (or NULL) holding a third of all trips is split over several tasks by
    AQE's skew join, and the result equals the broadcast path."""
    from pyspark.sql import functions as F

    from tripflow.operators.zones import join_zones
    from tripflow.plans.trips import raw_trips, zones

    trips = raw_trips(spark, SF)
    hot = trips.withColumn("pickup_location_id", F.when(
        F.xxhash64("tpep_pickup_datetime", "fare_amount") % 3 == 0,
        F.lit(hot_id).cast("int"))
        .otherwise(F.col("pickup_location_id")))
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
             "spark.sql.shuffle.partitions": "8"}
    old = {k: spark.conf.get(k) for k in confs}
    try:
        for k, v in confs.items():
            spark.conf.set(k, v)
        shuffled = join_zones(hot, zones(spark, SF), max_broadcast_rows=0)
        rows = shuffled.collect()
        final = physical_plan(shuffled).split("== Initial Plan ==")[0]
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert "SortMergeJoin" in final and "skew=true" in final
    expect = join_zones(hot, zones(spark, SF)).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, expect))

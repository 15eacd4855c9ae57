"""Salted and bucketed joins of a dimension of any size."""

from pyspark.sql import functions as F

from tripflow.contract import STRICT
from tripflow.operators import dimension as dim
from tripflow.operators.zones import join_zones
from tripflow.plans import lake
from tripflow.plans.trips import featured_trips, zones


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def skewed(spark, sf0001):
    """A third of all trips from one location, many from none, and a dimension
    with a duplicated and a NULL id."""
    trips = featured_trips(spark, sf0001, STRICT)
    n = F.pmod(F.xxhash64("tpep_pickup_datetime", "trip_distance"), F.lit(9))
    at = F.when(n < 3, 5).when(n < 5, F.lit(None)).otherwise(F.col("pickup_location_id"))
    dup = spark.createDataFrame([(5, "again", "B"), (None, "none", "B"), (5, "again", "B")],
                                "location_id int, zone_name string, borough string")
    return trips.withColumn("pickup_location_id", at.cast("int")), zones(spark, sf0001).unionByName(dup)


def test_same_rows_as_the_broadcast_join(spark, sf0001):
    trips, z = skewed(spark, sf0001)
    want = join_zones(trips, z, dedupe=True)
    got = dim.join_large(trips, z, salts=4, share=0.05)
    assert got.columns == want.columns
    assert got.count() == trips.count()
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_hot_keys_are_few_and_spread(spark, sf0001):
    trips, _ = skewed(spark, sf0001)
    hot = dim.hot_keys(trips, "pickup_location_id", 0.2)
    assert [r[0] for r in hot.collect()] == [5]
    assert dim.hot_keys(trips, "pickup_location_id", 0.01).count() <= 100
    by = dim.salted(trips, "pickup_location_id", hot, 8).groupBy("pickup_location_id", dim.SALT).count().collect()
    largest = max(r["count"] for r in by)
    n = trips.count()
    assert largest < n / 12 and {r[dim.SALT] for r in by if r[0] is None} == set(range(8))
    assert all(r[dim.SALT] == 0 for r in by if r[0] not in (5, None))


def test_empty_sides(spark, sf0001):
    trips, z = skewed(spark, sf0001)
    assert dim.join_large(trips.limit(0), z).isEmpty()
    alone = dim.join_large(trips, z.limit(0))
    assert alone.count() == trips.count() and alone.where("pickup_zone is not null").isEmpty()


def test_bucketed_tables_meet_without_an_exchange(spark, sf0001):
    trips, z = skewed(spark, sf0001)
    spark.sql("CREATE DATABASE IF NOT EXISTS buckets_test")
    key = "pickup_location_id"
    hot = dim.hot_keys(trips, key, 0.2)
    root = lake.folder(spark, "buckets")
    left = dim.store_bucketed(dim.salted(trips, key, hot), "buckets_test.t", [key, dim.SALT], 4, f"{root}/t")
    right = dim.store_bucketed(dim.replicated(dim.role(z, "pickup"), key, hot), "buckets_test.z", [key, dim.SALT], 4, f"{root}/z")
    joined = dim.join_salted(left, right.hint("merge"), key)
    plan = plan_of(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.count() == trips.count()
    want = {(r[key], r.pickup_zone) for r in join_zones(trips, z, dedupe=True).select(key, "pickup_zone").distinct().collect()}
    assert {(r[key], r.pickup_zone) for r in joined.select(key, "pickup_zone").distinct().collect()} == want
    spark.sql("DROP DATABASE buckets_test CASCADE")


def test_no_job_chooses_the_plan(spark, sf0001):
    trips, z = skewed(spark, sf0001)
    group = "dimension-plan"
    spark.sparkContext.setJobGroup(group, "build only")
    dim.join_large(trips, z)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(group) == []
    spark.sparkContext.setJobGroup("other", "")

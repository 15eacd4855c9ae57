"""Daily facts.

Each is one ``groupBy().agg()``: Spark runs a partial aggregate before the
shuffle, so only one row per (partition, group) crosses the network and a
hot group is pre-combined on the map side.  Averages use the exact
integer-unit helpers, so results do not depend on partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripflow.operators.clean import is_clean
from tripflow.functions.exact import avg_fixed, avg_ratio, pct, sum_fixed



def zone_aggregates(trips: DataFrame) -> DataFrame:
    """Per pickup date, zone, borough (strict, zone-joined trips)."""
    return trips.groupBy("pickup_date", "pickup_zone", "pickup_borough").agg(
        F.count(F.lit(1)).alias("total_trips"),
        avg_fixed("fare_amount", 2, 2).alias("avg_fare"),
        avg_ratio("tip_pct", 2).alias("avg_tip_pct"),
        avg_ratio("trip_distance", 2).alias("avg_distance_mi"),
        avg_ratio("trip_duration_min", 1).alias("avg_duration_min"),
        avg_ratio("avg_speed_mph", 1).alias("avg_speed_mph"),
        sum_fixed("total_amount", 2).alias("total_revenue"),
    )


def hourly_demand(trips: DataFrame) -> DataFrame:
    """Per pickup date, hour, time of day."""
    return trips.groupBy("pickup_date", "pickup_hour", "time_of_day").agg(
        F.count(F.lit(1)).alias("trip_count"),
        avg_fixed("fare_amount", 2, 2).alias("avg_fare"),
        avg_fixed("passenger_count", 0, 1).alias("avg_passengers"),
    )


def payment_breakdown(trips: DataFrame, within: str | None = None) -> DataFrame:
    """Per pickup date and payment label, with the share of all trips.

    ``within=None`` divides by the count of every date (the reference's
    meaning); ``within="pickup_date"`` divides by that date's count.  The
    grand total is a scalar subquery over the daily rows (one value handed
    to every task), never a window that gathers all groups into one
    partition; the per-date total is a window
    partitioned by date over the aggregated rows (five labels per date).
    """
    daily = trips.groupBy("pickup_date", "payment_label").agg(
        F.count(F.lit(1)).alias("trips"),
        avg_ratio("tip_pct", 2).alias("avg_tip_pct"))
    if within:
        total = F.sum("trips").over(Window.partitionBy(within))
    else:
        total = daily.agg(F.sum("trips")).scalar()
    return daily.withColumn("pct_of_total", pct("trips", total, 1))


def location_aggregates_batch(trips: DataFrame) -> DataFrame:
    """Batch profile, per pickup date (string) and location id (NULL kept)."""
    return trips.groupBy("pickup_date", "pickup_location_id").agg(
        F.count("fare_amount").alias("total_trips"),
        avg_fixed("fare_amount", 2, 2).alias("avg_fare"),
        avg_ratio("tip_pct", 2).alias("avg_tip_pct"),
        avg_ratio("trip_distance", 2).alias("avg_distance"),
        avg_ratio("trip_duration_min", 2).alias("avg_duration"),
        sum_fixed("total_amount", 2).alias("total_revenue"),
    )


def hourly_batch(trips: DataFrame) -> DataFrame:
    """E5: batch profile hourly facts, everything rounded to 2."""
    return trips.groupBy("pickup_date", "pickup_hour", "time_of_day").agg(
        F.count("fare_amount").alias("trip_count"),
        avg_fixed("fare_amount", 2, 2).alias("avg_fare"),
        avg_fixed("passenger_count", 0, 2).alias("avg_passengers"),
    )


def transform_summary(featured_raw: DataFrame, profile: str = "batch") -> DataFrame:
    """One pass over the raw rows (with features) -> run metrics.

    Clean-row measures are conditional aggregates, so the raw count and the
    clean measures come from the same scan without a join.
    """
    ok = is_clean(profile)

    def when_ok(c: str):
        return F.when(ok, F.col(c))

    return featured_raw.agg(
        F.count_if(ok).alias("clean_row_count"),
        (F.count(F.lit(1)) - F.count_if(ok)).alias("removed_rows"),
        avg_fixed(when_ok("fare_amount"), 2, 2).alias("avg_fare"),
        avg_ratio(when_ok("trip_distance"), 2).alias("avg_distance_mi"),
        avg_ratio(when_ok("trip_duration_min"), 2).alias("avg_duration_min"),
        F.count_distinct(when_ok("pickup_location_id")).alias("unique_zones"),
    )

"""Business queries over the analytics tables.

The seven report queries read the daily facts (already aggregated, so they
are small), the four run queries read the trips table.  A share divides by
a grand total that is a scalar subquery (a distributed partial/final
aggregate, one value handed to every task), so no step gathers rows into
one partition and nothing is cross-joined.  Top-k queries end in ``orderBy().limit()``,
which Spark runs as a per-partition top-k plus a final merge
(TakeOrderedAndProject), not a global sort.  Ties at the cut are broken by
the grouping columns so the result is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.contract import ANOMALY_SIGMAS
from tripflow.functions.exact import avg_fixed, avg_ratio, fixed_units, pct, round_half_up, sum_fixed
from tripflow.functions.features import distance_bucket



def top_zones(agg_by_zone: DataFrame, k: int = 10) -> DataFrame:
    """G1: pickup zones by trips; revenue summed, fare an average of daily averages."""
    return (agg_by_zone.groupBy("pickup_zone", "pickup_borough").agg(
        F.sum("total_trips").alias("total_trips"),
        sum_fixed("total_revenue", 2).alias("total_revenue"),
        avg_fixed("avg_fare", 2, 2).alias("avg_fare"))
        .orderBy(F.desc("total_trips"), F.asc_nulls_last("pickup_zone"),
                 F.asc_nulls_last("pickup_borough"))
        .limit(k))


def hourly_heatmap(agg_by_hour: DataFrame) -> DataFrame:
    """Trips per hour and their share of all trips (1 decimal)."""
    total = agg_by_hour.agg(F.sum("trip_count")).scalar()
    return (agg_by_hour.groupBy("pickup_hour", "time_of_day").agg(
        F.sum("trip_count").alias("trips"),
        avg_fixed("avg_fare", 2, 2).alias("avg_fare"))
        .withColumn("pct_of_daily_trips", pct("trips", total, 1))
        .orderBy("pickup_hour"))


def payment_share(agg_payment: DataFrame) -> DataFrame:
    """Trips per payment label and market share."""
    total = agg_payment.agg(F.sum("trips")).scalar()
    return (agg_payment.groupBy("payment_label").agg(
        F.sum("trips").alias("total_trips"),
        avg_fixed("avg_tip_pct", 2, 2).alias("avg_tip_pct"))
        .withColumn("market_share_pct", pct("total_trips", total, 1))
        .orderBy(F.desc("total_trips"), "payment_label"))


def borough_leaderboard(agg_by_zone: DataFrame) -> DataFrame:
    """Boroughs by revenue (NULL borough left out)."""
    return (agg_by_zone.where(F.col("pickup_borough").isNotNull())
            .groupBy("pickup_borough").agg(
                F.sum("total_trips").alias("total_trips"),
                sum_fixed("total_revenue", 2).alias("total_revenue"),
                avg_fixed("avg_fare", 2, 2).alias("avg_fare"),
                avg_fixed("avg_distance_mi", 2, 2).alias("avg_distance_mi"),
                avg_fixed("avg_speed_mph", 1, 1).alias("avg_speed_mph"))
            .orderBy(F.desc("total_revenue"), "pickup_borough"))


def distance_split(trips: DataFrame) -> DataFrame:
    """Trips per distance bucket, ordered by the bucket's shortest trip."""
    return (trips.groupBy(distance_bucket().alias("distance_bucket")).agg(
        F.count(F.lit(1)).alias("trips"),
        avg_fixed("fare_amount", 2, 2).alias("avg_fare"),
        avg_ratio("tip_pct", 2).alias("avg_tip_pct"),
        avg_ratio("trip_duration_min", 1).alias("avg_duration_min"),
        F.min("trip_distance").alias("_min_distance"))
        .orderBy(F.asc_nulls_last("_min_distance"))
        .drop("_min_distance"))


def fare_stats(trips: DataFrame) -> DataFrame:
    """One row, mean and sample standard deviation of the fare.

    Computed from exact integer moments of the fare in cents, so the value
    does not depend on the order of additions.
    """
    cents = fixed_units("fare_amount", 2)
    n = F.count("fare_amount").cast("double")
    s1 = F.sum(cents).cast("double")
    s2 = F.sum(cents.cast("decimal(38,0)") * cents.cast("decimal(38,0)")).cast("double")
    var = (s2 - s1 * s1 / n) / F.nullif(n - 1.0, F.lit(0.0))
    return trips.agg((s1 / n / 100.0).alias("mean_fare"),
                     (F.sqrt(var) / 100.0).alias("std_fare"))


def fare_anomalies(trips: DataFrame, k: int = 20, sigmas: float = ANOMALY_SIGMAS) -> DataFrame:
    """Trips whose fare lies more than ``sigmas`` standard deviations
    above the mean, highest fares first.

    The statistics are scalar subqueries (one aggregate job; Catalyst merges
    the two into one), so the trips are filtered in place: no join, no
    shuffle of the trips before the per-partition top-k.
    """
    return anomalies_above(trips, fare_stats(trips), k, sigmas)


def anomalies_above(trips: DataFrame, stats: DataFrame, k: int, sigmas: float) -> DataFrame:
    """G6 for a given mean and standard deviation (one row)."""
    mean, std = stats.select("mean_fare").scalar(), stats.select("std_fare").scalar()
    fare = F.col("fare_amount")
    out = (trips.select("tpep_pickup_datetime", "pickup_zone", "dropoff_zone", "trip_distance",
                        "fare_amount", "total_amount")
           .where(fare > mean + sigmas * std)
           .withColumn("z_score", round_half_up((fare - mean) / std, 2)))
    return out.orderBy(F.desc("fare_amount"), "tpep_pickup_datetime",
                       F.asc_nulls_last("pickup_zone"), F.asc_nulls_last("dropoff_zone"),
                       "trip_distance", "total_amount").limit(k)


def pipeline_health(trips: DataFrame) -> DataFrame:
    """Per pickup date, newest first."""
    return (trips.groupBy("pickup_date").agg(
        F.count(F.lit(1)).alias("row_count"),
        avg_fixed("fare_amount", 2, 2).alias("avg_fare"),
        F.min("tpep_pickup_datetime").alias("earliest_pickup"),
        F.max("tpep_pickup_datetime").alias("latest_pickup"),
        F.count_distinct("pickup_zone").alias("unique_zones"),
        F.count_if(F.col("fare_amount") <= 0).alias("zero_fare_count"))
        .orderBy(F.desc("pickup_date")))


def health_for_date(trips: DataFrame, run_date: str) -> DataFrame:
    """One run date; a typed DATE predicate, so a table partitioned by
    ``pickup_date`` reads only that partition."""
    return (trips.where(F.col("pickup_date") == F.lit(run_date).cast("date"))
            .agg(F.count(F.lit(1)).alias("rows"),
                 avg_fixed("fare_amount", 2, 2).alias("avg_fare"),
                 avg_ratio("trip_distance", 2).alias("avg_dist_mi"),
                 F.count_distinct("pickup_location_id").alias("unique_zones")))


def top_hours(trips: DataFrame, k: int = 5) -> DataFrame:
    """Busiest pickup hours."""
    return (trips.groupBy("pickup_hour").agg(
        F.count(F.lit(1)).alias("trips"), avg_fixed("fare_amount", 2, 2).alias("avg_fare"))
        .orderBy(F.desc("trips"), "pickup_hour").limit(k))


def revenue_by_payment(trips: DataFrame) -> DataFrame:
    """Trips, average fare and revenue per payment label."""
    return (trips.groupBy("payment_label").agg(
        F.count(F.lit(1)).alias("trips"),
        avg_fixed("fare_amount", 2, 2).alias("avg_fare"),
        sum_fixed("total_amount", 2).alias("total_revenue"))
        .orderBy(F.desc("trips"), "payment_label"))


def time_of_day_breakdown(trips: DataFrame) -> DataFrame:
    """Trips, average fare and minutes per time of day."""
    return (trips.groupBy("time_of_day").agg(
        F.count(F.lit(1)).alias("trips"),
        avg_fixed("fare_amount", 2, 2).alias("avg_fare"),
        avg_ratio("trip_duration_min", 1).alias("avg_mins"))
        .orderBy(F.desc("trips"), "time_of_day"))

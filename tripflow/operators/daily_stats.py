"""Daily statistics that merge exactly over any set of dates.

Two facts per date, both built with partial aggregates:

* ``daily_moments``: counts, integer sums and sums of squares (fares in cents,
  distances in 1e-6 miles), earliest and latest pickup.  Means and standard
  deviations of any dates come from added integers, so they equal those
  computed from the trips, to the last digit.
* ``distinct_bits``: which ids occur, as bitmaps of 32,768 ids each.  Distinct
  counts do not add up over dates, bitmaps do (bitwise or), and they are exact.
  A date has one row per kind and per bitmap in use, whatever its trips.

Zone names become ids through the zone dimension: the least location id of a
name stands for it, ``NO_ZONE`` for names that the dimension lacks (the label
of unknown zones).  The reports read these facts and, where single trips are
asked for, scan the trips once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.contract import ANOMALY_SIGMAS
from tripflow.functions.exact import RATIO_DIGITS, avg_of_units, fixed_units, measured, ratio_units
from tripflow.operators.tables import DATE_COL

LOCATION, ZONE = "location", "zone"
NO_ZONE = -(1 << 31)


def daily_moments(trips: DataFrame) -> DataFrame:
    """One row a date."""
    cents = fixed_units("fare_amount", 2)
    return trips.groupBy(DATE_COL).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count("fare_amount").alias("fare_rows"),
        F.count(measured("fare_amount")).alias("fare_n"),
        F.sum(cents).alias("fare_cents"),
        F.sum(cents.cast("decimal(38,0)") * cents.cast("decimal(38,0)")).alias("fare_squares"),
        F.count(measured("trip_distance")).alias("distance_n"),
        F.sum(ratio_units("trip_distance")).alias("distance_units"),
        F.min("tpep_pickup_datetime").alias("earliest_pickup"),
        F.max("tpep_pickup_datetime").alias("latest_pickup"),
        F.count_if(F.col("fare_amount") <= 0).alias("zero_fare_count"))


def _bits(ids: DataFrame, kind: str) -> DataFrame:
    """Bitmaps of the column ``id`` per date; NULL ids are none."""
    return (ids.where(F.col("id").isNotNull())
            .groupBy(DATE_COL, F.bitmap_bucket_number("id").alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bits"))
            .select(DATE_COL, F.lit(kind).alias("kind"), "bucket", "bits"))


def zone_ids(zones: DataFrame) -> DataFrame:
    """(pickup_zone, id): one id for every zone name."""
    return (zones.where(F.col("zone_name").isNotNull()).groupBy(F.col("zone_name").alias("pickup_zone"))
            .agg(F.min("location_id").cast("bigint").alias("id")))


def distinct_bits(trips: DataFrame, agg_by_zone: DataFrame, zones: DataFrame) -> DataFrame:
    """Bitmaps of pickup locations (from the trips) and of pickup zones (from
    the daily zone fact, which holds every zone of a date)."""
    named = (agg_by_zone.where(F.col("pickup_zone").isNotNull()).select(DATE_COL, "pickup_zone")
             .join(zone_ids(zones), "pickup_zone", "left"))
    return _bits(trips.select(DATE_COL, F.col("pickup_location_id").cast("bigint").alias("id")), LOCATION).unionByName(
        _bits(named.select(DATE_COL, F.coalesce("id", F.lit(NO_ZONE)).alias("id")), ZONE))


def distinct_counts(bits: DataFrame, *by: Column) -> DataFrame:
    """Distinct locations and zones per group of dates: bitmaps united, bits
    counted."""
    names = [f"__{i}" for i in range(len(by))]
    united = (bits.select(*[c.alias(n) for c, n in zip(by, names, strict=True)], "kind", "bucket", "bits")
              .groupBy(*names, "kind", "bucket").agg(F.bitmap_count(F.bitmap_or_agg("bits")).alias("n")))
    count = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0))
    return united.groupBy(*names).agg(count(LOCATION).alias("unique_locations"), count(ZONE).alias("unique_zones"))


def _mean_fare() -> Column:
    return avg_of_units(F.sum("fare_cents"), F.sum("fare_n"), 2, 2)


def pipeline_health(moments: DataFrame, bits: DataFrame) -> DataFrame:
    """G7 from the facts."""
    zones = distinct_counts(bits, F.col(DATE_COL)).select(F.col("__0").alias(DATE_COL), "unique_zones")
    return (moments.groupBy(DATE_COL).agg(
        F.sum("row_count").alias("row_count"), _mean_fare().alias("avg_fare"),
        F.min("earliest_pickup").alias("earliest_pickup"), F.max("latest_pickup").alias("latest_pickup"),
        F.sum("zero_fare_count").alias("zero_fare_count"))
        .join(zones, DATE_COL, "left")
        .select(DATE_COL, "row_count", "avg_fare", "earliest_pickup", "latest_pickup",
                F.coalesce("unique_zones", F.lit(0)).alias("unique_zones"), "zero_fare_count")
        .orderBy(F.desc(DATE_COL)))


def health_for_date(moments: DataFrame, bits: DataFrame, run_date: str) -> DataFrame:
    """G8 from the facts: one partition of each."""
    on = F.col(DATE_COL) == F.lit(run_date).cast("date")
    return moments.where(on).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"), _mean_fare().alias("avg_fare"),
        avg_of_units(F.sum("distance_units"), F.sum("distance_n"), RATIO_DIGITS, 2).alias("avg_dist_mi")).withColumn(
        "unique_zones", distinct_counts(bits.where(on)).select("unique_locations").scalar())


def weekly_health(moments: DataFrame, bits: DataFrame) -> DataFrame:
    """Rows, mean fare and distinct locations and zones per week, merged from
    its dates."""
    week = F.date_trunc("week", F.col(DATE_COL)).cast("date")
    unique = distinct_counts(bits, week).withColumnRenamed("__0", "week")
    return (moments.groupBy(week.alias("week")).agg(F.sum("row_count").alias("row_count"), _mean_fare().alias("avg_fare"))
            .join(unique, "week", "left"))


def fare_bounds(moments: DataFrame) -> DataFrame:
    """E7 from the facts: mean and sample standard deviation of the fare."""
    n, s1, s2 = (F.sum(c).cast("double") for c in ("fare_rows", "fare_cents", "fare_squares"))
    var = (s2 - s1 * s1 / n) / F.nullif(n - 1.0, F.lit(0.0))
    return moments.agg((s1 / F.nullif(n, F.lit(0.0)) / 100.0).alias("mean_fare"),
                       (F.sqrt(var) / 100.0).alias("std_fare"))


def fare_anomalies(trips: DataFrame, moments: DataFrame, k: int = 20, sigmas: float = ANOMALY_SIGMAS) -> DataFrame:
    """G6 with the bound from the facts: the trips are scanned once."""
    from tripflow.plans.analytics import anomalies_above

    return anomalies_above(trips, fare_bounds(moments), k, sigmas)

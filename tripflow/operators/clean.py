"""Row filters (strict and batch profiles), filter statistics, dead letters.

Every profile is a list of named predicates.  A row is clean when every
predicate is TRUE (NULL counts as failed, like ``filter``).  The dead-letter
path tags each rejected row with the names of the predicates it fails; clean
and rejected rows come from one NULL-safe predicate and are disjoint by
construction.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.contract import (BATCH, STRICT, STRICT_DISTANCE, STRICT_FARE, STRICT_PASSENGERS,
                               STRICT_VENDORS)
from tripflow.functions.exact import pct

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"


def strict_checks() -> list[tuple[str, Column]]:
    c = F.col
    return [
        ("dropoff_after_pickup", c(DROPOFF) > c(PICKUP)),
        ("distance_in_range", c("trip_distance").between(*STRICT_DISTANCE)),
        ("fare_in_range", c("fare_amount").between(*STRICT_FARE)),
        ("total_non_negative", c("total_amount") >= 0),
        ("passengers_in_range", c("passenger_count").between(*STRICT_PASSENGERS)),
        ("known_vendor", c("vendor_id").isin(list(STRICT_VENDORS))),
    ]


def batch_checks() -> list[tuple[str, Column]]:
    c = F.col

    def positive(name: str) -> Column:
        return F.coalesce(c(name), F.lit(0)) > 0

    return [
        ("pickup_present", c(PICKUP).isNotNull()),
        ("dropoff_present", c(DROPOFF).isNotNull()),
        ("dropoff_after_pickup", c(DROPOFF) > c(PICKUP)),
        ("distance_positive", positive("trip_distance")),
        ("fare_positive", positive("fare_amount")),
        ("passengers_positive", positive("passenger_count")),
    ]


def checks(profile: str = STRICT) -> list[tuple[str, Column]]:
    if profile == STRICT:
        return strict_checks()
    if profile == BATCH:
        return batch_checks()
    raise ValueError(f"unknown profile {profile!r}")


def is_clean(profile: str = STRICT) -> Column:
    """TRUE only when every predicate is TRUE (NULL -> not clean)."""
    return reduce(lambda a, b: a & b,
                  [F.coalesce(p, F.lit(False)) for _, p in checks(profile)])


def filter_rows(df: DataFrame, profile: str = STRICT) -> DataFrame:
    """Keep the rows that pass the profile (one Filter node).

    The bare conjunction (a WHERE drops NULL like FALSE) so that the range
    and IN predicates reach the Parquet scan as pushed filters; wrapped in
    ``coalesce`` they would not.
    """
    return df.where(reduce(lambda a, b: a & b, [p for _, p in checks(profile)]))


def tag_rejects(df: DataFrame, profile: str = STRICT) -> DataFrame:
    """K2: add ``reject_reasons array<string>`` (empty for a clean row)."""
    reasons = F.array_compact(F.array(*[
        F.when(~F.coalesce(p, F.lit(False)), F.lit(name)) for name, p in checks(profile)]))
    return df.withColumn("reject_reasons", reasons)


def split_clean_dead(df: DataFrame, profile: str = STRICT) -> tuple[DataFrame, DataFrame]:
    """Clean rows and dead-letter rows, split by one NULL-safe predicate
    (TRUE or FALSE, never NULL), so the two are disjoint and cover the input.

    Only rejected rows get the reason array: filtering on the array's size
    would build it for every row inside the filter (3.5x slower, measured).
    """
    return filter_rows(df, profile), tag_rejects(df.where(~is_clean(profile)), profile)


def split_other_dates(clean: DataFrame, run_date: str) -> tuple[DataFrame, DataFrame]:
    """Clean rows of the run date, and those of any other date with the
    reject reason ``other_date``: a load replaces its own date alone, so a
    stray row must not take another day's rows with it."""
    own = F.to_date(F.col(PICKUP)).eqNullSafe(F.lit(run_date).cast("date"))
    return clean.where(own), clean.where(~own).withColumn("reject_reasons", F.array(F.lit("other_date")))


def reject_reason_counts(dead: DataFrame) -> DataFrame:
    """Rows per failed predicate (a row failing two predicates counts twice)."""
    return (dead.select(F.explode("reject_reasons").alias("reason"))
            .groupBy("reason").agg(F.count(F.lit(1)).alias("rejected_rows")))


def filter_stats(df: DataFrame, profile: str | Sequence[str] = STRICT) -> DataFrame:
    """Rows before/after the filter and removed % (1 decimal), one row
    per profile, all profiles from one aggregate (one pass)."""
    profiles = [profile] if isinstance(profile, str) else list(profile)
    m = df.agg(F.count(F.lit(1)).alias("rows_before"),
               *[F.count_if(is_clean(p)).alias(f"after__{p}") for p in profiles])
    per_profile = F.array(*[F.struct(F.lit(p).alias("profile"),
                                     F.col(f"after__{p}").alias("rows_after"))
                            for p in profiles])
    return (m.select("rows_before", F.inline(per_profile))
            .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))
            .withColumn("removed_pct",
                        pct("rows_removed", F.greatest(F.col("rows_before"), F.lit(1)), 1))
            .select("profile", "rows_before", "rows_after", "rows_removed", "removed_pct"))


def row_gate(df: DataFrame, min_rows: int = 100) -> bool:
    """True when ``df`` holds at least ``min_rows`` rows.

    The limit is the last step of the plan (``CollectLimit``), so Spark runs
    one partition first, more only while rows are missing, and each stops at
    its ``min_rows``-th row; an aggregate above the limit would start them all.
    The driver gets at most ``min_rows`` rows without columns.
    """
    return len(df.select().limit(min_rows).collect()) >= min_rows


def row_gate_plan(df: DataFrame, min_rows: int = 100) -> DataFrame:
    """B12 as one row of a plan: the rows seen, at most ``min_rows``, and
    whether the transform proceeds.  No partition gives more than that."""
    seen = df.select(F.lit(1).alias("one")).limit(min_rows)
    return seen.agg(F.count(F.lit(1)).alias("rows_seen")).withColumn("proceed", F.col("rows_seen") >= min_rows)


def row_gate_by_date(df: DataFrame, min_rows: int = 100,
                     ts: str = PICKUP) -> DataFrame:
    """B12 for many run dates at once: raw rows per pickup date and whether
    the transform would proceed for that date."""
    return (df.groupBy(F.to_date(F.col(ts)).alias("run_date"))
            .agg(F.count(F.lit(1)).alias("raw_rows"))
            .withColumn("proceed", F.col("raw_rows") >= min_rows))

"""Scalar column expressions for trip features (all built-in, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tripflow.contract import (DISTANCE_BUCKETS, LONGEST_BUCKET, NIGHT, PAYMENT_LABELS,
                               TIME_OF_DAY, UNKNOWN_PAYMENT)
from tripflow.functions.exact import round_half_up

PICKUP, DROPOFF = "tpep_pickup_datetime", "tpep_dropoff_datetime"
EPOCH = "1970-01-01 00:00:00"


def epoch_seconds(ts) -> Column:
    """Whole seconds since the epoch (truncates the fraction), zone independent."""
    return F.timestamp_diff("SECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col(ts) if isinstance(ts, str) else ts)


def duration_min_strict() -> Column:
    """Each end truncated to the second, then minutes (strict profile)."""
    return (epoch_seconds(DROPOFF) - epoch_seconds(PICKUP)) / 60.0


def duration_min_batch() -> Column:
    """Fractional seconds, minutes rounded to 2 decimals (batch profile)."""
    micros = F.timestamp_diff("MICROSECOND", F.col(PICKUP), F.col(DROPOFF))
    return round_half_up(micros / 6e7, 2)


def speed_mph(duration_col: str = "trip_duration_min") -> Column:
    """distance / hours; NULL when the duration is not positive."""
    dur = F.col(duration_col)
    return F.when(dur > 0, F.col("trip_distance") / (dur / 60.0))


def tip_pct() -> Column:
    """tip / fare * 100; 0.0 when the fare is not positive or NULL."""
    fare = F.col("fare_amount")
    return F.when(fare > 0, (F.col("tip_amount") / fare) * 100).otherwise(F.lit(0.0))


def time_of_day(ts: str = PICKUP) -> Column:
    hour = F.hour(F.col(ts))
    expr = None
    for label, lo, hi in TIME_OF_DAY:
        cond = hour.between(lo, hi)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(NIGHT)


def payment_label(col: str = "payment_type") -> Column:
    code = F.col(col)
    expr = None
    for k, label in PAYMENT_LABELS.items():
        expr = F.when(code == k, label) if expr is None else expr.when(code == k, label)
    return expr.otherwise(UNKNOWN_PAYMENT)


def distance_bucket(col: str = "trip_distance") -> Column:
    d = F.col(col)
    expr = None
    for label, upper in DISTANCE_BUCKETS:
        expr = F.when(d < upper, label) if expr is None else expr.when(d < upper, label)
    return expr.otherwise(LONGEST_BUCKET)

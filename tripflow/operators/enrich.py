"""Derived trip features for the two profiles.

strict: whole-second durations, unrounded speed and tip %, DATE pickup_date.
batch:  fractional durations rounded to 2, speed from the rounded duration
        (rounded to 2), tip % rounded to 2, pickup_date as 'yyyy-MM-dd'.
One projection, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.contract import BATCH, STRICT
from tripflow.functions import features as fx
from tripflow.functions.exact import round_half_up


def derive_features(df: DataFrame, profile: str = STRICT) -> DataFrame:
    pickup = F.col(fx.PICKUP)
    if profile == STRICT:
        return df.withColumns({
            "trip_duration_min": fx.duration_min_strict(),
        }).withColumns({
            "avg_speed_mph": fx.speed_mph(),
            "tip_pct": fx.tip_pct(),
            "time_of_day": fx.time_of_day(),
            "pickup_date": F.to_date(pickup),
            "pickup_hour": F.hour(pickup),
            "payment_label": fx.payment_label(),
        })
    if profile == BATCH:
        dur = F.col("trip_duration_min")
        fare = F.col("fare_amount")
        return df.withColumns({
            "trip_duration_min": fx.duration_min_batch(),
        }).withColumns({
            "avg_speed_mph": F.when(dur > 0, round_half_up(
                F.col("trip_distance") / (dur / 60.0), 2)),
            "tip_pct": F.when(fare > 0, round_half_up(
                F.col("tip_amount") / fare * 100, 2)).otherwise(F.lit(0.0)),
            "time_of_day": fx.time_of_day(),
            "pickup_date": F.date_format(pickup, "yyyy-MM-dd"),
            "pickup_hour": F.hour(pickup),
            "payment_label": fx.payment_label(),
        })
    raise ValueError(f"unknown profile {profile!r}")

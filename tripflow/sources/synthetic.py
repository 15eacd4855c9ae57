"""A5: seeded synthetic trips, one per input id.

Uniform numbers come from integer arithmetic on the row id (not ``rand()``,
whose stream depends on partitioning), so any executor reproduces any row
and a lost task regenerates the same rows.  Distributions follow the
reference's generator: uniform pickup second of the day, exponential
duration and distance, fare linear in distance plus normal noise, 70 %
tipped, small choice lists for categorical columns.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.functions.exact import round_half_up

# --- fixed values: generator parameters ---
PRIME = 2147483647
DURATION_MEAN_MIN, DURATION_CLIP = 12.0, (2.0, 90.0)
DISTANCE_MEAN_MI, DISTANCE_CLIP = 3.0, (0.1, 25.0)
FARE_BASE, FARE_PER_MILE, FARE_NOISE_SD, FARE_CLIP = 2.5, 2.5, 1.5, (3.0, 150.0)
TIP_PROBABILITY, TIP_SHARE = 0.7, (0.1, 0.25)
EXTRA_RANGE = (0.5, 3.5)
VENDORS = (1, 2)
PASSENGERS = (1, 1, 1, 2, 2, 3, 4)
RATE_CODES = (1, 1, 1, 1, 2, 3)
PAYMENT_TYPES = (1, 1, 2, 2, 3)
LOCATIONS = (1, 265)
# --- end of fixed values ---


def uniform(idc: Column, salt: int) -> Column:
    """A deterministic uniform in [0, 1) from the id and a salt.

    All arithmetic is modulo PRIME, so the id enters reduced: the same
    values, and no bigint overflow (ANSI mode raises) for any id.
    """
    idm = idc % PRIME
    x = (idm * 48271 + salt * 69621 + 12345) % PRIME
    for i in range(3):
        x = (x * x + idm + (7 + i)) % PRIME
    return x / float(PRIME)


def _clip(c: Column, lo: float, hi: float) -> Column:
    return F.least(F.greatest(c, F.lit(lo)), F.lit(hi))


def _choice(values: tuple, u: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.floor(u * len(values)) + 1).cast("int"))


def synthetic_trips(ids: DataFrame, run_date: str | Column, id_col: str = "id") -> DataFrame:
    """One synthetic trip per row of ``ids`` (a bigint id column) on the run
    date, which may be a column of ``ids``."""
    i = F.col(id_col).cast("bigint")
    u = {k: uniform(i, k) for k in range(1, 14)}
    base = (run_date if isinstance(run_date, Column) else F.lit(run_date)).cast("date").cast("timestamp_ntz")
    pickup_s = F.floor(u[1] * 86400)
    duration_min = _clip(-DURATION_MEAN_MIN * F.log(1 - u[2]), *DURATION_CLIP)
    distance = round_half_up(_clip(-DISTANCE_MEAN_MI * F.log(1 - u[3]), *DISTANCE_CLIP), 2)
    normal = F.sqrt(-2.0 * F.log(1 - u[4])) * F.cos(2 * math.pi * u[5])
    share = TIP_SHARE[0] + (TIP_SHARE[1] - TIP_SHARE[0]) * u[7]
    extra = EXTRA_RANGE[0] + (EXTRA_RANGE[1] - EXTRA_RANGE[0]) * u[8]
    pickup = base + F.make_dt_interval(secs=pickup_s.cast("decimal(18,6)"))
    lo, hi = LOCATIONS
    return (ids.select(
        i.alias("_id"),
        _choice(VENDORS, u[9]).alias("vendor_id"),
        pickup.alias("tpep_pickup_datetime"),
        (pickup + F.make_dt_interval(
            secs=round_half_up(duration_min * 60.0, 6).cast("decimal(18,6)"))
         ).alias("tpep_dropoff_datetime"),
        _choice(PASSENGERS, u[10]).alias("passenger_count"),
        distance.alias("trip_distance"),
        _choice(RATE_CODES, u[11]).alias("rate_code_id"),
        _choice(PAYMENT_TYPES, u[12]).alias("payment_type"),
        (lo + F.floor(u[13] * (hi - lo + 1))).cast("int").alias("pickup_location_id"),
        (lo + F.floor(uniform(i, 14) * (hi - lo + 1))).cast("int").alias("dropoff_location_id"),
        normal.alias("_normal"), share.alias("_share"), extra.alias("_extra"),
        u[6].alias("_u6"))
        .withColumn("fare_amount", round_half_up(
            _clip(FARE_BASE + FARE_PER_MILE * F.col("trip_distance")
                  + FARE_NOISE_SD * F.col("_normal"), *FARE_CLIP), 2))
        .withColumn("tip_amount", F.when(F.col("_u6") < TIP_PROBABILITY, round_half_up(
            F.col("fare_amount") * F.col("_share"), 2)).otherwise(F.lit(0.0)))
        .withColumn("total_amount", round_half_up(
            F.col("fare_amount") + F.col("tip_amount") + F.col("_extra"), 2))
        .select("vendor_id", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count",
                "trip_distance", "rate_code_id", "fare_amount", "tip_amount", "total_amount",
                "payment_type", "pickup_location_id", "dropoff_location_id"))

"""Zone dimension: lookup source, role-playing left joins, fallback.

The same dimension joins twice (pickup and dropoff).  Spark's planner compares
its size in bytes (of the files it is read from, at run time of the exchange)
with ``spark.sql.autoBroadcastJoinThreshold`` and broadcasts it below; no job
asks for its size.  A larger dimension takes a shuffled sort-merge join, where
AQE's skew-join splitting handles a hot location id (or the NULL-key partition),
or the salted joins of ``dimension``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.contract import UNKNOWN_ZONE, ZONE_TEXT_SCHEMA

# A zone row is ~60 bytes in a broadcast hash relation: 1M rows ~ 60 MB.
MAX_BROADCAST_ROWS = 1_000_000


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """True when ``df`` has at most ``max_rows`` rows (reads no more than
    ``max_rows + 1`` of each partition)."""
    return df.limit(max_rows + 1).count() <= max_rows


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint when it is proven to hold at most
    ``max_rows`` rows; otherwise unchanged (Spark then shuffles both sides)."""
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def parse_zone_lookup(text: DataFrame) -> DataFrame:
    """Raw ``LocationID, Borough, Zone`` strings -> typed lookup."""
    return text.select(
        F.expr("try_cast(try_cast(LocationID AS DOUBLE) AS INT)").alias("location_id"),
        F.col("Zone").alias("zone_name"),
        F.col("Borough").alias("borough"),
    )


def read_zone_lookup(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV with an explicit schema (no inference pass)."""
    raw = spark.read.schema(ZONE_TEXT_SCHEMA).option("header", True).csv(path)
    return parse_zone_lookup(raw)


def unique_zones(zones: DataFrame) -> DataFrame:
    """One row per location id (a duplicate id would multiply trips).

    Deterministic: keeps the smallest (zone_name, borough) of a duplicated id.
    """
    return (zones.where(F.col("location_id").isNotNull())
            .groupBy("location_id")
            .agg(F.min(F.struct("zone_name", "borough")).alias("z"))
            .select("location_id", "z.zone_name", "z.borough"))


def join_zones(trips: DataFrame, zones: DataFrame, dedupe: bool = False,
               max_broadcast_rows: int | None = None) -> DataFrame:
    """D1 + D2: left-join the zone dimension on pickup and on dropoff id.

    With ``max_broadcast_rows`` the dimension is counted up to that number and
    broadcast if it has no more rows, whatever its bytes; without it the
    planner decides by bytes.  ``dedupe`` keeps one row of each location id.

    Both joins use the *same* dimension plan (aliased twice), so Spark
    builds and broadcasts it once and reuses the exchange for the second
    join.
    """
    if dedupe:
        zones = unique_zones(zones)
    dim = zones.select("location_id", "zone_name", "borough")
    if max_broadcast_rows is not None:
        dim = broadcast_if_small(dim, max_broadcast_rows)
    pz, dz = dim.alias("pz"), dim.alias("dz")
    t = trips.alias("t")
    return (t.join(pz, F.col("t.pickup_location_id") == F.col("pz.location_id"), "left")
            .join(dz, F.col("t.dropoff_location_id") == F.col("dz.location_id"), "left")
            .select("t.*",
                    F.col("pz.zone_name").alias("pickup_zone"),
                    F.col("pz.borough").alias("pickup_borough"),
                    F.col("dz.zone_name").alias("dropoff_zone"),
                    F.col("dz.borough").alias("dropoff_borough")))


def zone_fallback(trips: DataFrame) -> DataFrame:
    """No lookup available -> zones 'unknown', boroughs NULL."""
    null_str = F.lit(None).cast("string")
    return trips.withColumns({
        "pickup_zone": F.lit(UNKNOWN_ZONE),
        "pickup_borough": null_str,
        "dropoff_zone": F.lit(UNKNOWN_ZONE),
        "dropoff_borough": null_str,
    })

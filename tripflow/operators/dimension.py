"""D1, D2 for a dimension of any size: salted, bucketed left joins.

``zones.join_zones`` broadcasts a small dimension.  A large one meets the trips
by key, and then a hot location, or the trips without one, would land in one
task.  So:

* *Hot keys* are those with at least ``SHARE`` of all trips; there are at most
  ``1 / SHARE`` of them, whatever the data, which bounds their broadcast.
* Trips with a hot or NULL key get a salt from their other columns, the others
  salt 0; the dimension's rows of hot keys come once per salt.  Key and salt
  together are the join key, so a hot key is spread over ``SALTS`` tasks and NULL
  keys (which match nothing, and stay) as well.
* *Bucketed tables.*  Both sides can be stored bucketed by key and salt:
  a join then reads buckets side by side, without an exchange of either
  side, however often the trips are enriched.

Nothing is counted beforehand to choose a plan: a dimension that is stored first
(``zones`` staged as a table) has a size in bytes that Spark's planner compares
with ``spark.sql.autoBroadcastJoinThreshold`` by itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.operators.zones import unique_zones

SALTS = 16
SHARE = 0.01
SALT = "__salt"


def hot_keys(df: DataFrame, key: str, share: float = SHARE) -> DataFrame:
    """(__hot): the keys that at least ``share`` of the rows have; fewer than
    ``1 / share + 1`` of them.  Partial counts make it a small shuffle."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.where(F.col(key).isNotNull() & (F.col("__n") >= share * total)).select(F.col(key).alias("__hot"))


def salted(df: DataFrame, key: str, hot: DataFrame, salts: int = SALTS) -> DataFrame:
    """``df`` with a salt: 0, or any of ``salts`` where the key is hot or NULL."""
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns if c != key]), F.lit(salts)).cast("int")
    return (df.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
            .withColumn(SALT, F.when(F.col(key).isNull() | F.col("__hot").isNotNull(), spread).otherwise(F.lit(0)))
            .drop("__hot"))


def replicated(dim: DataFrame, key: str, hot: DataFrame, salts: int = SALTS) -> DataFrame:
    """The dimension with a salt: rows of hot keys once per salt."""
    all_salts = F.array(*[F.lit(i) for i in range(salts)])
    return (dim.join(F.broadcast(hot), F.col(key) == F.col("__hot"), "left")
            .withColumn(SALT, F.explode(F.when(F.col("__hot").isNotNull(), all_salts).otherwise(F.array(F.lit(0)))))
            .drop("__hot"))


def role(zones: DataFrame, name: str) -> DataFrame:
    """The zone dimension for one role: one row a location, columns named."""
    return unique_zones(zones).select(F.col("location_id").alias(f"{name}_location_id"),
                                      F.col("zone_name").alias(f"{name}_zone"), F.col("borough").alias(f"{name}_borough"))


def join_salted(trips: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """Left join of sides that carry a salt; bucketed by key and salt they meet
    without a shuffle."""
    return trips.join(dim, [key, SALT], "left").drop(SALT)


def join_large(trips: DataFrame, zones: DataFrame, salts: int = SALTS, share: float = SHARE) -> DataFrame:
    """D1 + D2 with both joins salted; the same rows as ``zones.join_zones``."""
    out, columns = trips, list(trips.columns)
    for name in ("pickup", "dropoff"):
        key = f"{name}_location_id"
        hot = hot_keys(trips, key, share)
        out = join_salted(salted(out, key, hot, salts), replicated(role(zones, name), key, hot, salts), key)
        columns += [f"{name}_zone", f"{name}_borough"]
    return out.select(*columns)


def store_bucketed(df: DataFrame, table: str, keys: list[str], buckets: int, path: str) -> DataFrame:
    """``df`` as a catalog table bucketed and sorted by ``keys``, one file a
    bucket; returns a read of it."""
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
     .mode("overwrite").option("path", path).saveAsTable(table))
    return df.sparkSession.table(table)

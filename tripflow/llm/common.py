"""Small helpers shared by the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.session import ensure_checkpoint_dir

# Stands for a null id inside keys; such rows keep their null in results.
NULL_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of an iterative step: write to the shared checkpoint
    folder, from which any executor can read again."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def id_key(col: str) -> Column:
    """An id as a join key: null becomes a value of its own."""
    return F.coalesce(F.col(col).cast("long"), F.lit(NULL_ID))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame) -> DataFrame:
    """Cut the lineage with a Parquet table in the shared checkpoint folder:
    more compact than ``checkpoint()`` and, like it, readable by any executor
    after others are lost.  The shuffle files behind it are then unreachable;
    Spark's cleaner follows the driver's garbage collector, so that is run."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    df.sparkSession.sparkContext._jvm.System.gc()
    return df.sparkSession.read.schema(df.schema).parquet(path)

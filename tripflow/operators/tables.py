"""Table sinks and the idempotent date reload.

Tables are Parquet directories partitioned by ``pickup_date``.  A reload
replaces whole dates: every date present in the batch plus the run date,
so running the same batch twice leaves one copy, and an empty batch still
clears its run date.  Dates are partition directories, so a reload touches
only the partitions it replaces (dynamic partition overwrite) and a reader
that filters a typed date reads one directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripflow import files
from tripflow.contract import TABLE_SCHEMAS

DATE_COL = "pickup_date"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None,
                mode: str = "overwrite") -> int:
    """Write Parquet and return the row count from the same job
    (``observe`` instead of a second ``count`` pass)."""
    obs = Observation("write_stats")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return int(obs.get["rows"])


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    """An empty DataFrame with a table's schema."""
    return spark.createDataFrame([], TABLE_SCHEMAS[name])


def init_table(spark: SparkSession, name: str, path: str,
               partition_by: list[str] | None = None) -> None:
    """Create the table if it does not exist (CREATE TABLE IF NOT EXISTS)."""
    if not files.exists(spark, path):
        writer = empty_table(spark, name).write.mode("ignore")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)


def read_table(spark: SparkSession, name: str, path: str) -> DataFrame:
    """A written table under its declared schema, so that one without any
    file yet (just created, or all its dates cleared) reads as empty."""
    schema = TABLE_SCHEMAS[name]
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())


def replaced_dates(batch: DataFrame, run_date: str, date_col: str = DATE_COL) -> DataFrame:
    """Dates a reload replaces: those in the batch plus the run date."""
    run = batch.sparkSession.range(1).select(F.lit(run_date).cast("date").alias(date_col))
    return batch.select(F.col(date_col).cast("date").alias(date_col)).unionByName(run).distinct()


def reload(existing: DataFrame, batch: DataFrame, run_date: str,
           date_col: str = DATE_COL) -> DataFrame:
    """F1, pure form: the table after replacing the batch's dates.

    One null-safe anti join whatever the number of dates: a NULL date is a
    date of its own, kept unless the batch brings one.  The distinct dates
    are the small side, which AQE broadcasts by its measured size.
    """
    dates = replaced_dates(batch, run_date, date_col).withColumnRenamed(date_col, "__date")
    keep = existing.join(dates, F.col(date_col).cast("date").eqNullSafe(F.col("__date")), "left_anti")
    return keep.unionByName(batch.select(*existing.columns))


def reload_partitions(spark: SparkSession, batch: DataFrame, path: str, run_date: str,
                      date_col: str = DATE_COL) -> int:
    """F1, file sink: dynamic partition overwrite of the batch's dates; the
    run date's partition is removed when the batch has no row for it (the
    DELETE half of the reload).  Returns the rows written.

    One job: the write itself reports its row count and whether it held the
    run date.  A caller that must not touch other dates hands over rows of
    the run date alone (``clean.split_other_dates``).
    """
    obs = Observation("reload_stats")
    of_run = F.count_if(F.col(date_col) == F.lit(run_date).cast("date"))
    (batch.hint("rebalance", F.col(date_col))  # a few files a date, a hot date split
     .observe(obs, F.count(F.lit(1)).alias("rows"), of_run.alias("of_run"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(date_col).parquet(path))
    if not obs.get["of_run"]:
        files.delete(spark, f"{path}/{date_col}={run_date}")
    return int(obs.get["rows"])


def load_counts(table: DataFrame, run_date: str, date_col: str = DATE_COL) -> DataFrame:
    """rows of the run date and rows in total, one pass."""
    return table.agg(
        F.count_if(F.col(date_col) == F.lit(run_date).cast("date")).alias("loaded_rows"),
        F.count(F.lit(1)).alias("total_rows"))

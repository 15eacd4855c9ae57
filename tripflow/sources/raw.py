"""Raw trip sources and the raw-layer sink.

The raw layer is text: CSV read as strings under its header (types are never
inferred), then each column is converted with ``try_cast`` so a bad value
becomes NULL instead of failing the job (Spark 4 runs in ANSI mode); NaN and
infinities are bad values too.
Integers go through DOUBLE first so that ``"1.0"`` (a nullable integer as
pandas writes it) reads as 1.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripflow import files
from tripflow.contract import (FLOAT_COLUMNS, INT_COLUMNS, PINNED_DAY, SOURCE_RENAMES,
                               TRIP_CONTRACT, TS_COLUMNS)
from tripflow.functions.exact import measured
from tripflow.functions.guards import has_rows, require

log = logging.getLogger(__name__)

PICKUP = "tpep_pickup_datetime"
CORRUPT = "_corrupt_line"
REAL, SYNTHETIC = "real", "synthetic"


def typed(name: str) -> Column:
    """The contract type of a raw text column, bad values -> NULL."""
    if name in INT_COLUMNS:
        return F.expr(f"try_cast(try_cast(`{name}` AS DOUBLE) AS INT)").alias(name)
    if name in FLOAT_COLUMNS:
        return measured(F.expr(f"try_cast(`{name}` AS DOUBLE)")).alias(name)
    if name in TS_COLUMNS:
        return F.expr(f"try_cast(`{name}` AS TIMESTAMP_NTZ)").alias(name)
    return F.col(name)


def read_raw_text(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV -> all-string columns, named by the header (no inference),
    so that a file without some column is not read by position.

    A line with too few or too many fields is not read by position either: its
    text is in ``CORRUPT`` (NULL in well-formed lines).  The scan checks every
    line whole, whichever columns are asked for."""
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).schema
    schema = T.StructType([*header.fields, T.StructField(CORRUPT, T.StringType())])
    return read_lines(spark, path, schema)


def read_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV with a header under a schema that ends in ``CORRUPT``.

    Lines are parsed whole whatever is asked of them (a pruned parse would not
    see that fields are missing), and the filter, true of every row, names a
    data column, as Spark refuses to read the text of broken lines alone."""
    lines = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
             .option("columnNameOfCorruptRecord", CORRUPT).option("columnPruning", False).csv(path))
    first = F.col(schema.fieldNames()[0])
    return lines.where(first.isNull() | (F.length(first) >= 0))


def split_corrupt(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Well-formed lines, and the text of the others (``raw_line``)."""
    bad = F.col(CORRUPT).isNotNull()
    columns = [c for c in lines.columns if c != CORRUPT]
    partitions = [c for c in columns if c in ("run_date",)]
    return (lines.where(~bad).select(*columns),
            lines.where(bad).select(*partitions, F.col(CORRUPT).alias("raw_line")))


def n_fields(raw_line: Column) -> Column:
    """Fields of a line that quotes none."""
    return F.size(F.split(raw_line, ","))


def cast_trips(text: DataFrame) -> DataFrame:
    """A1: every contract column converted; a missing column is an error."""
    return text.select(*[typed(c) for c in TRIP_CONTRACT.column_names])


def cast_trips_lenient(text: DataFrame) -> DataFrame:
    """A2: convert only the contract columns that exist; keep their order."""
    present = set(text.columns)
    return text.select(*[typed(c) for c in TRIP_CONTRACT.column_names if c in present])


def read_trips_csv(spark: SparkSession, path: str) -> DataFrame:
    return cast_trips(read_raw_text(spark, path))


def as_text(df: DataFrame) -> DataFrame:
    """The text form of typed trips, as the raw CSV layer holds them."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def day_slice(df: DataFrame, day: str = PINNED_DAY, ts: str = PICKUP) -> DataFrame:
    """A3: rows whose pickup falls on ``day``.

    A half-open range on the raw timestamp (not ``to_date(ts) = day``), so
    the predicate reaches the Parquet scan as min/max row-group pruning.
    """
    start = F.lit(f"{day} 00:00:00").cast("timestamp_ntz")
    return df.where((F.col(ts) >= start) & (F.col(ts) < start + F.expr("INTERVAL 1 DAY")))


def standardise_columns(df: DataFrame) -> DataFrame:
    """A4: source names -> contract names, ordered subset of what exists."""
    renamed = df.withColumnsRenamed({k: v for k, v in SOURCE_RENAMES.items() if k in df.columns})
    return renamed.select(*[c for c in TRIP_CONTRACT.column_names if c in renamed.columns])


def to_source_layout(trips: DataFrame, extra: dict[str, Column] | None = None) -> DataFrame:
    """Contract trips -> the monthly source's column names (plus extras)."""
    back = {v: k for k, v in SOURCE_RENAMES.items()}
    out = trips.withColumnsRenamed({k: v for k, v in back.items() if k in trips.columns})
    return out.withColumns(extra) if extra else out


def ingest(spark: SparkSession, run_date: str, source_path: str | None = None,
           synthetic_rows: int = 5000, day: str | None = None) -> tuple[DataFrame, str]:
    """Choose the source: monthly Parquet (sliced to ``day``) if it
    exists, else the synthetic generator.  ``day`` is the run date unless
    given.  Raises on an empty result."""
    from tripflow.sources.synthetic import synthetic_trips

    if source_path and files.exists(spark, source_path):
        df, source = standardise_columns(day_slice(spark.read.parquet(source_path), day or run_date)), REAL
    else:
        df, source = standardise_columns(synthetic_trips(spark.range(synthetic_rows), run_date)), SYNTHETIC
    if df.isEmpty():
        raise ValueError("Ingestion produced 0 rows - check the source")
    return df, source


def ingest_plan(real: DataFrame, fallback: DataFrame) -> DataFrame:
    """A6 as one plan: the rows of ``real``, or those of ``fallback`` where
    ``real`` has none, with the tag ``source``; reading it fails where both are
    empty.  The choice is a subquery that stops at the first row of ``real``; the
    driver decides nothing, and its value drops the other branch's rows as they
    are read."""
    there = has_rows(real)
    rows = (real.where(there).withColumn("source", F.lit(REAL))
            .unionByName(fallback.where(~there).withColumn("source", F.lit(SYNTHETIC))))
    return require(rows, there | has_rows(fallback), "Ingestion produced 0 rows - check the source")


def ingest_dates(real: DataFrame, fallback: DataFrame, ts: str = PICKUP) -> DataFrame:
    """A6 for every run date at once: the real rows of the dates that have
    any, the fallback's rows of the others, with ``run_date`` and ``source``."""
    day = F.to_date(F.col(ts))
    tagged = real.select("*", day.alias("run_date"), F.lit(REAL).alias("source"))
    other = fallback.select("*", day.alias("run_date"), F.lit(SYNTHETIC).alias("source"))
    rows = tagged.unionByName(other.join(tagged.select("run_date").distinct(), "run_date", "left_anti"))
    return require(rows, has_rows(real) | has_rows(fallback), "Ingestion produced 0 rows - check the source")


def ingest_summary(df: DataFrame, source: str, run_date: str) -> DataFrame:
    """One row: run date, source tag, row count."""
    return df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(run_date).cast("date").alias("run_date"), F.lit(source).alias("source"), "row_count")


def source_summary(tagged: DataFrame) -> DataFrame:
    """Row count per run date and source, of rows that carry both."""
    return tagged.groupBy("run_date", "source").agg(F.count(F.lit(1)).alias("row_count"))


def write_raw_csv(df: DataFrame, root: str, run_date: str) -> str:
    """The raw text layer for one run date (overwrite that date only)."""
    path = f"{root}/run_date={run_date}"
    as_text(df).write.mode("overwrite").option("header", True).csv(path)
    return path

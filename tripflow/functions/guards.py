"""Conditions that a plan carries: they fail the job itself, no driver action.

A guard is one row of its own beside the data, evaluated in every run of the
plan, also when the data has no row; it raises or vanishes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require(df: DataFrame, condition: Column, message: Column | str) -> DataFrame:
    """``df``, or an error when ``condition`` (scalar subqueries and constants)
    is not true: whoever reads or writes the result fails with ``message``."""
    text = F.lit(message) if isinstance(message, str) else message
    # a boolean either way, so that the filter cannot be settled without raising
    holds = F.when(F.coalesce(condition, F.lit(False)), F.lit(True)).otherwise(F.raise_error(text).cast("boolean"))
    nulls = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    guard = df.sparkSession.range(1).select(holds.alias("__holds")).where(~F.col("__holds")).select(*nulls)
    return df.unionByName(guard)


def has_rows(df: DataFrame) -> Column:
    """EXISTS over ``df`` as a scalar: its first row decides, the rest is not read."""
    return F.coalesce(df.limit(1).agg(F.count(F.lit(1)) > 0).scalar(), F.lit(False))

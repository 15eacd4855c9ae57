"""Vector columns as numpy matrices inside Arrow tasks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vec: Column) -> Column:
    """Not null, not empty, every component there and finite."""
    top = F.lit(float("inf"))
    return (vec.isNotNull() & (F.size(vec) > 0)
            & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < top)))


def not_zero(vec: Column) -> Column:
    return F.exists(vec, lambda x: x != 0)


def id_vectors(df: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec, dim) of the rows that take part; rows with a null id do not."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    return (rows.where(F.col("id").isNotNull() & usable(F.col("vec")))
            .withColumn("dim", F.size("vec")))


def matrix(col: pa.ListArray, dtype: str = "f8") -> np.ndarray:
    """The rows of a list column of one length, without nulls."""
    flat = col.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(dtype, copy=False).reshape(len(col), -1) if len(col) else np.zeros((0, 0), dtype)

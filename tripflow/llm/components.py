"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """(a, b) with a > b: every vertex links its neighbours (small: the lesser
    ones and itself, large: the greater ones) to its least neighbour."""
    both = edges if small else edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("__m"))
    least = least.withColumn("__m", F.least("__m", "a"))
    out = both.join(least, "a")
    if small:
        out = (out.select(F.col("b").alias("x"), "__m")
               .unionByName(least.select(F.col("a").alias("x"), "__m")))
    else:
        out = out.where(F.col("b") > F.col("a")).select(F.col("b").alias("x"), "__m")
    return out.where(F.col("x") != F.col("__m")).select(F.col("x").alias("a"), F.col("__m").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, b): each vertex that is not the least of its component, and that
    least vertex.  Self loops and repeated edges do not matter.

    A least vertex that is joined by half of all edges is a hot key on one
    side only; the other side has one row a vertex, so AQE can split it.
    """
    now = stored(edges.where(F.col("a") != F.col("b"))
                 .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    mark = _mark(now)
    while True:
        now = stored(_star(_star(now, small=False), small=True))
        before, mark = mark, _mark(now)
        if before == mark:
            return now


def _mark(edges: DataFrame) -> tuple:
    """Number of edges and an order-free checksum."""
    h = F.xxhash64("a", "b").cast("decimal(38,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(h)).first())

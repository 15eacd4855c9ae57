"""Exact top-k search by multi-resolution segment statistics.

Vectors are cut into 1, 4 and 16 segments.  The inner product of two segments
is the product of their means times the length plus the inner product of what
is left when the mean is taken off, and that is at most the product of the two
deviations' norms.  The sum over the segments bounds the whole product from
above, the tighter the finer the segments.  (For distances, which fall as
products rise, this is the lower bound of the method.)  A block of candidates
is passed coarse to fine: at each level the pairs whose bound cannot reach the
query's k-th best score so far drop out; exact products are computed for the
survivors alone.  The result is that of a full scan.

Components become ``floor(scale * x)`` in double precision, scores are exact
integers.  Queries and candidates travel in blocks of ``QUERY_BLOCK`` and
``ROW_BLOCK`` rows; every query block meets every candidate block, in as many
tasks as there are pairs of blocks, and each sends on k rows a query.

Defined results: vectors that are null, empty or hold null or non-finite
components, and rows with a null id, take no part; only vectors of equal
length are compared; ties go to the smaller id, equal ids to the equal rows'
repeated scores; an empty table gives no rows; k beyond the candidates gives
all of them.  Scores beyond 64 bits are outside the contract.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.common import shuffle_partitions
from tripflow.llm.vectors import id_vectors, matrix

QUERY_BLOCK = 512
ROW_BLOCK = 2048
LEVELS = (1, 4, 16)
SEEDS = 4  # exact scores a query for its first threshold, times k


def scaled(m: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(scale * m.astype("f8"))


def packed(rows: DataFrame, block: int, scale: float) -> DataFrame:
    """Blocks (ids, values, dim, n) of up to ``block`` rows of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: dict[int, list] = {}

        def out(dim: int) -> pa.RecordBatch:
            parts = waiting.pop(dim)
            ids = np.concatenate([p[0] for p in parts])
            m = np.concatenate([p[1] for p in parts])
            return pa.RecordBatch.from_arrays(
                [pa.array([ids.tobytes()], pa.binary()), pa.array([m.astype("<i8").tobytes()], pa.binary()),
                 pa.array([dim], pa.int32()), pa.array([len(ids)], pa.int32())],
                names=["ids", "vals", "dim", "n"])

        for b in batches:
            dims = b.column("dim").to_numpy(zero_copy_only=False)
            ids = b.column("id").to_numpy(zero_copy_only=False).astype("<i8")
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                m = scaled(matrix(b.column("vec").take(pa.array(at))), scale)
                own = ids[at]
                while len(own):
                    have = sum(len(p[0]) for p in waiting.get(dim, []))
                    take = block - have
                    waiting.setdefault(dim, []).append((own[:take], m[:take]))
                    own, m = own[take:], m[take:]
                    if have + len(waiting[dim][-1][0]) >= block:
                        yield out(dim)
        for dim in sorted(waiting):
            yield out(dim)

    return rows.mapInArrow(run, "ids binary, vals binary, dim int, n int")


def bounds(m: np.ndarray, segments: int) -> np.ndarray:
    """Features whose inner product bounds that of the vectors from above."""
    parts = np.array_split(np.arange(m.shape[1]), min(segments, m.shape[1]))
    cols = []
    for p in parts:
        s = m[:, p]
        mean = s.mean(axis=1)
        cols += [mean * np.sqrt(len(p)), np.sqrt(((s - mean[:, None]) ** 2).sum(axis=1))]
    return np.stack(cols, axis=1)


def block_topk(qids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> Iterator[tuple]:
    """(query id, ids, scores) of the k best rows of a block for each query."""
    exact = np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * q.shape[1] < 2 ** 52
    qi, xi = (q, x) if exact else (q.astype("i8"), x.astype("i8"))
    alive, floor_at, pre = None, np.full(len(q), -np.inf), min(len(x), SEEDS * k)
    for level in LEVELS:
        b = bounds(q, level) @ bounds(x, level).T
        b += np.abs(b) * 1e-9 + 1e-6
        if alive is None:  # the first threshold, from the rows most promising at the coarsest level
            for i in range(len(q)):
                some = np.argpartition(-b[i], pre - 1)[:pre] if pre < len(x) else np.arange(len(x))
                got = (xi[some] @ qi[i])[ids[some] != qids[i]]
                if len(got) >= k:
                    floor_at[i] = np.partition(got, len(got) - k)[len(got) - k]
            alive = b >= floor_at[:, None]
        else:
            alive &= b >= floor_at[:, None]
    for i in range(len(q)):
        some = np.flatnonzero(alive[i] & (ids != qids[i]))
        got = xi[some] @ qi[i]
        best = np.lexsort((ids[some], -got))[:k]
        yield qids[i], ids[some][best], got[best].astype("i8")


def top_k(df: DataFrame, is_query: Column, k: int = 20, scale: float = 64.0,
          id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, id, score of the k largest inner products of every row
    for which ``is_query`` (an expression over ``id``) holds."""
    rows = id_vectors(df, id_col, vec_col)
    queries = rows.where(is_query)
    n_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    salts = max(1, -(-4 * shuffle_partitions(df.sparkSession) // n_blocks))
    # queries are dealt to blocks by id, then each block meets each salt of the candidates
    qb = (queries.withColumn("__qb", F.pmod(F.xxhash64("id"), F.lit(n_blocks)))
          .repartition(n_blocks, "__qb"))
    qb = packed(qb, QUERY_BLOCK, scale).toDF("qids", "qvals", "dim", "qn")
    qb = qb.withColumn("__q", F.xxhash64("qids")).withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    cb = packed(rows, ROW_BLOCK, scale).withColumn("__salt", F.pmod(F.xxhash64("ids"), F.lit(salts)).cast("int"))
    pairs = cb.join(qb, ["__salt", "dim"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                get = lambda c: b.column(c)[r].as_py()
                dim = get("dim")
                load = lambda c, kind="<i8": np.frombuffer(get(c), kind)
                got = list(block_topk(load("qids"), load("qvals").reshape(-1, dim).astype("f8"),
                                      load("ids"), load("vals").reshape(-1, dim).astype("f8"), k))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([np.full(len(v), i) for i, v, _ in got]), pa.int64()),
                     pa.array(np.concatenate([v for _, v, _ in got]), pa.int64()),
                     pa.array(np.concatenate([s for _, _, s in got]), pa.int64())],
                    names=["query_id", "id", "score"])

    near = pairs.select("qids", "qvals", "ids", "vals", "dim").mapInArrow(run, "query_id long, id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "id")
    return (near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))

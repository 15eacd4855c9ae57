"""Approximate nearest neighbours by NN-descent and greedy graph search.

*Graph.*  Every distinct vector is a node with its ``NEIGHBOURS`` nearest
nodes found so far.  The first neighbours come from ``TREES`` random
hyperplane partitions into cells of about ``CELL`` nodes (a fuller cell is
split by a hash of the id), in which distances are exact.  Then rounds of
NN-descent: each node introduces its ``SAMPLE`` nearest forward and reverse
neighbours to each other (a join of neighbours of neighbours); pairs that
improve one's list go into it.  It ends when a round lessens the sum of all
distances by less than the share ``STILL``.  Reverse lists are cut to the ``SAMPLE`` nearest, as
the method has it, so a hub introduces no more nodes than any other.  Nodes
that are left with fewer neighbours than there are (outliers alone in their
cells) are compared with all nodes of their length.

*Search.*  A query starts at its node's neighbours and goes on greedily: of
its ``BEAM`` nearest nodes so far, those not yet expanded are expanded through
the graph, until all of them are.

Copies of a vector are one node; a node stands for its copies in the result,
of which the ``k + 1`` least ids can be among the nearest.

Defined results: vectors that are null, empty, all zero or hold null or
non-finite components, and rows with a null id, take no part; only vectors of
equal length are neighbours; ties go to the smaller id; equal rows (id and
vector) count once; fewer than k candidates are all given; an empty table
gives no rows; further columns are ignored.  The distances are exact, in
double precision on the vectors given.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.common import shuffle_partitions, stored
from tripflow.llm.vectors import id_vectors, matrix, not_zero

NEIGHBOURS = 30
SAMPLE = 16
TREES = 6
CELL = 200
STILL = 0.01
ROUNDS = 8  # at most; the graph is only a guide
BEAM = 300


def _signs(nodes: DataFrame, bits_of: dict[int, int], trees: int) -> DataFrame:
    """(tree, cell, id, vec): the sides of random hyperplanes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            dims = b.column("dim").to_numpy(zero_copy_only=False)
            for dim in np.unique(dims):
                part, bits = b.take(pa.array(np.flatnonzero(dims == dim))), bits_of[int(dim)]
                if dim not in planes:
                    planes[dim] = np.random.default_rng(int(dim)).standard_normal((int(dim), bits * trees))
                side = (matrix(part.column("vec")) @ planes[dim] > 0).reshape(len(part), trees, bits)
                cell = side @ (1 << np.arange(bits, dtype="i8")) if bits else np.zeros((len(part), trees), "i8")
                for t in range(trees):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(part), t, "i4")), pa.array(cell[:, t] * 65536 + int(dim)),
                         part.column("id"), part.column("vec")], names=["tree", "cell", "id", "vec"])

    kind = nodes.schema["vec"].dataType.simpleString()
    return nodes.select("id", "vec", "dim").mapInArrow(run, f"tree int, cell long, id long, vec {kind}")


def _grouped(rows: DataFrame, keys: list[str], limit: bool) -> DataFrame:
    """(a, b, d): pairs of members of a group; ``limit``: the nearest of each
    member, else only those nearer than the member's ``far``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ms = batch.column("ms")[r].values
                ids, once = np.unique(ms.field("id").to_numpy(), return_index=True)
                m = matrix(ms.field("vec"))[once]
                n = len(ids)
                if n < 2:
                    continue
                d = ((m * m).sum(1)[:, None] + (m * m).sum(1) - 2 * (m @ m.T)).clip(min=0)
                np.fill_diagonal(d, np.inf)
                if limit:
                    k = min(NEIGHBOURS, n - 1)
                    col = np.argpartition(d, k - 1, axis=1)[:, :k]
                    row = np.repeat(np.arange(n), k)
                    col = col.ravel()
                else:
                    row, col = np.nonzero(d < ms.field("far").to_numpy()[once][:, None])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[row]), pa.array(ids[col]), pa.array(d[row, col])], names=["a", "b", "d"])

    parts = ["id", "vec"] if limit else ["id", "far", "vec"]
    groups = rows.groupBy(*keys).agg(F.collect_list(F.struct(*parts)).alias("ms")).select("ms")
    return groups.mapInArrow(run, "a long, b long, d double")


def _nearest(pairs: DataFrame, k: int, by: str = "a", to: str = "b") -> DataFrame:
    near = Window.partitionBy(by).orderBy("d", to)
    return pairs.withColumn("__r", F.row_number().over(near)).where(F.col("__r") <= k).drop("__r")


def _lists(pairs: DataFrame) -> DataFrame:
    """(a, b, d): the neighbours of every node, from pairs with repeats."""
    dealt = pairs.repartition(shuffle_partitions(pairs.sparkSession), "a")
    return _nearest(dealt.groupBy("a", "b").agg(F.min("d").alias("d")), NEIGHBOURS)


def _exact_lists(nodes: DataFrame, graph: DataFrame, sizes: DataFrame) -> DataFrame:
    """(a, b, d) between nodes with too short lists and all nodes of their
    length, both ways; all are dealt to as many parts as there are tasks."""
    n = shuffle_partitions(nodes.sparkSession)
    listed = graph.groupBy("a").agg(F.count(F.lit(1)).alias("listed")).withColumnRenamed("a", "id")
    short = (nodes.join(F.broadcast(sizes), "dim").join(listed, "id", "left")
             .where(F.coalesce("listed", F.lit(0)) < F.least(F.lit(NEIGHBOURS), F.col("n") - 1)))
    short = short.select(F.col("id").alias("q"), F.col("vec").alias("qv"), "dim",
                         F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("part"))
    every = nodes.select(F.col("id").alias("b"), "vec", "dim", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int").alias("part"))
    pairs = _measured(every.join(short, ["dim", "part"]).where(F.col("q") != F.col("b")))
    pairs = stored(pairs.select(F.col("q").alias("a"), "b", (F.col("d") * F.col("d")).alias("d")))
    return pairs.union(pairs.select("b", "a", "d"))


def knn_graph(nodes: DataFrame) -> DataFrame:
    """(a, b, d): each node (id, vec, dim) with its neighbours and squared
    distances (a guide for the search, in the precision of a product)."""
    sizes = stored(nodes.groupBy("dim").agg(F.count(F.lit(1)).alias("n")))
    bits = {r["dim"]: max(0, min(40, int(math.log2(max(1, r["n"] / CELL))))) for r in sizes.collect()}
    cells = _signs(nodes, bits, TREES)
    full = (cells.groupBy("tree", "cell").agg(F.count(F.lit(1)).alias("n"))
            .select("tree", "cell", F.ceil(F.col("n") / (2 * CELL)).cast("long").alias("parts")))
    cells = cells.join(full, ["tree", "cell"]).withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    graph = stored(_lists(_grouped(cells, ["tree", "cell", "part"], True)))
    vecs = nodes.select("id", "vec")
    last = graph.agg(F.sum("d")).first()[0]
    for _ in range(ROUNDS):
        far = graph.groupBy("a").agg(F.max("d").alias("far"), F.count(F.lit(1)).alias("n"))
        far = far.select(F.col("a").alias("id"), F.when(F.col("n") < NEIGHBOURS, F.lit(float("inf")))
                         .otherwise(F.col("far")).alias("far"))
        member = (_nearest(graph, SAMPLE).select(F.col("a").alias("v"), F.col("b").alias("id"))
                  .union(_nearest(graph, SAMPLE, "b", "a").select(F.col("b").alias("v"), F.col("a").alias("id")))
                  .union(far.select(F.col("id").alias("v"), "id")))
        member = member.join(vecs.join(far, "id"), "id")
        graph = stored(_lists(graph.union(_grouped(member, ["v"], False))))
        total = graph.agg(F.sum("d")).first()[0]
        if total is None or total >= last * (1 - STILL):
            break
        last = total
    more = _exact_lists(nodes, graph, sizes)
    return graph if more.isEmpty() else stored(_lists(graph.union(more)))


def _measured(pairs: DataFrame) -> DataFrame:
    """(q, b, d): the Euclidean distance of qv and vec."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            dims = b.column("dim").to_numpy(zero_copy_only=False)
            d = np.empty(len(dims))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                part = b.take(pa.array(at))
                d[at] = np.sqrt(((matrix(part.column("qv")) - matrix(part.column("vec"))) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays([b.column("q"), b.column("b"), pa.array(d)], names=["q", "b", "d"])

    return pairs.select("q", "b", "qv", "vec", "dim").mapInArrow(run, "q long, b long, d double")


def search(queries: DataFrame, graph: DataFrame, nodes: DataFrame, beam: int = BEAM) -> DataFrame:
    """(q, b, d): the nodes found for each query node (q, qv, dim)."""
    adjacent = graph.select(F.col("a").alias("at"), "b")
    vecs = nodes.select(F.col("id").alias("b"), "vec", "dim")
    order = Window.partitionBy("q").orderBy("d", "b")

    n = shuffle_partitions(graph.sparkSession)
    begun = queries.select("q", F.col("q").alias("b"), F.lit(0.0).alias("d"), F.lit(False).alias("done"))
    beamed = stored(begun)
    while True:
        front = beamed.where(~F.col("done"))
        if front.isEmpty():
            return beamed.where(F.col("q") != F.col("b")).select("q", "b", "d")
        new = (front.select("q", F.col("b").alias("at")).join(adjacent, "at").select("q", "b")
               .join(vecs, "b").join(queries, ["q", "dim"]))
        both = (beamed.withColumn("done", F.lit(True))
                .unionByName(_measured(new).withColumn("done", F.lit(False))).repartition(n, "q")
                .groupBy("q", "b").agg(F.min("d").alias("d"), F.max("done").alias("done")))
        beamed = stored(both.withColumn("r", F.row_number().over(order)).where(F.col("r") <= beam).drop("r"))


def nearest_neighbours(df: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id",
                       vec_col: str = "embedding") -> DataFrame:
    """query_id, rank, id, score: for every row for which ``is_query`` (an
    expression over ``id``) holds, the k nearest other rows found."""
    rows = id_vectors(df, id_col, vec_col).where(not_zero(F.col("vec")))
    copies = stored(rows.groupBy("vec", "dim").agg(F.min("id").alias("node")).join(
        rows.select("id", "vec", "dim"), ["vec", "dim"]).select("node", "id", "dim", "vec").distinct())
    nodes = copies.where(F.col("node") == F.col("id")).select("id", "vec", "dim")
    graph = knn_graph(nodes.repartition(shuffle_partitions(df.sparkSession), "id"))
    asked = copies.where(is_query).select(F.col("id").alias("query_id"), F.col("node").alias("q"))
    queries = asked.select("q").distinct().join(
        nodes.select(F.col("id").alias("q"), F.col("vec").alias("qv"), "dim"), "q")
    found = search(stored(queries), graph, nodes)
    found = _nearest(found, k, "q", "b").union(
        queries.select("q", F.col("q").alias("b"), F.lit(0.0).alias("d")))
    least = Window.partitionBy("node").orderBy("id")
    some = (copies.select(F.col("node").alias("b"), "id", F.row_number().over(least).alias("r"))
            .where(F.col("r") <= k + 1).drop("r"))
    out = (asked.join(found, "q").join(some, "b").where(F.col("id") != F.col("query_id"))
           .withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("d", "id"))))
    return out.where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), F.col("d").alias("score"))

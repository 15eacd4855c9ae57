"""Mixing sources to target weights by Pfair scheduling.

Every source is a stream of blocks of ``block_rows`` rows in a fixed
pseudo-random order.  A source of weight w (weights add up to 1) must own its
j-th block (from 0) in the slots ``[floor(j / w), ceil((j + 1) / w))``: its
release time and its deadline.  In every slot the released block with the
earliest deadline runs (ties: the successor-bit rule of Pfair scheduling, then
the larger weight, then the name), so after any number t of slots a source
has got ``t * w`` blocks to within one.

Weights are taken as they are given: releases and deadlines are exact integer
quotients, so no rounding adds up over the slots and any number of sources
keeps its targets.  The schedule is made slot by slot by one task (some
microseconds a block, not a row) and stored as a table that rows find their
slot in.  When a source runs out of blocks a new phase begins with the weights
of the sources that are left, so no row is dropped and the bound holds in
every phase.

Defined results: a null source is a source of its own (``NULL_SOURCE``), rows
that are equal in id get distinct places (by a hash of the text, then the carried
columns), a weight of zero or
an unknown source puts the rows behind all weighted sources (equal weights
there), an empty table gives no rows, and columns other than the id, source
and those asked for are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tripflow.llm.common import stored

PERIOD = 1000
BLOCK_ROWS = 16
# Target share of a source when none is given: its share of rows to this power.
ALPHA = 0.5
# Rows ranked by one task at a time (expected).
BUCKET_ROWS = 100_000
# Blocks of a source in one row of the schedule's table.
CHUNK = 4096
NULL_SOURCE = "\u0000null"


def quantise(weights: dict[str, float], period: int = PERIOD) -> dict[str, int]:
    """Slots of each source in one period: largest remainder, at least one (for
    a caller that wants a schedule that repeats; ``mix_sources`` does not round)."""
    total = math.fsum(weights.values())
    if len(weights) > period:
        period = len(weights)
    shares = {s: max(Fraction(1), Fraction(w / total) * period) for s, w in weights.items()}
    over = sum(shares.values())
    room = period - len(shares)
    spread = over - len(shares)
    exact = {s: 1 + ((x - 1) * room / spread if spread else Fraction(room, len(shares)))
             for s, x in shares.items()}
    slots = {s: int(x) for s, x in exact.items()}
    left = period - sum(slots.values())
    for s in sorted(exact, key=lambda s: (slots[s] - exact[s], s))[:left]:
        slots[s] += 1
    return slots


def pfair_period(slots: dict[str, int]) -> dict[str, list[int]]:
    """The slots of one period that each source gets, earliest deadline first."""
    period = sum(slots.values())
    got: dict[str, list[int]] = {s: [] for s in slots}
    for t in range(period):
        best = None
        for s, e in slots.items():
            j = len(got[s])
            if j >= e or j * period // e > t:
                continue
            deadline = -(-(j + 1) * period // e)
            overlap = deadline > (j + 1) * period // e
            key = (deadline, not overlap, -e, s)
            if best is None or key < best[0]:
                best = (key, s)
        if best is not None:
            got[best[1]].append(t)
    return got


def schedule(counts: dict[str, int], weights: dict[str, float],
             block_rows: int = BLOCK_ROWS) -> Iterator[tuple[int, int, str, int]]:
    """(slot, phase, source, block) of every block, slot by slot."""
    left = {s: -(-n // block_rows) for s, n in counts.items() if n > 0}
    done = dict.fromkeys(left, 0)
    slot = phase = 0
    while left:
        use = {s: weights.get(s, 0.0) for s in left if weights.get(s, 0.0) > 0} or dict.fromkeys(left, 1.0)
        exact = {s: Fraction(repr(float(w))) for s, w in use.items()}  # 0.05 is 1/20
        unit = math.lcm(*(w.denominator for w in exact.values()))
        part = {s: int(w * unit) for s, w in exact.items()}
        whole = sum(part.values())
        got = dict.fromkeys(use, 0)
        later, ready, t, full = [(0, s) for s in sorted(use)], [], 0, True
        while full:
            while later and later[0][0] <= t:
                s = heapq.heappop(later)[1]
                deadline, over = divmod((got[s] + 1) * whole, part[s])
                heapq.heappush(ready, (deadline + (over > 0), over == 0, -part[s], s))
            s = heapq.heappop(ready)[-1]
            yield slot, phase, s, done[s]
            got[s] += 1
            done[s] += 1
            left[s] -= 1
            heapq.heappush(later, (got[s] * whole // part[s], s))
            slot, t, full = slot + 1, t + 1, left[s] > 0
        del left[s]
        phase += 1


def _scheduled(spark: SparkSession, counts: dict[str, int], weights: dict[str, float],
               block_rows: int) -> DataFrame:
    """(__s, __chunk, __at): phase and slot of ``CHUNK`` blocks of a source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("phase", pa.int64()), ("slot", pa.int64())]))

        def row(s: str, last: int, at: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([s]), pa.array([last // CHUNK], pa.int64()), pa.array([at], kind)],
                names=["__s", "__chunk", "__at"])

        for batch in batches:
            if not batch.num_rows:
                continue
            open_: dict[str, list] = {}
            last: dict[str, int] = {}
            for slot, phase, s, block in schedule(counts, weights, block_rows):
                at = open_.setdefault(s, [])
                at.append((phase, slot))
                last[s] = block
                if len(at) == CHUNK:
                    yield row(s, block, open_.pop(s))
            for s, at in open_.items():
                yield row(s, last[s], at)

    one = spark.range(0, 1, 1, 1)
    return stored(one.mapInArrow(run, "__s string, __chunk long, __at array<struct<phase:long,slot:long>>"))


def _order_key(id_col: str, text_hash: str, seed: int) -> Column:
    """The place of a row in its source's order; rows without an id, or with a
    repeated one, are dealt to buckets by their text."""
    return F.xxhash64(F.col(id_col), F.col(text_hash), F.lit(seed))


def mix_sources(docs: DataFrame, weights: dict[str, float] | None = None,
                block_rows: int = BLOCK_ROWS, id_col: str = "doc_id", source_col: str = "source",
                carry: list[str] | None = None, seed: int = 7, text_col: str = "text") -> DataFrame:
    """One row per input row: id, source, block, phase, slot, place in the
    block, and the columns named in ``carry``.

    ``weights`` maps a source (null: ``NULL_SOURCE``) to its target; without
    it every source weighs ``rows ** ALPHA``.  Sorting the rows by
    ``(slot, place)`` is the mixture.  The row counts of the sources (one
    short row a source) are read by the driver; the rows are ranked in
    buckets of a source's hash order, so a hot source is ranked by many tasks.
    """
    spark = docs.sparkSession
    carry = [c for c in carry or [] if c not in (id_col, source_col)]
    base = docs.select(
        F.col(id_col).cast("long").alias("__id"), F.col(source_col).cast("string").alias("__source"),
        (F.xxhash64(F.col(text_col).cast("string")) if text_col in docs.columns else F.lit(0)).alias("__t"),
        *[F.col(c).alias(f"__c{i}") for i, c in enumerate(carry)])
    base = (base.withColumn("__s", F.coalesce("__source", F.lit(NULL_SOURCE)))
            .withColumn("__h", _order_key("__id", "__t", seed)))
    counts = {r["__s"]: r["n"] for r in base.groupBy("__s").agg(F.count(F.lit(1)).alias("n")).collect()}
    target = weights if weights is not None else {s: n ** ALPHA for s, n in counts.items()}
    table = _scheduled(spark, counts, target, block_rows)

    # rank within the source: rows of the buckets before, then the place in the bucket
    size = spark.createDataFrame(
        [(s, max(1, -(-n // BUCKET_ROWS))) for s, n in counts.items()], "__s string, __nb long")
    at = (F.col("__h").cast("double") + float(1 << 63)) / float(1 << 64)
    base = (base.join(F.broadcast(size), "__s")
            .withColumn("__b", F.floor(at * F.col("__nb")).cast("long")))
    before = (base.groupBy("__s", "__b").agg(F.count(F.lit(1)).alias("__n"))
              .withColumn("__before", F.coalesce(F.sum("__n").over(
                  Window.partitionBy("__s").orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)),
                  F.lit(0))).drop("__n"))
    order = [F.col("__h"), F.col("__id")] + [F.col(f"__c{i}") for i in range(len(carry))
                                             if _sortable(docs.schema[carry[i]].dataType)]
    ranked = base.withColumn("__r", F.row_number().over(
        Window.partitionBy("__s", "__b").orderBy(*order)) - 1)
    ranked = ranked.join(before, ["__s", "__b"]).withColumn("__rank", F.col("__before") + F.col("__r"))
    ranked = ranked.withColumn("__block", F.floor(F.col("__rank") / block_rows).cast("long"))

    ranked = ranked.withColumn("__chunk", F.floor(F.col("__block") / CHUNK).cast("long"))
    out = ranked.join(table, ["__s", "__chunk"])
    out = out.withColumn("__p", F.get("__at", F.pmod("__block", F.lit(CHUNK)).cast("int")))
    return out.select(
        F.col("__id").alias(id_col), F.col("__source").alias(source_col),
        F.col("__block").alias("block"), F.col("__p.phase").alias("phase"),
        F.col("__p.slot").alias("slot"), F.pmod("__rank", F.lit(block_rows)).cast("int").alias("place"),
        *[F.col(f"__c{i}").alias(c) for i, c in enumerate(carry)])


def _sortable(kind: T.DataType) -> bool:
    return not isinstance(kind, (T.MapType, T.VariantType))


def mixture(docs: DataFrame, weights: dict[str, float] | None = None,
            block_rows: int = BLOCK_ROWS, id_col: str = "doc_id",
            source_col: str = "source") -> DataFrame:
    """The rows of ``docs`` in the order of the mixture (range-sorted by slot)."""
    others = [c for c in docs.columns if c not in (id_col, source_col)]
    mixed = mix_sources(docs, weights, block_rows, id_col, source_col, carry=others)
    return mixed.orderBy("slot", "place").select(*docs.columns)

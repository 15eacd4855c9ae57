"""Ranked lexical search with range-maximum tables over posting lists.

1. *Index.*  Each task cuts its documents into shards of bounded size and
   writes, per shard, the posting lists of the query terms (of all terms, when
   the queries' vocabulary is too large to be sent to the tasks) and one row
   with the documents' ids and lengths.  Documents of a shard stand in the
   order of their ids.
2. *Statistics.*  N, L and the document frequencies are aggregates over the
   index: shards and postings, not documents.
3. *Search.*  A shard's lists become one array of impacts with one sparse
   table of range maxima above it.  For a query, an interval of documents is
   bounded by the sum, over its terms, of weight times the range maximum of
   the term's postings inside the interval.  Intervals are taken best first:
   the document with the largest single contribution is scored exactly, and
   the interval is split at it; each remaining part gets its own bound.  Small
   intervals are scored whole.  An interval is dropped once its bound is below
   the k-th best score (or equal to it, with only larger ids).
4. The shards of a task share the k-th best score; the task emits k documents
   a query, which a window over them reduces to the answer.

Queries are answered per distinct text in blocks of at most ``BLOCK_BYTES`` on
average (by a hash of the text), every block against all shards.  Nothing
depends on how documents meet in shards: each score is exact and ties go to
the smaller id, null ids last, equal ids in any order.

Defined results: a null or empty text has no terms; documents without terms
are not counted in N; items without a term that occurs get no rows; equal item
rows each get their own rows; a term that a query repeats counts as often;
further columns are ignored; empty tables give no rows.  A very long text is
one document of a shard of its own, if need be.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm.common import shuffle_partitions, stored

SHARD_DOCS = 8192  # documents in a shard, at most
SHARD_POSTINGS = 1 << 19  # distinct terms of all its documents, where one more fits
VOCABULARY_BYTES = 32 << 20  # largest vocabulary that is sent to the tasks
BLOCK_BYTES = 4 << 20  # query texts answered together
LEAF = 2048  # postings of an interval that is scored whole
_BITS = 20  # of a position inside a shard's posting list

# Bytes of terms: digits, letters (A-Z lower-cased) and all of a non-ASCII character.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
              for b in range(256))

# n: documents of the shard or of the list; total: occurrences of terms in the shard
_INDEX = "shard long, term binary, n int, total long, docs binary, tfs binary, ids binary, lens binary"


def terms(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


def _shard_rows(shard: int, ids: list[int], lens: list[int], lists: dict) -> Iterator[tuple]:
    """The index rows of a shard, its documents put in the order of ids."""
    order = np.argsort(np.array(ids, "i8"), kind="stable")
    place = np.empty(len(order), "i4")
    place[order] = np.arange(len(order), dtype="i4")
    yield (shard, None, len(ids), sum(lens), None, None,
           np.array(ids, "i8")[order].tobytes(), np.array(lens, "i8")[order].tobytes())
    for term, flat in lists.items():
        pairs = np.array(flat, "i4").reshape(-1, 2)
        at = place[pairs[:, 0]]
        by = np.argsort(at)
        yield (shard, term, len(at), None, at[by].tobytes(), pairs[by, 1].tobytes(), None, None)


def _batches(rows: Iterable[tuple], size: int = 4096) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.binary(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
    names = [c.split()[0] for c in _INDEX.split(", ")]
    rows = iter(rows)
    while part := list(itertools.islice(rows, size)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*part, strict=True), types, strict=True)], names=names)


def index(docs: DataFrame, vocabulary: frozenset[bytes] | None = None, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """Index rows: per shard one with ids and lengths (term null), and one a
    term with the places and counts of its documents."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        ids, lens, lists, size = [], [], {}, 0
        for b in batches:
            for key, text in zip(b.column("k").to_pylist(), b.column("t").to_pylist(), strict=True):
                words = terms(text)
                if not words:
                    continue
                tf = Counter(words)
                if ids and (len(ids) >= SHARD_DOCS or size + len(tf) > SHARD_POSTINGS):
                    yield from _shard_rows(next(numbers), ids, lens, lists)
                    ids, lens, lists, size = [], [], {}, 0
                here = tf if vocabulary is None else tf.keys() & vocabulary
                for w in here:
                    lists.setdefault(w, []).extend((len(ids), tf[w]))
                ids.append(key)
                lens.append(len(words))
                size += len(tf)
        if ids:
            yield from _shard_rows(next(numbers), ids, lens, lists)

    # null ids sort last: their key is mapped from the least to the largest long
    key = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1))
    return docs.select(key.alias("k"), F.col(text_col).cast("string").alias("t")).mapInArrow(
        lambda batches: _batches(shards(batches)), _INDEX)


class _Shard:
    """Posting lists of one shard, flat, with a sparse table of range maxima
    (impact, then the leftmost posting)."""

    def __init__(self, ids: bytes, lens: bytes, lists: list[tuple], n: int, total: int):
        self.ids = np.frombuffer(ids, "i8")
        m = 25 + (75 * np.frombuffer(lens, "i8") * n) // total
        docs = [np.frombuffer(d, "i4").astype("i8") for _, d, _ in lists]
        tfs = [np.frombuffer(t, "i4").astype("i8") for _, _, t in lists]
        self.number = {w: i for i, (w, _, _) in enumerate(lists)}
        self.start = np.concatenate([[0], np.cumsum([len(d) for d in docs])]).astype("i8")
        self.doc = np.concatenate(docs) if docs else np.zeros(0, "i8")
        tf = np.concatenate(tfs) if tfs else np.zeros(0, "i8")
        self.impact = (1_000_000_000 * tf) // (1000 * tf + 8 * m[self.doc])
        size = len(self.doc)
        of = np.repeat(np.arange(len(docs)), np.diff(self.start))
        self.key = (of << 40) | self.doc  # ascending: list, then document
        first = (self.impact << _BITS) | ((1 << _BITS) - 1 - (np.arange(size) - self.start[of]))
        self.table = [first]
        longest = int(np.diff(self.start).max(initial=0))
        step = 1
        while 2 * step <= longest:
            prev = self.table[-1]
            nxt = prev.copy()
            np.maximum(prev[:size - step], prev[step:], out=nxt[:size - step])
            self.table.append(nxt)
            step *= 2
        self.flat = np.concatenate(self.table)
        self.size = size

    def maxima(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Range maxima of [a, b), which are not empty."""
        level = np.frexp((b - a).astype("f8"))[1] - 1
        row = level.astype("i8") * self.size
        return np.maximum(self.flat[row + a], self.flat[row + b - (np.int64(1) << level)])

    def search(self, words: list[bytes], weight: np.ndarray, k: int, best: list, leaf: int = LEAF) -> None:
        """Put this shard's documents into ``best``, a heap of the k best
        (score, -id) so far."""
        have = [j for j, w in enumerate(words) if w in self.number]
        if not have:
            return
        lists = np.array([self.number[words[j]] for j in have], "i8")
        a, b, w = self.start[lists], self.start[lists + 1], weight[have]
        ids = self.ids

        def offer(score: int, doc: int) -> None:
            entry = (score, -int(ids[doc]))
            if len(best) < k:
                heapq.heappush(best, entry)
            elif entry > best[0]:
                heapq.heapreplace(best, entry)

        def hopeless(bound: int, lo: int) -> bool:
            return len(best) == k and (bound, -int(ids[lo])) <= best[0]

        tick = itertools.count()

        def add(lo: int, lists: np.ndarray, w: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
            live = a < b
            if not live.all():
                lists, w, a, b = lists[live], w[live], a[live], b[live]
            if not len(a):
                return
            if int((b - a).sum()) <= leaf:
                at = np.repeat(a - np.concatenate([[0], np.cumsum(b - a)[:-1]]), b - a) + np.arange(int((b - a).sum()))
                found, inverse = np.unique(self.doc[at], return_inverse=True)
                score = np.zeros(len(found), "i8")
                np.add.at(score, inverse, np.repeat(w, b - a) * self.impact[at])
                for i in np.lexsort((found, -score))[:k]:
                    if hopeless(int(score[i]), int(found[i])):
                        break
                    if score[i] > 0:
                        offer(int(score[i]), int(found[i]))
                return
            top = self.maxima(a, b)
            part = w * (top >> _BITS)
            bound = int(part.sum())
            if bound > 0 and not hopeless(bound, lo):
                heapq.heappush(heap, (-bound, lo, next(tick), lists, w, a, b, top, part))

        heap: list[tuple] = []
        add(0, lists, w, a, b)
        while heap:
            bound, lo, _, lists, w, a, b, top, part = heapq.heappop(heap)
            if len(best) == k and -bound < best[0][0]:
                return
            if hopeless(-bound, lo):
                continue
            j = int(part.argmax())
            offset = (1 << _BITS) - 1 - (int(top[j]) & ((1 << _BITS) - 1))
            doc = int(self.doc[int(self.start[lists[j]]) + offset])
            want = (lists << 40) | doc
            cut = np.searchsorted(self.key, want)
            inside = cut < b
            hit = np.zeros(len(cut), bool)
            hit[inside] = self.key[cut[inside]] == want[inside]
            score = int((w[hit] * self.impact[cut[hit]]).sum())
            if score > 0:
                offer(score, doc)
            add(lo, lists, w, a, cut)
            if doc + 1 < len(ids):
                add(doc + 1, lists, w, cut + hit, b)


def weight_of(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    rows: list[dict] = []
    for b in batches:
        for r in b.to_pylist():
            if rows and rows[0]["shard"] != r["shard"]:
                yield rows
                rows = []
            rows.append(r)
    if rows:
        yield rows


def search(shards: DataFrame, queries: dict[int, list[tuple[bytes, int]]], n: int, total: int, k: int,
           leaf: int = LEAF) -> DataFrame:
    """(q, key, score): the k best of each task for every query of a block,
    given as terms and weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list] = {q: [] for q in queries}
        plan = {q: ([t for t, _ in ws], np.array([w for _, w in ws], "i8")) for q, ws in queries.items()}
        for rows in _by_shard(batches):
            head = next(r for r in rows if r["term"] is None)
            lists = sorted((r["term"], r["docs"], r["tfs"]) for r in rows if r["term"] is not None)
            if not lists:
                continue
            shard = _Shard(head["ids"], head["lens"], lists, n, total)
            for q, (words, weight) in plan.items():
                shard.search(words, weight, k, best[q], leaf)
        out = [(q, -i, s) for q, heap in best.items() for s, i in heap]
        cols = list(zip(*out, strict=True)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["q", "key", "score"])

    parts = shuffle_partitions(shards.sparkSession)  # shards are of bounded size: no key is hot
    return (shards.repartition(parts, "shard").sortWithinPartitions("shard")
            .mapInArrow(run, "q long, key long, score long"))


def rank(docs: DataFrame, items: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text",
         item_col: str = "item_id", item_text_col: str = "text", leaf: int = LEAF) -> DataFrame:
    """(item, rank, id, score): the k best documents for every item."""
    spark = docs.sparkSession
    item_text = F.coalesce(F.col(item_text_col).cast("string"), F.lit(""))
    asked = items.select(F.col(item_col), F.xxhash64(item_text).alias("q"), item_text.alias("t"))
    texts = stored(asked.dropDuplicates(["q"]).select("q", "t"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    blocks = 1 + size // BLOCK_BYTES
    vocabulary = None
    if size <= VOCABULARY_BYTES:
        vocabulary = frozenset(w for r in texts.select("t").toLocalIterator() for w in terms(r["t"]))
    shards = stored(index(docs, vocabulary, id_col, text_col))
    heads = shards.where(F.col("term").isNull())
    n, total = heads.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    found = None
    for block in range(blocks):
        here = {r["q"]: Counter(terms(r["t"])) for r in
                texts.where(F.pmod("q", F.lit(blocks)) == block).toLocalIterator()}
        words = sorted({w for c in here.values() for w in c})
        if not words or not n:
            continue
        named = spark.createDataFrame([(w,) for w in words], "term binary")
        lists = shards if vocabulary is not None and blocks == 1 else shards.where(
            F.col("term").isNull()).unionByName(shards.join(named, "term", "left_semi").select(*shards.columns))
        df = {bytes(t): f for t, f in lists.where(F.col("term").isNotNull()).groupBy("term")
              .agg(F.sum("n")).toLocalIterator()}
        queries = {q: [(t, c * weight_of(n, df[t])) for t, c in tf.items() if t in df]
                   for q, tf in here.items()}
        part = search(lists, queries, n, total, k, leaf)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = spark.createDataFrame([], "q long, key long, score long")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "key")
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    null_last = F.when(F.col("key") != (1 << 63) - 1, F.col("key"))
    return asked.select(item_col, "q").join(top, "q").select(
        item_col, "rank", null_last.alias(id_col), "score")


def oracle_sql(k: int = 10) -> str:
    """DuckDB SQL for ``rank`` over ``documents`` and ``benchmark``."""
    split = ("regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")
    return f"""
WITH d AS (SELECT doc_id, len({split}) AS n, {split} AS ts FROM documents),
held AS (SELECT doc_id, n, ts, row_number() OVER () AS r FROM d WHERE n > 0),
tot AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM held),
asked AS (SELECT item_id, t, count(*)::BIGINT AS qtf
          FROM (SELECT item_id, unnest({split}) AS t FROM benchmark) GROUP BY 1, 2),
tf AS (SELECT r, t, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS t FROM held)
       WHERE t IN (SELECT t FROM asked) GROUP BY 1, 2),
w AS (SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
      FROM tf, tot GROUP BY t, nn),
m AS (SELECT r, doc_id, (25 + (75 * n * nn) // ll)::BIGINT AS m FROM held, tot),
s AS (SELECT item_id, doc_id, r,
             sum(qtf * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM asked JOIN tf USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY 1, 2, 3),
o AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank,
             doc_id, score FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM o WHERE rank <= {k}"""

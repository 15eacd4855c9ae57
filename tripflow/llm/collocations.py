"""Phrase collocation mining with weighted acyclic automata.

Per language, phrases of two and three words are scored by their count against
the counts of the two parts of their weakest cut.

1. *Shards.*  Each task holds up to ``HELD`` bytes of text, counts the n-grams
   of the language with most of it, at most ``CHUNK`` bytes at a time, and builds
   their automaton (``automata``) from the sorted n-grams.
2. *Union.*  Automata are cut into ``FAN`` prefix ranges and the same range of
   up to ``FAN`` shards is united, weights summed, level by level: every level
   splits finer and unites more shards, so a group stays at about the size of
   a shard however large the corpus is.  A frequent word or phrase is one path
   of each shard, so it is no hot key.
3. *Composition.*  The final automata give the phrases whose count reaches the
   minimum, each with the weight of its two-word prefix, which lies on its own
   path.  The weights of the other parts are on paths of other ranges; a join
   on the part composes them (a part counts no less than the phrase, so none
   is missing).  AQE splits a part that many phrases share.
4. Scores are integers of up to 38 digits; a phrase inside a longer one that
   holds at least half of its occurrences is dropped.

Defined results: a null or empty text has no words; a null language is
``und``; phrases do not cross piece ends or rows; equal rows count each;
further columns are ignored; an empty table gives no rows.  A very long text is
cut at piece ends into shards, and only a piece of its own is never cut.
"""

from __future__ import annotations

import itertools
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tripflow.llm import automata
from tripflow.llm.common import stored

CHUNK = 8 << 20  # bytes of text counted together
HELD = 3 * CHUNK  # bytes of text a task holds before it counts
FAN = 128  # ranges cut and shards united at a level (fewer at the last of several)
MIN_COUNT = 10
TOP = 2000
COVERED = 50  # per cent of a phrase's occurrences inside a longer one

_SHARDS = "lang string, rng long, shard long, blob binary"


def _cut(text: bytes, size: int) -> Iterator[bytes]:
    """Parts of about ``size`` bytes that end at piece ends."""
    start = 0
    while len(text) - start > size:
        end = text.rfind(b"\n", start, start + size)
        if end < start:
            end = text.find(b"\n", start + size)
        if end < 0:
            break
        yield text[start:end]
        start = end + 1
    yield text[start:]


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * 4
    types = [pa.string(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                      names=["lang", "rng", "shard", "blob"])


def count_shards(docs: DataFrame, chunk: int = CHUNK, held_bytes: int = HELD, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rng, shard, blob): the automata of the shards, not yet cut."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = itertools.count(TaskContext.get().partitionId() << 32)
        held: dict[str, list[bytes]] = {}
        size: Counter[str] = Counter()

        def flush(lang: str) -> Iterator[pa.RecordBatch]:
            texts, n = [], 0
            for part in held.pop(lang):
                if texts and n + len(part) > chunk:
                    yield _rows([(lang, 0, next(numbers), bytes(automata.count(texts)))])
                    texts, n = [], 0
                texts.append(part)
                n += len(part) + 1
            yield _rows([(lang, 0, next(numbers), bytes(automata.count(texts)))])

        for b in batches:
            for lang, text in zip(b.column("lang").to_pylist(), b.column("t").to_pylist(), strict=True):
                folded = text.encode("utf-8").translate(automata.FOLD)
                held.setdefault(lang, []).extend(_cut(folded, chunk))
                size[lang] += len(folded) + 1
                if size.total() > held_bytes:
                    largest = max(held, key=size.__getitem__)
                    yield from flush(largest)
                    del size[largest]
        for lang in list(held):
            yield from flush(lang)

    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).cast("string").alias("t")).where(F.octet_length("t") > 0)
    return texts.mapInArrow(run, _SHARDS)


def _split(shards: DataFrame, ranges: int, fan: int) -> DataFrame:
    """The automata cut into ranges, numbered by the group of ``fan`` shards
    that is to be united."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                yield _rows([(r["lang"], rng, r["shard"] // fan, bytes(a))
                             for rng, a in automata.parts(automata.load(r["blob"]), ranges)])

    return shards.mapInArrow(run, _SHARDS)


def _united(batches: Iterator[pa.RecordBatch], chunk: int) -> automata.Automaton:
    """The union of a group's automata, a bounded number of them at a time."""
    held, size, limit = [], 0, max(chunk, 1)
    for b in batches:
        for blob in b.column("blob"):
            a = automata.load(blob.as_py())
            held.append(a)
            size += len(a.c2) + len(a.third)
            if size > limit and len(held) > 1:
                held = [automata.union(held)]
                size = 0
    return automata.union(held) if len(held) > 1 else held[0]


_GRAMS = "lang string, words int, phrase string, a long, head string, rest string, l2 long, last string"


def _frequent(lang: str, a: automata.Automaton, least: int) -> pa.RecordBatch:
    """The n-grams of an automaton with a count of ``least`` or more, and one
    row (words 0) with the number of word occurrences."""
    w = a.words
    rows = [(lang, 0, None, int(a.c1.sum()), None, None, None, None)]
    rows += [(lang, 1, w[i], int(a.c1[i]), None, None, None, None) for i in np.flatnonzero(a.c1 >= least)]
    for i in np.flatnonzero(a.c2 >= least):
        x, y = w[a.first[i]], w[a.second[i]]
        rows.append((lang, 2, x + b" " + y, int(a.c2[i]), x, y, None, None))
    owner, third, c3 = a.arcs3()
    for i in np.flatnonzero(c3 >= least):
        x, y, z = w[a.first[owner[i]]], w[a.second[owner[i]]], w[third[i]]
        rows.append((lang, 3, b" ".join((x, y, z)), int(c3[i]), x, y + b" " + z, int(a.c2[owner[i]]), z))
    names = [c.split()[0] for c in _GRAMS.split(", ")]
    types = [pa.string(), pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.binary()]
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays([x.cast(pa.string()) if x.type == pa.binary() else x for x in arrays], names=names)


def grams(docs: DataFrame, least: int = MIN_COUNT, chunk: int = CHUNK, fan: int = FAN, lang_col: str = "lang",
          text_col: str = "text") -> DataFrame:
    """The n-grams of every language with a count of ``least`` or more."""
    shards = stored(count_shards(docs, chunk, 3 * chunk, lang_col, text_col))
    n = shards.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 1
    fans = [fan]
    while math.prod(fans) < n:
        fans.append(min(fan, math.ceil(n / math.prod(fans))))
    shards = shards.withColumn("shard", F.pmod(F.xxhash64("shard"), F.lit(math.prod(fans))))

    def unite(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _rows([(key[0].as_py(), key[1].as_py(), key[2].as_py(), bytes(_united(batches, chunk)))])

    def finish(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _frequent(key[0].as_py(), _united(batches, chunk), least)

    for level, fan in enumerate(fans, 1):
        groups = _split(shards, math.prod(fans[:level]), fan).groupBy("lang", "rng", "shard")
        if level < len(fans):
            shards = stored(groups.applyInArrow(unite, _SHARDS))
    return groups.applyInArrow(finish, _GRAMS)


def mine(docs: DataFrame, least: int = MIN_COUNT, top: int = TOP, covered: int = COVERED, chunk: int = CHUNK,
         fan: int = FAN, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases a language."""
    found = stored(grams(docs, least, chunk, fan, lang_col, text_col))
    totals = found.where("words = 0").groupBy("lang").agg(F.sum("a").alias("n"))
    counts = found.where("words in (1, 2)").select("lang", F.col("phrase").alias("part"), F.col("a").alias("f"))

    def of_part(df: DataFrame, part: str, name: str, how: str = "inner") -> DataFrame:
        return df.join(counts.withColumnsRenamed({"part": part, "f": name}), ["lang", part], how)

    cand = found.where("words >= 2").select("lang", "words", "phrase", "a", "head", "rest", "l2", "last")
    cand = of_part(of_part(of_part(cand, "head", "l1"), "rest", "r1"), "last", "r2", "left")
    score = "cast(1000000 as decimal(38,0)) * cast(a as decimal(19,0)) * a div (cast({} as decimal(19,0)) * {})"
    cand = cand.withColumns({"s1": F.expr(score.format("l1", "r1")), "s2": F.expr(score.format("l2", "r2"))})
    second = F.col("s2").isNotNull() & (F.col("s2") < F.col("s1"))
    cand = cand.select("lang", "words", "phrase", "a", *(
        F.when(second, F.col(two)).otherwise(F.col(one)).alias(name)
        for one, two, name in (("l1", "l2", "l"), ("r1", "r2", "r"), ("s1", "s2", "score"))))
    inside = (found.where("words = 3")
              .select("lang", F.explode(F.array(F.concat_ws(" ", "head", F.substring_index("rest", " ", 1)), "rest"))
                      .alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer")))
    cand = cand.join(inside, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | (100 * F.col("longer") < covered * F.col("a")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = cand.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle_sql(least: int = MIN_COUNT, top: int = TOP, covered: int = COVERED) -> str:
    """DuckDB SQL for ``mine`` over ``documents``."""
    return f"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang,
                  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
           FROM documents WHERE text IS NOT NULL),
p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM t),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM p),
x AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w WHERE len(ws) > 0),
g AS (SELECT lang, 1 AS k, ws[i] AS phrase FROM x
      UNION ALL SELECT lang, 2, ws[i] || ' ' || ws[i + 1] FROM x WHERE i + 1 <= len(ws)
      UNION ALL SELECT lang, 3, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] FROM x WHERE i + 2 <= len(ws)),
f AS (SELECT lang, k, phrase, count(*)::BIGINT AS f FROM g GROUP BY 1, 2, 3),
n AS (SELECT lang, count(*)::BIGINT AS n FROM g WHERE k = 1 GROUP BY 1),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS v FROM f WHERE k >= 2 AND f >= {least}),
cut AS (SELECT lang, k, phrase, a, 1 AS j, v[1] AS x, array_to_string(v[2:], ' ') AS y FROM c
        UNION ALL SELECT lang, k, phrase, a, 2, v[1] || ' ' || v[2], v[3] FROM c WHERE k = 3),
s AS (SELECT cut.lang, cut.k, cut.phrase, a, j, l.f AS l, r.f AS r,
             ((1000000::HUGEINT * a * a) // (l.f::HUGEINT * r.f))::BIGINT AS score
      FROM cut JOIN f l ON l.lang = cut.lang AND l.phrase = x JOIN f r ON r.lang = cut.lang AND r.phrase = y),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (SELECT lang, unnest([v[1] || ' ' || v[2], v[2] || ' ' || v[3]]) AS phrase, a FROM c WHERE k = 3),
longest AS (SELECT lang, phrase, max(a) AS longer FROM inside GROUP BY 1, 2),
kept AS (SELECT b.* FROM b LEFT JOIN longest USING (lang, phrase)
         WHERE b.k = 3 OR longer IS NULL OR 100 * longer < {covered} * a),
o AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)::BIGINT AS rank,
             phrase, a, l, r, score FROM kept)
SELECT o.lang, rank, phrase, a, l, r, n, score FROM o JOIN n USING (lang) WHERE rank <= {top}"""

"""Removal of repeated substrings by prefix-free parsing.

Every byte covered by a string of ``LENGTH`` bytes that starts at two places
of the corpus is removed.  In corpus (suffix) order such strings are
neighbours whose common prefix has at least ``LENGTH`` bytes; the parse brings
the comparison from positions to phrases.

1. *Triggers.*  Of the rolling hashes of the ``GRAM``-byte strings inside a
   window of ``LENGTH`` bytes the least (leftmost among equals) is the window's
   trigger.  The choice depends on the window's bytes alone, so equal windows
   have their trigger at the same offset; a document has about one trigger in
   170 bytes, and they cut it into phrases.  Windows that share a trigger are
   one entry ``(trigger, first window, last window)`` of the parse.
2. *Dictionary.*  Entries whose trigger string occurs once are unique and drop
   out; the others are looked at in cells of ``CELL`` window starts at fixed
   distances from the trigger.  A cell's *core* are the bytes that all its
   windows share, its *hull* the bytes that any of them covers.  The
   dictionary holds the distinct hulls with their counts, ordered by the
   fingerprint of the core: hulls that share a core are neighbours.
3. *Corpus order.*  A hull that occurs twice is repeated with all its windows;
   a core with a single hull that occurs once is unique.  What is left (the
   edges of repeated passages) is expanded: the windows of one occurrence of
   every distinct hull are put in the order of their fingerprints, where equal
   windows are neighbours.
4. The removed ranges go back to their documents.

The order is that of 128-bit fingerprints, not of letters: equal strings are
neighbours in either, and no rank has to be carried back to every position.
No suffix array of all positions is written (it would be some twenty times
the input); only the undecided ones are ordered one by one.

Equal rows (id and text) are parsed once and count as many times as they occur;
what is found goes to each of them.  So the lists that are gathered per document
are as long as its own parse, however many copies it has.

Hot strings: triggers, hulls and windows are counted with partial aggregates;
what goes back to documents is joined against one row a key, so AQE can split
the large side.  No group of occurrences is ever gathered.

Defined results: a null text is empty; texts shorter than ``length`` lose
nothing; equal rows are documents of their own (their long strings repeat);
null ids stay null; further columns are ignored; an empty table gives no rows.
A text of few distinct windows (say one letter a million times) is thinned in
its own task before anything is shuffled.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import id_key, stored
from tripflow.llm.rolling import U, mixed, of_ranges, prefix, short_ranges, sliding_argmin

LENGTH = 400
GRAM = 64
CELL = 64
SEGMENT = 1 << 20  # window starts looked at together
DENSE = 40  # a segment with a trigger in fewer bytes than this is thinned


def _parse(data: np.ndarray, length: int, gram: int) -> tuple:
    """(trigger hash, trigger, first window, last window) of a stretch of text
    and, apart, the ranges that it repeats itself."""
    n = len(data) - length + 1
    sums = prefix(data)
    pos = np.arange(len(data) - gram + 1, dtype="u8")
    h = of_ranges(sums, pos.astype("i8"), pos.astype("i8") + gram)
    least = sliding_argmin((h & U(0xFFFFFFFF00000000)) | pos, length - gram + 1)
    at = (least & U(0xFFFFFFFF)).astype("i8")
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.concatenate([first[1:] - 1, [n - 1]])
    own = np.zeros((0, 2), "i8")
    if len(first) * DENSE > n + length:
        # few distinct windows: one of each goes on, the others repeat it here
        starts = np.arange(n)
        both = [of_ranges(prefix(data, w), starts, starts + length, w) for w in (0, 1)]
        order = np.lexsort((starts, both[1], both[0]))
        same = (both[0][order][1:] == both[0][order][:-1]) & (both[1][order][1:] == both[1][order][:-1])
        again = np.zeros(n, bool)
        again[order[1:][same]] = True
        twice = again.copy()
        twice[order[:-1][same]] = True
        own = _runs(twice)
        own[:, 1] += length - 1
        keep = ~again
        cut = np.concatenate([[True], (at[1:] != at[:-1]) | (keep[1:] != keep[:-1])])
        first = np.flatnonzero(cut)
        last = np.concatenate([first[1:] - 1, [n - 1]])
        first, last = first[keep[first]], last[keep[first]]
    return h[at[first]].view("i8"), at[first], first, last, own


def _runs(mask: np.ndarray) -> np.ndarray:
    """[start, end) of the runs of true values."""
    edges = np.diff(np.concatenate([[0], mask.astype("i1"), [0]]))
    return np.stack([np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)], axis=1).astype("i8")


def _texts(col: pa.Array) -> Iterator[np.ndarray]:
    for x in col:
        yield np.frombuffer(x.as_py() or b"", "u1")


def _zipped(rows: DataFrame) -> DataFrame:
    """(k1, k2, id, z): the text compressed, as it is shuffled more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = zstandard.ZstdCompressor(level=1)
        for b in batches:
            z = pa.array([c.compress(t) for t in _texts(b.column("text"))], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column("k1"), b.column("k2"), b.column("id"), z],
                                             names=["k1", "k2", "id", "z"])

    return rows.select("k1", "k2", "id", "text").mapInArrow(run, "k1 long, k2 long, id long, z binary")


def _unzip(z: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(z), "u1")


def _ints(rows: list[np.ndarray]) -> list[pa.Array]:
    return [pa.array(x) for x in rows]


def parse(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Entries (k1, k2, n, g, q, lo, hi) of the parse of rows that stand for n
    equal ones; g is null where [lo, hi) is a range that the document repeats
    itself."""
    names = ["k1", "k2", "n", "g", "q", "lo", "hi"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            k1 = b.column("k1").to_numpy()
            k2 = b.column("k2").to_numpy()
            times = b.column("n").to_numpy()
            out = []
            for r, data in enumerate(_texts(b.column("text"))):
                for off in range(0, len(data) - length + 1, SEGMENT):
                    g, q, lo, hi, own = _parse(data[off:off + SEGMENT + length - 1], length, gram)
                    n, m = len(g), len(own)
                    out.append((np.full(n + m, k1[r]), np.full(n + m, k2[r]), np.full(n + m, times[r]),
                                np.concatenate([g, np.zeros(m, "i8")]), np.arange(n + m) >= n,
                                np.concatenate([q, own[:, 0]]) + off, np.concatenate([lo, own[:, 0]]) + off,
                                np.concatenate([hi, own[:, 1]]) + off))
            if out:
                cols = [np.concatenate(c) for c in zip(*out, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0]), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3], mask=cols[4]),
                     *(pa.array(c.astype("i4")) for c in cols[5:])], names=names)

    long_enough = rows.where(F.octet_length("text") >= length)
    return long_enough.select("k1", "k2", "n", "text").mapInArrow(
        run, "k1 long, k2 long, n long, g long, q int, lo int, hi int")


def _cells(q: np.ndarray, lo: np.ndarray, hi: np.ndarray, cell: int) -> tuple:
    """The cells (trigger, number, first window, last window) of entries."""
    near, far = (q - hi) // cell, (q - lo) // cell
    count = far - near + 1
    row = np.repeat(np.arange(len(q)), count)
    c = near[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    edge = q[row] - c * cell
    return edge, c, np.maximum(lo[row], edge - cell + 1), np.minimum(hi[row], edge)


def dictionary_cells(entries: DataFrame, docs: DataFrame, length: int, cell: int) -> DataFrame:
    """(core, h1, h2, k1, k2, n, a, b): cells of the entries, by fingerprints of
    core and hull; a and b are the first and the last window."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            lists = batch.column("es")
            for r in range(batch.num_rows):
                data = _unzip(batch.column("z")[r].as_py())
                es = lists[r].values
                q, lo, hi = (es.field(n).to_numpy().astype("i8") for n in ("q", "lo", "hi"))
                edge, c, a, b = _cells(q, lo, hi, cell)
                core = short_ranges(data, edge, edge + length - cell + 1)
                shape = ((edge - a) * cell + (edge - b)).astype("u8") * U(1 << 20) + c.astype("u8")
                h1 = mixed(short_ranges(data, a, b + length) ^ shape)
                h2 = mixed(short_ranges(data, a, b + length, 1) ^ shape)
                n = len(a)
                out.append((core.view("i8"), h1.view("i8"), h2.view("i8"),
                            *(np.full(n, batch.column(c)[r].as_py()) for c in ("k1", "k2", "n")),
                            a.astype("i4"), b.astype("i4")))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)],
                    names=["core", "h1", "h2", "k1", "k2", "n", "a", "b"])

    per_doc = entries.groupBy("k1", "k2", "n").agg(F.collect_list(F.struct("q", "lo", "hi")).alias("es"))
    return (per_doc.join(docs.dropDuplicates(["k1", "k2"]).select("k1", "k2", "z"), ["k1", "k2"])
            .select("k1", "k2", "n", "z", "es")
            .mapInArrow(run, "core long, h1 long, h2 long, k1 long, k2 long, n long, a int, b int"))


def windows(undecided: DataFrame, docs: DataFrame, length: int) -> DataFrame:
    """(w1, w2, k1, k2, i, single): the fingerprints of the windows a..b."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                data = _unzip(batch.column("z")[r].as_py())
                rs = batch.column("rs")[r].values
                a, b = (rs.field(n).to_numpy().astype("i8") for n in ("a", "b"))
                single = rs.field("single").to_numpy(zero_copy_only=False)
                count = b - a + 1
                row = np.repeat(np.arange(len(a)), count)
                i = a[row] + np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                w = [short_ranges(data, i, i + length, k).view("i8") for k in (0, 1)]
                n = len(i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w[0]), pa.array(w[1]), pa.array(np.full(n, batch.column("k1")[r].as_py())),
                     pa.array(np.full(n, batch.column("k2")[r].as_py())), pa.array(i.astype("i4")),
                     pa.array(single[row])], names=["w1", "w2", "k1", "k2", "i", "single"])

    per_doc = undecided.groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "b", "single")).alias("rs"))
    return (per_doc.join(docs.dropDuplicates(["k1", "k2"]).select("k1", "k2", "z"), ["k1", "k2"])
            .select("k1", "k2", "z", "rs")
            .mapInArrow(run, "w1 long, w2 long, k1 long, k2 long, i int, single boolean"))


def repeated_ranges(rows: DataFrame, docs: DataFrame, length: int = LENGTH, gram: int = GRAM,
                    cell: int = CELL) -> DataFrame:
    """(k1, k2, s, e): ranges of bytes covered by repeated strings."""
    entries = stored(parse(distinct_rows(rows), length, gram))
    often = (entries.where(F.col("g").isNotNull()).groupBy("g")
             .agg(F.sum("n").alias("n")).where(F.col("n") > 1).select("g"))
    cells = stored(dictionary_cells(entries.join(often, "g", "left_semi"), docs, length, cell))
    hulls = (cells.groupBy("core", "h1", "h2")
             .agg(F.sum("n").alias("n"), F.min(F.struct("k1", "k2", "a", "b")).alias("one")))
    cores = hulls.groupBy("core").agg(F.count(F.lit(1)).alias("kinds"))
    hulls = stored(hulls.join(cores, "core").where((F.col("n") > 1) | (F.col("kinds") > 1)))
    whole = cells.drop("n").join(hulls.where("n > 1").select("h1", "h2"), ["h1", "h2"], "left_semi")
    undecided = hulls.where("kinds > 1").select("one.*", (F.col("n") == 1).alias("single"))
    win = stored(windows(undecided, docs, length))
    twice = (win.groupBy("w1", "w2").agg(F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > 1).select("w1", "w2"))
    edge = win.where("single").join(twice, ["w1", "w2"], "left_semi")
    span = lambda df, s, e: df.select("k1", "k2", s.alias("s"), e.alias("e"))
    return (span(whole, F.col("a"), F.col("b") + length)
            .unionByName(span(edge, F.col("i"), F.col("i") + length))
            .unionByName(span(entries.where(F.col("g").isNull()), F.col("lo"), F.col("hi"))))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """One of the rows of every key, with their number ``n``.  The keys that
    occur more than once are stored, so their size decides how they are joined."""
    numbered = rows.withColumn("m", F.monotonically_increasing_id())
    again = stored(numbered.groupBy("k1", "k2").agg(F.min("m").alias("first"), F.count(F.lit(1)).alias("n"))
                   .where(F.col("n") > 1))
    return (numbered.join(again, ["k1", "k2"], "left").where(F.col("n").isNull() | (F.col("m") == F.col("first")))
            .select("k1", "k2", F.coalesce("n", F.lit(1)).alias("n"), "id", "text"))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(k1, k2, id, text): the key is the id and a hash of the text, so equal
    rows share a key and, rightly, all that is found for it."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(id_key(id_col).alias("k1"), F.xxhash64(text).alias("k2"),
                       F.col(id_col).cast("long").alias("id"), text.cast("binary").alias("text"))


def dedup_substrings(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id",
                     text_col: str = "text", with_kept: bool = False) -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept_sha256 and, where asked
    for, ``kept``: the bytes that are left."""
    gram, cell = min(GRAM, max(1, length // 4)), min(CELL, max(1, length // 6))
    rows = keyed(docs, id_col, text_col)
    zipped = _zipped(rows)
    spans = repeated_ranges(rows, zipped, length, gram, cell)
    per_doc = spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("s", "e")).alias("ss"))
    both = zipped.join(per_doc, ["k1", "k2"], "left").select("id", "z", "ss")
    names = [id_col, "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in range(b.num_rows):
                data = _unzip(b.column("z")[r].as_py())
                ss = b.column("ss")[r]
                gone = np.zeros((0, 2), "i8")
                if ss.is_valid and len(ss):
                    d = np.zeros(len(data) + 1, "i4")
                    np.add.at(d, ss.values.field("s").to_numpy(), 1)
                    np.add.at(d, ss.values.field("e").to_numpy(), -1)
                    gone = _runs(np.cumsum(d[:-1]) > 0)
                mask = np.ones(len(data), bool)
                for s, e in gone:
                    mask[s:e] = False
                kept = data[mask].tobytes()
                out.append((len(data), len(data) - len(kept), len(gone), hashlib.sha256(kept).hexdigest(), kept))
            cols = list(zip(*out, strict=True)) or [()] * 5
            arrays = [b.column("id"), *(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.string())]
            if with_kept:
                arrays.append(pa.array(cols[4], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"{id_col} long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return both.mapInArrow(run, schema + (", kept binary" if with_kept else ""))

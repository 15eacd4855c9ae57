"""Near-duplicate documents by Order MinHash and banded alignment.

A text is its sequence of words (runs of other than ASCII white space, ASCII
letters in lower case).  Its k-mers are runs of ``K`` words, each labelled
with how many times it has occurred before, so repeats count.  A sketch takes
the ``ORDER`` k-mers with the least hashes under its seed and keeps them in
text order; two texts agree on a sketch if the same k-mers come in the same
order, which moved passages spoil: it follows edit similarity, not only the
set of k-mers.  There are ``SKETCHES`` sketches; texts whose k-mer similarity
is 0.8 agree on none of them with a probability below 0.0001.

Texts that agree on a sketch are candidates and are verified by alignment:
near duplicates have a word edit distance of at most ``1 - SIMILARITY`` times
the longer text's words.  The alignment is bit-parallel within a band of
diagonals that doubles until the distance fits into it or passes the limit.

Copies of the same words are one vertex.  In each group of texts that agree on
a sketch, every text is aligned with the group's hub: the text that meets the
most others in all its groups, as the base of a family of variants does.  The
hub is then settled: its pairs are done.  If the others are still of several
classes, every pair of different classes is aligned where these are at most
``FEW`` a member; a group with more first meets up to ``HUBS`` hubs one after the
other, which takes one pair a member and joins families, and then its pairs of
different classes are aligned as well.  So every pair of different texts that is
a candidate is aligned, unless its texts are in one class already.  That is
quadratic for a crowd of texts that share a passage and little else; such pairs
are dealt in parts over tasks, and most fall to a count of their words before
they are aligned.  Classes are the connected components.

Defined results: a null text and one without a word is in a class of its own;
shorter texts than ``K`` words have one k-mer, all their words; the class id
is the least id of the class (null ids come last and make class null only if
no member has an id); equal rows are in one class; further columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import shuffle_partitions, stored
from tripflow.llm.components import components
from tripflow.llm.rolling import U, mixed, of_ranges, prefix

K = 5
ORDER = 4
SKETCHES = 20
SIMILARITY = 0.8
FEW = 16  # pairs of different classes a member, up to which a group is compared each with each at once
HUBS = 4  # hubs that a group with more meets before
SALT = 1000  # members of a group that meet the others in one task

_CELLS = 1 << 20  # hashes held at once
_COUNTS = 1 << 10  # classes of words whose numbers are compared before an alignment
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype="u1")
_LOWER[65:91] += 32


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of the words of a text, in order."""
    data = _LOWER[np.frombuffer(text, "u1")]
    gap = np.concatenate([[True], _SPACE[data], [True]])
    start = np.flatnonzero(gap[:-1] & ~gap[1:])
    end = np.flatnonzero(~gap[:-1] & gap[1:])
    return of_ranges(prefix(data), start, end)


def labelled_kmers(words: np.ndarray, k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-mers in text order, without and with the label."""
    k = min(k, len(words))
    n = len(words) - k + 1
    h = np.zeros(n, "u8")
    for j in range(k):
        h = h * U(0x9E3779B97F4A7C15) + words[j:j + n]
    h = mixed(h)
    order = np.argsort(h, kind="stable")
    srt = h[order]
    first = np.concatenate([[True], srt[1:] != srt[:-1]])
    rank = np.arange(n) - np.maximum.accumulate(np.where(first, np.arange(n), 0))
    label = np.empty(n, "u8")
    label[order] = rank
    return h, mixed(h + label * U(0xD1342543DE82EF95))


def sketches(words: np.ndarray, k: int = K, order: int = ORDER, n: int = SKETCHES) -> np.ndarray:
    """Order MinHash sketches: one 64-bit value a seed."""
    _, lab = labelled_kmers(words, k)
    seeds = mixed(np.arange(1, n + 1, dtype="u8") * U(0xC2B2AE3D27D4EB4F))
    take, step = min(order, len(lab)), max(1, _CELLS // len(lab))
    out = []
    for at in range(0, n, step):
        h = (lab ^ seeds[at:at + step, None]) * U(0x9E3779B97F4A7C15)
        h ^= h >> U(32)
        least = np.sort(np.argpartition(h, take - 1, axis=1)[:, :take], axis=1)
        v = np.zeros(len(h), "u8")
        for j in range(take):
            v = v * U(0xD6E8FEB86659FD93) + lab[least[:, j]]
        out.append(v)
    return mixed(np.concatenate(out) + seeds)


def _banded(places: dict, n: int, y: list, k: int) -> int:
    """Edit distance if at most k, else some larger number.  ``places`` has the
    positions of each word of the first sequence, whose length n exceeds k.

    Column by column, the differences of neighbouring cells of the 2k + 2
    diagonals around the main one are the bits of five integers."""
    width = 2 * k + 2
    mask = (1 << width) - 1
    vp, vn, dist = (mask << (width - k - 1)) & mask, 0, k
    top, side = 1 << (width - 1), 1 << (width - 2)
    shift, turn = k + 1 - width, n - k
    hopeless = 2 * k + len(y) - n  # the last rows can win back no more
    for j, c in enumerate(y):
        m = 0
        at = places.get(c)
        if at is not None:
            for t in range(bisect_left(at, shift), len(at)):
                p = at[t] - shift
                if p >= width:
                    break
                m |= 1 << p
        d0 = ((((m & vp) + vp) ^ vp) | m | vn) & mask
        hp = vn | (~(d0 | vp) & mask)
        hn = d0 & vp
        if j < turn:
            if not d0 & top:
                dist += 1
                if dist > hopeless:
                    return k + 1
        else:
            if hp & side:
                dist += 1
            if hn & side:
                dist -= 1
            side >>= 1
        half = d0 >> 1
        vp = (hn | ~(half | hp)) & mask
        vn = half & hp
        shift += 1
    return dist


def _plain(x: list, y: list) -> int:
    """Edit distance, bit-parallel over all diagonals."""
    if not x:
        return len(y)
    rows: dict = {}
    for i, c in enumerate(x):
        rows[c] = rows.get(c, 0) | (1 << i)
    mask = (1 << len(x)) - 1
    last = 1 << (len(x) - 1)
    vp, vn, dist = mask, 0, len(x)
    for c in y:
        m = rows.get(c, 0)
        d0 = ((((m & vp) + vp) ^ vp) | m | vn) & mask
        hp = vn | (~(d0 | vp) & mask)
        hn = d0 & vp
        if hp & last:
            dist += 1
        if hn & last:
            dist -= 1
        hp = ((hp << 1) | 1) & mask
        hn = (hn << 1) & mask
        vp = hn | (~(d0 | hp) & mask)
        vn = d0 & hp
    return dist


def edit_distance_within(x: np.ndarray, y: np.ndarray, most: int) -> int | None:
    """The edit distance of two word sequences if at most ``most``, else None."""
    if len(x) < len(y):
        x, y = y, x
    if len(x) - len(y) > most:
        return None
    n = len(y)
    differ = np.flatnonzero(x[:n] != y)
    head = int(differ[0]) if len(differ) else n
    x, y = x[head:], y[head:]
    n = len(y)
    differ = np.flatnonzero(x[len(x) - n:][::-1] != y[::-1])
    tail = int(differ[0]) if len(differ) else n
    x, y = x[:len(x) - tail].tolist(), y[:n - tail].tolist()
    band, places = 8, {}
    for i, c in enumerate(x):
        places.setdefault(c, []).append(i)
    while True:
        band = min(max(band, len(x) - len(y)), most)
        if band >= len(x):
            got = _plain(x, y)
        else:
            got = _banded(places, len(x), y, band)
            if got > band and band < most:
                band *= 4
                continue
        return got if got <= most else None


def least_distance(x: np.ndarray, y: np.ndarray) -> int:
    """A lower bound of the edit distance: each operation takes away at most one
    surplus word of either text."""
    more = (np.bincount((x % U(_COUNTS)).astype("i8"), minlength=_COUNTS)
            - np.bincount((y % U(_COUNTS)).astype("i8"), minlength=_COUNTS))
    return int(max(more[more > 0].sum(), -more[more < 0].sum()))


def _unzip(z: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(z)


def _content(words: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(words.tobytes())


def _vertices(docs: DataFrame, id_col: str, text_col: str, k: int, order: int, n: int) -> DataFrame:
    """(id, t, c, sk): hash of the text, content key and sketches; the last two
    null without a word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, sk = [], []
            for t in b.column("text"):
                words = word_hashes((t.as_py() or "").encode())
                keys.append(_content(words) if len(words) else None)
                sk.append(sketches(words, k, order, n).view("i8") if len(words) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("t"), pa.array(keys, pa.binary()), pa.array(sk, pa.list_(pa.int64()))],
                names=["id", "t", "c", "sk"])

    text = F.col(text_col).cast("string")
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("t"), text.alias("text"))
    return src.mapInArrow(run, "id long, t long, c binary, sk array<long>")


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    """(c, z): content key and compressed text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        comp = zstandard.ZstdCompressor(level=1)
        for b in batches:
            raw = [(t.as_py() or "").encode() for t in b.column("text")]
            keys = [_content(w) if len(w) else None for w in map(word_hashes, raw)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(map(comp.compress, raw), pa.binary())], names=["c", "z"])

    return docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "c binary, z binary")


def verified(pairs: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose alignment reaches the similarity, with ``dist``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch.column("a"), batch.column("b")
            got = []
            for r in range(batch.num_rows):
                x, y = (word_hashes(_unzip(batch.column(z)[r].as_py())) for z in ("za", "zb"))
                most = int((1.0 - similarity) * max(len(x), len(y)) + 1e-9)
                got.append(edit_distance_within(x, y, most) if least_distance(x, y) <= most else None)
            yield pa.RecordBatch.from_arrays([a, b, pa.array(got, pa.int32())], names=["a", "b", "dist"])

    za = texts.select(F.col("c").alias("a"), F.col("z").alias("za"))
    zb = texts.select(F.col("c").alias("b"), F.col("z").alias("zb"))
    n = shuffle_partitions(pairs.sparkSession)  # alignments are few bytes but long work: as many tasks
    return (pairs.join(za, "a").repartition(n, "b").join(zb, "b").select("a", "b", "za", "zb")
            .mapInArrow(run, "a binary, b binary, dist int").where(F.col("dist").isNotNull()))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: float = SIMILARITY, k: int = K, order: int = ORDER,
                    n_sketches: int = SKETCHES, with_kept: bool = False) -> DataFrame:
    """One row per input row: id and ``class_id``; where asked for, ``text_hash``
    (``xxhash64`` of the text) and ``kept``: whether the row is the class's
    first by id and text hash, null ids last."""
    vertices = stored(_vertices(docs, id_col, text_col, k, order, n_sketches))
    unique = vertices.where(F.col("c").isNotNull()).groupBy("c").agg(F.first("sk").alias("sk"))
    member = (unique.select("c", F.posexplode("sk").alias("i", "h"))
              .select(F.xxhash64("i", "h").alias("g"), "c"))
    groups = stored(_shared(member))  # (g, c): texts that agree on a sketch
    need = groups.select("c").distinct()
    texts = stored(_texts(docs, text_col).join(need, "c", "left_semi")
                   .groupBy("c").agg(F.first("z").alias("z")))
    joined = tried = None  # (a, b): vertex and class; (a, b): pairs that were aligned
    met = groups.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    met = stored(groups.join(met, "g").groupBy("c").agg(F.sum("n").alias("met")))
    groups, hubs = groups.withColumn("class", F.col("c")), 0
    while not groups.isEmpty():
        hubs += 1
        # every text of another class than the hub's with the hub
        hub = groups.join(met, "c").groupBy("g").agg(F.max(F.struct("met", "c", "class")).alias("hub"))
        hub = hub.select("g", F.col("hub.c").alias("h"), F.col("hub.class").alias("of"))
        pairs = (groups.join(hub, "g").where(F.col("class") != F.col("of"))
                 .select(F.least("h", "c").alias("a"), F.greatest("h", "c").alias("b")).distinct())
        tried, joined = _aligned(pairs, tried, joined, texts, similarity)
        # the hub is settled; the others of groups that still hold several classes go on
        rest = groups.join(hub.select("g", F.col("h").alias("c")), ["g", "c"], "left_anti").drop("class")
        rest = stored(_several(_labelled(rest, joined)).withColumn("few", F.col("few") | F.lit(hubs >= HUBS)))
        if rest.isEmpty():
            break
        tried, joined = _aligned(_across(rest.where("few"), SALT), tried, joined, texts, similarity)
        # groups with more pairs meet another hub, with all members that are left
        left = _several(_labelled(rest.where(~F.col("few")).select("g", "c"), joined))
        groups = stored(left.select("g", "c", "class"))
    if joined is None:
        joined = vertices.select(F.col("c").alias("a"), F.col("c").alias("b")).limit(0)
    return _classes(vertices, joined, id_col, with_kept)


def _shared(groups: DataFrame) -> DataFrame:
    """The rows of groups with more than one."""
    more = groups.groupBy("g").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > 1).select("g")
    return groups.join(more, "g", "left_semi")


def _several(groups: DataFrame) -> DataFrame:
    """(g, c, class) of the groups with several classes, with the number
    ``n`` of members, the group's largest class ``most``, and ``few``: whether
    the pairs of different classes are at most ``FEW`` a member."""
    size = groups.groupBy("g", "class").agg(F.count(F.lit(1)).alias("n"))
    each = size.groupBy("g").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("same"),
                                 F.max_by("class", F.struct("n", "class")).alias("most"),
                                 F.count(F.lit(1)).alias("classes"))
    few = F.col("n") * F.col("n") - F.col("same") <= 2 * FEW * F.col("n")
    each = each.where("classes > 1").select("g", "n", "most", few.alias("few"))
    return groups.select("g", "c", "class").join(each, "g")


def _across(groups: DataFrame, salt: int) -> DataFrame:
    """(a, b): the pairs of members of different classes.  Members of smaller
    classes meet all, who are dealt to one part for every ``salt`` members."""
    parts = F.ceil(F.col("n") / salt).cast("long")
    every = groups.select("g", F.pmod(F.xxhash64("c"), parts).alias("part"), "c", "class", "most")
    small = (groups.where(F.col("class") != F.col("most"))
             .select("g", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("part"),
                     F.col("c").alias("x"), F.col("class").alias("of")))
    return (every.join(small, ["g", "part"])
            .where((F.col("class") != F.col("of")) & ((F.col("class") == F.col("most")) | (F.col("x") < F.col("c"))))
            .select(F.least("x", "c").alias("a"), F.greatest("x", "c").alias("b")).distinct())


def _aligned(pairs: DataFrame, tried: DataFrame | None, joined: DataFrame | None, texts: DataFrame,
             similarity: float) -> tuple[DataFrame, DataFrame | None]:
    """The pairs aligned so far and the classes, after those of ``pairs`` that are new."""
    pairs = stored(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"))
    if not pairs.isEmpty():
        found = stored(verified(pairs, texts, similarity).select("a", "b"))
        if not found.isEmpty():
            joined = components(found if joined is None else found.unionByName(joined))
    return pairs if tried is None else tried.unionByName(pairs), joined


def _labelled(groups: DataFrame, joined: DataFrame | None) -> DataFrame:
    """(g, c) with the class of c so far."""
    if joined is None:
        return groups.withColumn("class", F.col("c"))
    return (groups.join(joined.withColumnRenamed("a", "c"), "c", "left")
            .withColumn("class", F.coalesce("b", "c")).drop("b"))


def _classes(vertices: DataFrame, joined: DataFrame, id_col: str, with_kept: bool = False) -> DataFrame:
    """Every row with the least id of its class."""
    me = F.struct(F.col("id").isNull().alias("none"), "id", "t")
    least = vertices.where(F.col("c").isNotNull()).groupBy("c").agg(F.min(me).alias("__least"))
    least = (least.join(joined.withColumnRenamed("a", "c"), "c", "left")
             .withColumn("__class", F.coalesce("b", "c")))
    ids = least.groupBy("__class").agg(F.min("__least").alias("__first"))
    of = least.join(ids, "__class").select(F.col("c").alias("__c"), "__first")
    more = [F.col("t").alias("text_hash"), (F.col("c").isNull() | me.eqNullSafe(F.col("__first"))).alias("kept")]
    return (vertices.join(of, F.col("c") == F.col("__c"), "left")
            .select(F.col("id").alias(id_col),
                    F.when(F.col("c").isNull(), F.col("id")).otherwise(F.col("__first.id")).alias("class_id"),
                    *(more if with_kept else [])))

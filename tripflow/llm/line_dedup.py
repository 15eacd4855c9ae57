"""Line dedup by an exact set-similarity join (DataFrame functions only).

A line is its set of words (runs of other than ASCII white space, lower case).  Two
lines match if the Jaccard similarity of their sets is at least ``SIMILARITY``;
of every matching pair the later line, by (document id, line number), goes.
Lines without a word stay.

1. Words are counted over all lines in ``BUCKETS`` hash buckets (an array of
   fixed size, whatever the corpus).  A word is a 64-bit integer: the size
   class of its bucket above, its hash below, so that sorted words begin with
   the rarest.  Any fixed order makes the join exact; this one makes it cheap.
2. Lines of equal sets are one row, known by its first place.
3. Candidates.  Sets of n and m words that match share a word among the first
   ``n - ceil(t n) + 1`` of the larger and the first
   ``m - ceil(2 t m / (1 + t)) + 1`` of the smaller (prefix filter); the smaller
   has at least t times the words of the larger (length filter); from the first
   shared word on enough words must be left in both to reach the overlap
   (positional filter, which implies the length filter); and the parities of the
   words in 128 hash classes may differ in no more classes than words may differ
   (bitmap filter, in the join itself).  Of the two prefix words one at least is
   among the first ``n - ceil(2 t n / (1 + t)) + 1`` of its set.  Sets of up to
   three words match equal ones alone.  A very common line is one row here; a
   common word is in a prefix only of lines that have no rarer ones.
   First every set meets the first set of each list of its prefix words; only
   sets that match none of these meet all sets before them.  So a group of
   near copies, which match their first, is not compared each with each.  There
   a short entry is dealt to the ``BAND``s of sizes that it can match, so that
   lines of other sizes with the same word do not meet.
   Both are done in ``PARTS`` parts of the words, whose postings are freed one
   after the other, as they are larger than the corpus.
4. Verification.  Candidates of the second join whose parities in 256 hash
   classes differ in too many go as well; the others fetch their lines by document,
   and the Jaccard similarity is taken of the words.

Words are compared by 57 bits of their hash.

Defined results: a null text stays null; an empty text and lines of white
space stay; equal rows (id and text) share their places, so that what one
keeps, the other keeps; null ids come first; further columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import NULL_ID, id_key, shuffle_partitions, stored

SIMILARITY = 0.8
BUCKETS = 1 << 17
HASH_BITS = 57
EPS = 1e-9


def _plain(text: Column) -> Column:
    """Lower case, every kind of white space but line breaks one space (``translate``
    takes letter by letter, so texts without such characters are spared it)."""
    odd = reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in "\t\r\f\x0b"])
    return F.when(odd, F.translate(F.lower(text), "\t\r\f\x0b", "    ")).otherwise(F.lower(text))


def word_hashes(plain: Column) -> Column:
    """Hashes of the distinct words of a plain line."""
    words = F.array_remove(F.split(plain, " "), "")
    return F.array_distinct(F.transform(words, _hash))


def _hash(word: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(word), 64 - HASH_BITS)


def _bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(BUCKETS)).cast("int")


def keyed(docs: DataFrame, id_col: str, text_col: str, carry: list[str]) -> DataFrame:
    """(k1, k2, text, c0, c1 ...): the id and 64 bits of hash of the text are the key."""
    text = F.col(text_col).cast("string")
    return docs.select(id_key(id_col).alias("k1"), F.xxhash64(text).alias("k2"), text.alias("text"),
                       *[F.col(c).alias(f"c{i}") for i, c in enumerate(carry)])


def lines_of(rows: DataFrame) -> DataFrame:
    """(k1, k2, no, hs): the lines that have a word."""
    # a filter on the words would be moved below them and split every line twice
    return (rows.select("k1", "k2", F.posexplode(F.split(_plain(F.col("text")), "\n", -1)).alias("no", "line"))
            .where(F.trim("line") != "")
            .select("k1", "k2", "no", word_hashes(F.col("line")).alias("hs")))


def bucket_classes(rows: DataFrame) -> Column:
    """The size classes of all buckets (binary logarithm of the words counted)
    as one literal array; the driver reads ``BUCKETS`` numbers."""
    # hashed behind the explode: generated code, which lambdas are not
    words = rows.select(F.explode(F.split(F.replace(_plain(F.col("text")), F.lit("\n"), F.lit(" ")), " ")).alias("w"))
    counts = (words.where(F.col("w") != "").select(_bucket(_hash(F.col("w"))).alias("b"))
              .groupBy("b").agg(F.count(F.lit(1)).alias("n")).collect())
    classes = ["0"] * BUCKETS
    for r in counts:
        classes[r["b"]] = str(r["n"].bit_length() - 1)
    return F.split(F.lit(",".join(classes)), ",").cast("array<int>")


def distinct_sets(rows: DataFrame, t: float) -> DataFrame:
    """(k1, no, k2, pre, wide, n, bits): every distinct set with its first place,
    32 bits of each word of its prefix, rarest first, the parities of its words in
    64 times ``WIDE`` hash classes, its number of words, and the parities in 64."""
    classes = bucket_classes(rows)
    # never null, so that the words are sorted as numbers and not as objects
    size = lambda h: F.coalesce(F.get(classes, _bucket(h)), F.lit(0)).cast("long")
    rank = lambda h: F.shiftleft(size(h), HASH_BITS).bitwiseOR(h)
    ws = lines_of(rows).select("k1", "no", "k2", F.sort_array(F.transform("hs", rank)).alias("ws"))
    n = F.size("ws")
    take = (n - F.ceil(n * t - EPS) + 1).cast("int")
    short = F.transform(F.slice("ws", 1, take),
                        lambda w: w.bitwiseXOR(F.shiftrightunsigned(w, 25)).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    bit = lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), w.bitwiseAND(F.lit(63)).cast("int"))
    of = lambda w: w.bitwiseAND(F.lit(64 * (WIDE - 1)))
    mine = lambda i: F.aggregate("ws", F.lit(0).cast("long"),
                                 lambda acc, w: F.when(of(w) == 64 * i, acc.bitwiseXOR(bit(w))).otherwise(acc))
    wide = [mine(i) for i in range(WIDE)]
    one = F.struct("k1", "no", "k2", F.when(n > 3, short).alias("pre"), F.array(*wide).alias("wide"))
    return (ws.select(F.xxhash64("ws").alias("s1"), F.hash("ws").alias("s2"), n.alias("n"), one.alias("one"))
            .groupBy("s1", "s2", "n").agg(F.min("one").alias("one")).select("one.*", "n")
            .withColumn("bits", reduce(Column.bitwiseXOR, [F.get("wide", F.lit(i)) for i in range(WIDE)])))


WIDE = 4  # longs of parities that a candidate's sets are compared by before their words
PARTS = 6  # of the prefix words, joined one after the other: only one part's postings lie on disk at a time
BAND = 1.5  # ratio of the sizes in one band
PLACE = ["k1", "no", "k2"]
ENTRY = [*PLACE, "n", "r", "b0", "b1"]


def postings(sets: DataFrame, part: int, *more: str) -> DataFrame:
    """(w, place, n, r, b0, b1): the prefix words of a part and the sets they are
    of, with the number of words from the shared one on and the parities in 128
    classes.  Plain columns: a struct's are read anew for every pair."""
    half = lambda i: F.get("wide", F.lit(i)).bitwiseXOR(F.get("wide", F.lit(i + 1)))
    # never null and said here, lest the optimizer adds it to one use alone and the exchanges differ
    known = lambda c: F.coalesce(c, F.lit(0))
    return (sets.where(F.col("pre").isNotNull() & F.col("n").isNotNull())
            .select(*PLACE, "n", known(half(0)).alias("b0"), known(half(2)).alias("b1"), *more,
                    F.posexplode("pre").alias("p", "w"))
            .where(F.pmod("w", F.lit(PARTS)) == part)
            .select("w", *PLACE, "n", known(F.col("n") - F.col("p")).alias("r"), "b0", "b1", *more))


def short(t: float, x: str = "") -> Column:
    """Of the entries of a matching pair one at least is short: were both longer,
    there would be fewer words behind the first shared one than the overlap."""
    return F.col(f"{x}r") >= F.col(f"{x}n") * (2 * t / (1 + t)) - EPS


def band(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(BAND)) + EPS).cast("int")


def named(entries: DataFrame, x: str) -> DataFrame:
    return entries.select([F.col(c).alias(f"{x}{c}") for c in entries.columns])


def met(listed: DataFrame, t: float) -> DataFrame:
    """The entries of a word that pass, x a short one and y one whose later set is
    not ``out``.  They meet in the bands of sizes that x can match: at least t times
    its own words, and so many that the words from the shared one on reach the overlap."""
    bands = F.sequence(band(F.ceil(F.col("n") * t - EPS)),
                       band(F.floor(F.col("r") * ((1 + t) / t) + EPS) - F.col("n")))
    x = named(listed.where(short(t)).withColumn("band", F.explode(bands)), "x")
    y = named(listed.withColumn("band", band(F.col("n"))), "y")
    later = F.when(place("x") < place("y"), F.col("yout")).otherwise(F.col("xout"))
    # all in one condition, the cheap ones first: a filter would be put before them
    return x.join(y, (F.col("xw") == F.col("yw")) & (F.col("xband") == F.col("yband")) & near("x", "y", t)
                  & (place("x") != place("y")) & later.isNull())


def near(x: str, y: str, t: float) -> Column:
    """If entries x and y pass the length, the positional and the bitmap filter
    (the length filter follows from the positional one)."""
    size = F.col(f"{x}n") + F.col(f"{y}n")
    overlap = F.ceil(size * (t / (1 + t)) - EPS)
    differ = reduce(Column.__add__, [F.bit_count(F.col(f"{x}{b}").bitwiseXOR(F.col(f"{y}{b}"))) for b in ("b0", "b1")])
    return (F.least(f"{x}r", f"{y}r") >= overlap) & (differ <= size - 2 * overlap)


def place(x: str) -> Column:
    return F.struct(*[F.col(f"{x}{c}").alias(c) for c in PLACE])


def ordered(pairs: DataFrame) -> DataFrame:
    """(a, b): the places of x and y, the earlier one first; each pair once."""
    return pairs.select(F.least(place("x"), place("y")).alias("a"), F.greatest(place("x"), place("y")).alias("b")).distinct()


def likely(pairs: DataFrame, sets: DataFrame, t: float) -> DataFrame:
    """The pairs whose parities in all classes differ in no more than words may."""

    def with_parities(pairs: DataFrame, side: str) -> DataFrame:
        of = sets.select(F.struct(*PLACE).alias(side), F.col("n").alias(f"n{side}"), F.col("wide").alias(f"w{side}"))
        return pairs.join(of, side)

    both = with_parities(with_parities(pairs, "a"), "b")
    size = F.col("na") + F.col("nb")
    differ = reduce(Column.__add__, [F.bit_count(F.get("wa", F.lit(i)).bitwiseXOR(F.get("wb", F.lit(i))))
                                     for i in range(WIDE)])
    return both.where(differ <= size - 2 * F.ceil(size * (t / (1 + t)) - EPS)).select("a", "b")


def beaten(pairs: DataFrame, docs: DataFrame, t: float) -> DataFrame:
    """(k1, no, k2): places of the later sets of the pairs that match.  The words
    of the earlier line go to the later one's document, one list a pair."""

    def with_words(pairs: DataFrame, side: str) -> DataFrame:
        at = pairs.select("*", *[F.col(f"{side}.{c}").alias(c) for c in PLACE])
        need = at.select(*PLACE).distinct().groupBy("k1", "k2").agg(F.collect_set("no").alias("nos"))
        words = (need.join(docs, ["k1", "k2"]).dropDuplicates(["k1", "k2"])
                 .select("k1", "k2", F.explode("nos").alias("no"), F.split(_plain(F.col("text")), "\n", -1).alias("ls"))
                 .select("k1", "k2", "no", word_hashes(F.get("ls", F.col("no"))).alias(f"h{side}")))
        return at.join(words, ["k1", "k2", "no"]).select(*pairs.columns, f"h{side}")

    both = with_words(with_words(pairs, "a").select("b", "ha"), "b")
    common = F.size(F.array_intersect("ha", "hb"))
    union = F.size("ha") + F.size("hb") - common
    return both.where(common >= union * t - EPS).select("b.k1", "b.no", "b.k2").distinct()


def dedup_lines(docs: DataFrame, similarity: float = SIMILARITY, id_col: str = "doc_id",
                text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Per row: id, ``kept`` (the text without the lines that go), ``n_lines``
    and ``n_removed`` (0 for a null text), and the columns named in ``carry``."""
    carry = carry or []
    whole = keyed(docs, id_col, text_col, carry)
    rows = whole.select("k1", "k2", "text")
    sets = stored(distinct_sets(rows, similarity))
    n = shuffle_partitions(docs.sparkSession)
    # each set against the first of its words' lists, then who is left against all before
    pairs = []
    for part in range(PARTS):
        listed = postings(sets, part).where(short(similarity)).repartition(n, "w")
        leads = (listed.groupBy("w").agg(F.min(F.struct(*ENTRY)).alias("lead"), F.count(F.lit(1)).alias("size"))
                 .where(F.col("size") > 1).select("w", "lead.*"))
        with_lead = named(leads, "x").join(named(listed, "y"), (F.col("xw") == F.col("yw")) & near("x", "y", similarity)
                                           & (place("x") != place("y")))
        pairs.append(stored(ordered(with_lead)))
    pairs = stored(reduce(DataFrame.unionByName, pairs).distinct())
    dealt = rows.repartition(n, "k1", "k2")
    gone = stored(beaten(pairs, dealt, similarity))
    marked = stored(sets.where(F.col("pre").isNotNull()).join(gone.withColumn("out", F.lit(True)), PLACE, "left"))
    more = []
    for part in range(PARTS):
        more.append(stored(ordered(met(postings(marked, part, "out"), similarity))))
    more = reduce(DataFrame.unionByName, more).distinct().join(pairs, ["a", "b"], "left_anti")
    more = stored(likely(more, sets, similarity))
    # one exchange of the texts serves the verification and the result
    gone = gone.unionByName(beaten(more, dealt, similarity))
    stays = sets.select("k1", "k2", "no").join(gone, ["k1", "k2", "no"], "left_anti")
    per_doc = stays.groupBy("k1", "k2").agg(F.collect_list("no").alias("nos"))
    ls = F.split("text", "\n", -1)
    empty = lambda x: F.trim(x, F.lit(" \t\r\f\x0b")) == ""
    blank = F.filter(F.transform("ls", lambda x, i: F.when(empty(x), i)), lambda i: i.isNotNull())
    keep = F.sort_array(F.concat(blank, F.coalesce("nos", F.array().cast("array<int>"))))
    texts = dealt.dropDuplicates(["k1", "k2"]) if carry else dealt
    out = (texts.join(per_doc, ["k1", "k2"], "left").withColumn("ls", ls).withColumn("keep", keep))
    kept = (F.when(F.size("keep") == F.size("ls"), F.col("text"))
            .otherwise(F.array_join(F.transform("keep", lambda i: F.get("ls", i)), "\n")))
    null = F.col("text").isNull()
    out = out.select(
        "k1", "k2", F.when(~null, kept).alias("kept"),
        F.when(null, F.lit(0)).otherwise(F.size("ls")).cast("long").alias("n_lines"),
        F.when(null, F.lit(0)).otherwise(F.size("ls") - F.size("keep")).cast("long").alias("n_removed"))
    if carry:  # the other columns of every row, without its text
        out = out.join(whole.drop("text").repartition(n, "k1", "k2"), ["k1", "k2"])
    return out.select(F.when(F.col("k1") != NULL_ID, F.col("k1")).alias(id_col), "kept", "n_lines", "n_removed",
                      *[F.col(f"c{i}").alias(c) for i, c in enumerate(carry)])

"""License scan by canonical digests (DataFrame functions only).

A text is made canonical line by line: lower case, copyright lines left out
(a line that begins, after anything that is no letter, with the copyright sign,
or with ``copyright`` or ``(c)`` and the sign, a year or the form's ``[yyyy]``;
other lines that begin so are text), every run of characters other than letters
and digits one space, equivalent spellings made one.  The SHA-256 of the whole
canonical text is hash-joined to the digests of known licence texts; the
digests of its single lines are looked up among those of known notices.

The known texts are a parameter (``[(licence, text)]``); they become a table
of 32-byte digests in the plan, so the list should hold thousands, not
millions, of texts; ``MAX_KNOWN`` says where it stops.

Defined results: null and empty texts, and texts of punctuation or copyright
lines alone, have the digest of the empty text and no licence; rows are judged
one by one, so repeated rows, null ids, ties and further columns do not
matter; a digest of several licences gives the first by name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripflow.llm.license_texts import NOTICES, SPELLINGS, TEXTS

MAX_KNOWN = 20_000
COPYRIGHT_LINE = r"^[^\p{L}(©]*(copyright:?\s*(\(c\)|©|[\[<{(]?([0-9]{4}|yyyy|year))|\(c\)\s*(copyright|[0-9]{4})|©)"
NOT_WORD = r"[^\p{L}\p{N}]+"


def _spelled(text: Column) -> Column:
    """Equivalent spellings of words, in text padded with one space each side."""
    for a, b in SPELLINGS:
        text = F.replace(text, F.lit(f" {a} "), F.lit(f" {b} "))
    return text


def canonical_lines(text: Column) -> Column:
    """The canonical lines of a text that have a letter or a digit."""
    lines = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "\n", -1),
                     lambda x: ~x.rlike(COPYRIGHT_LINE))
    lines = F.transform(lines, lambda x: F.trim(F.regexp_replace(x, NOT_WORD, " ")))
    return F.filter(lines, lambda x: x != "")


def digest(canonical: Column) -> Column:
    padded = F.concat(F.lit(" "), canonical, F.lit(" "))
    return F.sha2(F.trim(_spelled(padded)), 256)


def digests(spark: SparkSession, texts: list[tuple[str, str]]) -> DataFrame:
    """(digest, license) of known texts, one row a digest."""
    if len(texts) > MAX_KNOWN:
        raise ValueError(f"more than {MAX_KNOWN} known texts")
    known = spark.createDataFrame(texts, "license string, text string")
    known = known.select("license", digest(F.concat_ws(" ", canonical_lines(F.col("text")))).alias("digest"))
    return known.groupBy("digest").agg(F.min("license").alias("license"))


def scan_licenses(docs: DataFrame, texts: list[tuple[str, str]] | None = None,
                  notices: list[tuple[str, str]] | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ``digest`` of the whole text, ``license`` whose text it is
    (else null), and ``notices``: the licences whose notice is one of its
    lines, sorted."""
    spark = docs.sparkSession
    notices = NOTICES if notices is None else notices
    known = digests(spark, TEXTS if texts is None else texts).withColumnRenamed("digest", "__known")
    by_digest = digests(spark, notices).collect()  # at most MAX_KNOWN short rows
    longest = max((len(t) for _, t in notices), default=0)
    rows = docs.select(F.col(id_col).alias(id_col), F.col(text_col).alias("__text"))
    rows = rows.withColumn("__lines", canonical_lines(F.col("__text")))
    rows = rows.withColumn("digest", digest(F.concat_ws(" ", "__lines")))
    if by_digest:
        names = F.create_map(*[F.lit(x) for r in by_digest for x in (r["digest"], r["license"])])
        # canonical lines are no longer than the spelling table can stretch them
        short = F.filter("__lines", lambda x: F.length(x) <= 2 * longest)
        found = F.array_intersect(F.transform(short, digest),
                                  F.array(*[F.lit(r["digest"]) for r in by_digest]))
        found = F.array_sort(F.array_distinct(F.transform(found, lambda d: names[d])))
    else:
        found = F.array().cast("array<string>")
    rows = rows.withColumn("notices", found).drop("__text", "__lines")
    return (rows.join(F.broadcast(known), rows["digest"] == known["__known"], "left")
            .select(id_col, "digest", "license", "notices"))


def oracle_sql(texts: list[tuple[str, str]] | None = None,
               notices: list[tuple[str, str]] | None = None) -> str:
    """DuckDB SQL of ``scan_licenses`` over ``documents``."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    values = lambda rows: ", ".join(f"({quote(a)}, {quote(b)})" for a, b in rows)

    def lines(text: str) -> str:
        kept = (f"list_filter(string_split(lower(coalesce({text}, '')), chr(10)), "
                f"lambda x: NOT regexp_matches(x, {quote(COPYRIGHT_LINE)}))")
        clean = f"list_transform({kept}, lambda x: trim(regexp_replace(x, {quote(NOT_WORD)}, ' ', 'g')))"
        return f"list_filter({clean}, lambda x: x <> '')"

    def digest_of(canon: str) -> str:
        out = f"(' ' || {canon} || ' ')"
        for a, b in SPELLINGS:
            out = f"replace({out}, ' {a} ', ' {b} ')"
        return f"sha256(trim({out}))"

    def known(rows: list[tuple[str, str]]) -> str:
        whole = f"array_to_string({lines('text')}, ' ')"
        return (f"SELECT {digest_of(whole)} AS digest, min(license) AS license "
                f"FROM (VALUES {values(rows)}) AS v(license, text) GROUP BY 1")

    return f"""
WITH whole AS ({known(TEXTS if texts is None else texts)}),
notice AS ({known(NOTICES if notices is None else notices)}),
docs AS (SELECT doc_id, {lines('text')} AS ls FROM documents),
dig AS (SELECT doc_id, {digest_of("array_to_string(ls, ' ')")} AS digest FROM docs),
line AS (SELECT doc_id, {digest_of('l')} AS digest
         FROM (SELECT doc_id, unnest(ls) AS l FROM docs) WHERE length(l) < 1000),
hit AS (SELECT doc_id, list_sort(list(DISTINCT n.license)) AS notices
        FROM line JOIN notice n USING (digest) GROUP BY doc_id)
SELECT dig.doc_id, dig.digest, whole.license,
       coalesce(array_to_string(hit.notices, ' '), '') AS notices
FROM dig LEFT JOIN whole USING (digest) LEFT JOIN hit ON hit.doc_id = dig.doc_id
"""

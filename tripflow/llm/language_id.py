"""Language identification by compression.

A language is known by a raw-content zstandard dictionary of labelled text.
Texts are compressed in lower case, with one space for whatever is no letter.
A text is cut into pieces of ``PIECE`` bytes and each piece is compressed
with every dictionary; the language whose dictionary gives the fewest bytes
over the whole text wins.  Pieces keep the dictionary in play throughout a
long text, which otherwise would soon be compressed by its own beginning.

The margin is ``1 - best / second``; a text whose margin is below
``MIN_MARGIN`` is rejected (``rejected`` is true), though its closest
language is still given.  A text that is null or has no letter is ``und``
with score 0 and rejected.

Dictionaries are fitted on a bounded sample of the labelled rows: the
``SAMPLE_DOCS`` documents of a language with the smallest hash of the id, of
which up to ``SAMPLE_CHARS`` characters are used.  The number of languages is
the number of labels, at most ``MAX_LANGS`` (more is an error).

Defined results: equal sizes go to the language first in the alphabet; with
no labelled row every text is ``und``; rows are judged one by one, so repeated
rows, null ids and further columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SAMPLE_DOCS = 64
SAMPLE_CHARS = 2000
DICT_BYTES = 112 * 1024
PIECE = 4096
LEVEL = 9
MIN_MARGIN = 0.005
MAX_LANGS = 500
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")
_OTHER = re.compile(r"[\W\d_]+")
_codecs: dict = {}


def fit(labelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> dict[str, bytes]:
    """Language -> dictionary content, from a bounded sample of each language.

    The sample is chosen on ids and labels alone; only the chosen rows' text
    is read by the driver (``MAX_LANGS * SAMPLE_DOCS * SAMPLE_CHARS`` at most).
    """
    rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()
                          & F.col(id_col).isNotNull())
    keys = rows.select(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang"))
    n_langs = keys.select("__lang").distinct().limit(MAX_LANGS + 1).count()
    if n_langs > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    order = Window.partitionBy("__lang").orderBy(F.xxhash64("__id"), "__id")
    chosen = (keys.distinct().withColumn("__n", F.row_number().over(order))
              .where(F.col("__n") <= SAMPLE_DOCS).select("__id", "__lang"))
    ids = [r["__id"] for r in chosen.collect()]
    text = F.substring(F.col(text_col), 1, SAMPLE_CHARS).alias("__text")
    got = (rows.where(F.col(id_col).isin(ids))
           .groupBy(F.col(id_col).alias("__id"), F.col(lang_col).alias("__lang"))
           .agg(F.min(text).alias("__text"))
           .orderBy("__lang", F.xxhash64("__id"), "__id").collect())
    content: dict[str, list[bytes]] = {}
    for r in got:
        content.setdefault(r["__lang"], []).append(normalised(r["__text"]))
    return {lang: b"\n".join(parts)[:DICT_BYTES] for lang, parts in sorted(content.items())}


def normalised(text: str) -> bytes:
    """Lower case, one space for every run of other than letters."""
    return _OTHER.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def _compressors(dicts: dict[str, bytes]) -> list:
    """Of this worker; built once for each set of dictionaries."""
    key = tuple(dicts.items())
    if key not in _codecs:
        _codecs.clear()
        made = []
        for lang, content in dicts.items():
            d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=LEVEL)
            made.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=d,
                                                        write_checksum=False, write_dict_id=False)))
        _codecs[key] = made
    return _codecs[key]


def classify(text: str | None, compressors: list) -> tuple[str, float, bool]:
    """(language, score, rejected) of one text."""
    if text is None or not compressors or not _LETTER.search(text):
        return UNKNOWN, 0.0, True
    data = normalised(text)
    pieces = [data[i:i + PIECE] for i in range(0, len(data), PIECE)]
    sizes = sorted((sum(len(c.compress(p)) for p in pieces), lang) for lang, c in compressors)
    best, lang = sizes[0]
    if len(sizes) == 1:
        return lang, 1.0, False
    margin = 1.0 - best / sizes[1][0]
    return lang, margin, margin < MIN_MARGIN


def identify(docs: DataFrame, dicts: dict[str, bytes], text_col: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns of ``docs`` (default: all but clashing names) plus
    ``lang_pred``, ``score`` and ``rejected``; one row per input row."""
    new = ["lang_pred", "score", "rejected"]
    keep = [c for c in (keep if keep is not None else docs.columns) if c not in new]
    src = docs.select(*keep, F.col(text_col).alias("__text"))
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compressors = _compressors(dicts)
        for b in batches:
            res = [classify(t.as_py(), compressors) for t in b.column("__text")]
            cols = [b.column(i) for i in range(len(keep))]
            cols += [pa.array([r[0] for r in res], pa.string()), pa.array([r[1] for r in res], pa.float64()),
                     pa.array([r[2] for r in res], pa.bool_())]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, *new])

    return src.mapInArrow(run, schema)

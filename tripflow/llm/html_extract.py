"""Main text of web pages: markup first, then a suffix array for every host.

1. *Blocks.*  ``html_blocks`` reads a page into blocks of text.  Text of menus,
   headers, footers, sidebars, adverts, forms, comments and the like is left out
   by tag, class and role; of the rest the surest region counts (article, main,
   a content class, or whatever is left).
2. *Host suffix array.*  The token streams of a host's pages are concatenated
   (a mark after each block, a mark of its own after each page) and their
   suffixes sorted by prefix doubling up to ``RUN`` tokens, so equal strings of
   RUN tokens are neighbours.  A string that stands on enough distinct pages is
   boilerplate; overlapping ones make up the long repeated substrings.  Enough
   are ``DECLARED`` of the pages where the markup declares an article or main
   part, ``LOOSE`` of them elsewhere, and ``PAGES`` pages at least.  Pages with
   the same stream are one page: copies do not make text boilerplate.
3. *Unique runs.*  A block goes if more than half of its tokens are covered;
   where no region is declared, a block that is mostly links goes too.  If more
   than half of a declared article were to go, its pages are near copies of each
   other rather than boilerplate, and it stays whole.

A host with more pages or text than ``GROUP_PAGES`` or ``GROUP_BYTES`` is shared
by many tasks: its distinct pages are cut into groups by hash, each with a suffix
array of its own.  Strings that reach the share ``LOOSE`` in some group, as one
that reaches it on the host must, are counted in all groups and added up over the
host, so shares are of all its pages; the strings that reach a share, at most
``1 / LOOSE`` times as many as a mean page has, are handed to all groups.  A task
holds one group.

Defined results: null html or html without text gives an empty text; a null url
or one without a host belongs to the host ''; every row gives a row, equal ones
too; very long pages are read whole; columns other than the id, url and html are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import stored
from tripflow.llm.html_blocks import CONTENT, MAIN, blocks
from tripflow.llm.rolling import U, mixed

RUN = 8  # tokens of a string that counts as long, block marks included
PAGES = 3
DECLARED = 0.5
LOOSE = 0.1
GROUP_PAGES = 2048
GROUP_BYTES = 32 << 20  # of html


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, "^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def region(html: str | None) -> tuple[int, list[str]]:
    """The surest role on the page and the texts of its blocks; of a region
    that is not declared, without the blocks that are mostly links."""
    found = blocks(html or "")
    role = max((b.role for b in found), default=0)
    texts = [b.text for b in found if b.role == role and (role >= CONTENT or 2 * b.linked <= len(b.text))]
    return role, texts


def page_blocks(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, id, url, role, texts) of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                found = [region(h.as_py()) for h in part.column("html")]
                yield pa.RecordBatch.from_arrays(
                    [part.column("host"), part.column("id"), part.column("url"),
                     pa.array([r for r, _ in found], pa.int32()),
                     pa.array([t for _, t in found], pa.list_(pa.string()))],
                    names=["host", "id", "url", "role", "texts"])

    return pages.select(host_of(F.col(url_col)).alias("host"), F.col(id_col).cast("long").alias("id"),
                        F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html")
                        ).mapInArrow(run, "host string, id long, url string, role int, texts array<string>")


def suffix_ranks(tokens: np.ndarray, depth: int) -> np.ndarray:
    """The rank of every suffix among all, by its first ``depth`` tokens or
    more: prefix doubling, equal prefixes have equal ranks."""
    rank = np.unique(tokens, return_inverse=True)[1].astype("i8")
    step = 1
    while step < depth:
        skip = min(step, depth - step)  # the last step overlaps
        after = np.zeros(len(rank), "i8")
        after[:-skip] = rank[skip:] + 1
        rank = np.unique(rank * (len(rank) + 2) + after, return_inverse=True)[1].astype("i8")
        step += skip
    return rank


class Streams(NamedTuple):
    """The token streams of pages, one behind the other."""
    ids: np.ndarray  # numbers of the tokens, marks below 0
    page: np.ndarray
    block: np.ndarray  # -1 at a page's end
    sizes: np.ndarray  # tokens of each block, its end included
    hashes: np.ndarray  # 64 bits a token, the same in all groups


def streams_of(pages: list[tuple[int, list[str]]]) -> Streams:
    number: dict[str, int] = {}
    tokens, page, block, sizes = [], [], [], []
    for p, (_, texts) in enumerate(pages):
        for text in texts:
            words = [number.setdefault(w, len(number)) for w in text.split()]
            tokens += words
            tokens.append(-1)  # the block's end
            block += [len(sizes)] * (len(words) + 1)
            page += [p] * (len(words) + 1)
            sizes.append(len(words) + 1)
        tokens.append(-2 - p)  # the page's end: equal to no other
        block.append(-1)
        page.append(p)
    ids, page, block, sizes = (np.array(x, "i8") for x in (tokens, page, block, sizes))
    words = np.array([xxhash.xxh3_64_intdigest(w) for w in number] + [0], "u8")
    return Streams(ids, page, block, sizes, words[np.maximum(ids, -1)])


def pages_sharing(s: Streams, run: int) -> np.ndarray:
    """Of every position the number of pages that have the string of ``run``
    tokens that starts there."""
    rank = suffix_ranks(s.ids, run)
    n = int(s.page[-1]) + 1
    pairs = np.unique(rank * n + s.page) // n
    return np.bincount(pairs, minlength=int(rank.max()) + 1)[rank]


def string_hashes(s: Streams, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the strings of ``run`` tokens at all positions, and whether the
    string ends before its page does (others are on one page only)."""
    n = len(s.ids)
    h, whole = np.zeros(n, "u8"), np.ones(n, bool)
    for j in range(run):
        at = np.minimum(np.arange(n) + j, n - 1)
        h = h * U(0x9E3779B97F4A7C15) + s.hashes[at]
        whole &= s.block[at] >= 0
    return mixed(h), whole


def needed(role: int, n: int) -> int:
    """Pages of ``n`` that make a string boilerplate on a page of this role."""
    return max(PAGES, math.ceil((DECLARED if role >= MAIN else LOOSE) * n))


def blocks_gone(pages: list[tuple[int, list[str]]], s: Streams, shared: np.ndarray, n: int, run: int) -> list[np.ndarray]:
    """Which blocks go, by the pages of ``n`` that share the string at a position."""
    enough = np.array([needed(role, n) for role, _ in pages], "i8")
    starts = np.flatnonzero(shared >= enough[s.page])
    cover = np.zeros(len(s.ids) + run + 1, "i4")
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + run, -1)
    covered = (np.cumsum(cover[:len(s.ids)]) > 0) & (s.block >= 0)
    gone = 2 * np.bincount(s.block[covered], minlength=len(s.sizes)) > s.sizes
    out, at = [], 0
    for role, texts in pages:
        here, size = gone[at:at + len(texts)], s.sizes[at:at + len(texts)]
        if role >= MAIN and 2 * size[here].sum() > size.sum():
            here = np.zeros(len(texts), bool)
        out.append(here)
        at += len(texts)
    return out


def boilerplate(pages: list[tuple[int, list[str]]], run: int = RUN) -> list[np.ndarray]:
    """For distinct pages (role, texts) of a host: which blocks go."""
    if len(pages) < PAGES:
        return [np.zeros(len(t), bool) for _, t in pages]
    s = streams_of(pages)
    return blocks_gone(pages, s, pages_sharing(s, run), len(pages), run)


def _left(texts: list[str], gone: np.ndarray) -> str:
    return "\n".join(t for t, g in zip(texts, gone, strict=True) if not g)


def _distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, int, list[str]]]:
    for b in batches:
        yield from zip(*(b.column(c).to_pylist() for c in ("k1", "k2", "role", "texts")), strict=True)


def candidates(pages: DataFrame) -> DataFrame:
    """(host, h): strings on the share ``LOOSE`` of a group's distinct pages.  A
    string on that share of a host's pages is on it in one of its groups."""

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = streams_of([(role, texts) for _, _, role, texts in _distinct(batches)])
        shared = pages_sharing(s, RUN)
        hashes, whole = string_hashes(s, RUN)
        h = np.unique(hashes[whole & (shared >= LOOSE * (int(s.page[-1]) + 1) - 1e-6)]).view("i8")
        for at in range(0, len(h), 1 << 16):
            part = pa.array(h[at:at + (1 << 16)], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()] * len(part), pa.string()), part], names=["host", "h"])

    return pages.groupBy("host", "group").applyInArrow(run, "host string, h long").distinct()


def _found(s: Streams, known: np.ndarray) -> np.ndarray:
    """Of every position the place in ``known``, sorted hashes, of the string
    that starts there, or -1."""
    hashes, whole = string_hashes(s, RUN)
    at = np.minimum(np.searchsorted(known, hashes.view("i8")), len(known) - 1)
    return np.where(whole & (known[at] == hashes.view("i8")), at, -1)


def shared_by_groups(pages: DataFrame, strings: DataFrame) -> DataFrame:
    """(host, h, n): every group's distinct pages that have a candidate string."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        known, n = np.sort(right.column("h").to_numpy()), np.zeros(0, "i8")
        if len(known) and left.num_rows:
            s = streams_of([(role, texts) for _, _, role, texts in _distinct(iter(left.to_batches()))])
            at, many = _found(s, known), int(s.page[-1]) + 1
            n = np.bincount(np.unique(at[at >= 0] * many + s.page[at >= 0]) // many, minlength=len(known))
        known, n = known[:len(n)][n > 0], n[n > 0]
        return pa.table({"host": pa.array([key[0].as_py()] * len(n), pa.string()), "h": pa.array(known, pa.int64()),
                         "n": pa.array(n, pa.int64())})

    return (pages.groupBy("host", "group").cogroup(strings.groupBy("host", "group"))
            .applyInArrow(run, "host string, h long, n long"))


def kept_of_groups(pages: DataFrame, strings: DataFrame) -> DataFrame:
    """(host, k1, k2, text, n_dropped) of the distinct pages, by the strings
    (host, group, h, n, pages) that reach a share of the host's pages."""

    def run(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        found = list(_distinct(iter(left.to_batches())))
        distinct = [(role, texts) for _, _, role, texts in found]
        if right.num_rows and found:
            s = streams_of(distinct)
            known, n = (right.column(c).to_numpy() for c in ("h", "n"))
            order = np.argsort(known)
            at = _found(s, known[order])
            shared = np.where(at >= 0, n[order][at], 0)
            gone = blocks_gone(distinct, s, shared, right.column("pages")[0].as_py(), RUN)
        else:
            gone = [np.zeros(len(t), bool) for _, t in distinct]
        return pa.table({
            "host": pa.array([key[0].as_py()] * len(found), pa.string()),
            "k1": pa.array([x[0] for x in found], pa.int64()), "k2": pa.array([x[1] for x in found], pa.int64()),
            "text": pa.array([_left(t, g) for (_, t), g in zip(distinct, gone, strict=True)], pa.string()),
            "n_dropped": pa.array([int(g.sum()) for g in gone], pa.int64())})

    return (pages.groupBy("host", "group").cogroup(strings.groupBy("host", "group"))
            .applyInArrow(run, "host string, k1 long, k2 long, text string, n_dropped long"))


def extract_hot(read: DataFrame, hot: DataFrame) -> DataFrame:
    """(id, url, text, n_dropped) of the pages of hot hosts: counts of the
    distinct pages, added up over the groups of a host."""
    rows = stored(read.withColumns({"k1": F.xxhash64("role", "texts"), "k2": F.xxhash64("texts", F.lit(1), "role")}))
    one = (rows.select("host", "k1", "k2", "role", "texts").dropDuplicates(["host", "k1", "k2"])
           .join(hot, "host").withColumn("group", F.pmod("k1", "groups")).drop("groups"))
    one = stored(one)
    n = one.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    need = F.greatest(F.lit(PAGES), F.ceil(F.col("pages") * LOOSE))
    to_groups = lambda df: (df.join(hot, "host").withColumn(
        "group", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1))).drop("groups"))
    counts = shared_by_groups(one, to_groups(candidates(one))).groupBy("host", "h").agg(F.sum("n").alias("n"))
    strings = counts.join(n, "host").where(F.col("n") >= need)
    kept = kept_of_groups(one, to_groups(strings))
    return rows.select("host", "id", "url", "k1", "k2").join(kept, ["host", "k1", "k2"]).select("id", "url", "text", "n_dropped")


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            group_pages: int = GROUP_PAGES, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """(id, url, text, n_chars, n_dropped): the main text of every page and the
    number of its blocks that went as boilerplate."""
    sizes = pages.groupBy(host_of(F.col(url_col)).alias("host")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col(html_col).cast("string"))).alias("bytes"))
    groups = F.greatest(F.ceil(F.col("n") / group_pages), F.ceil(F.coalesce("bytes", F.lit(0)) / group_bytes))
    # written first, so that its size decides how it is joined
    hot = stored(sizes.select("host", groups.cast("long").alias("groups")).where("groups > 1"))
    at_hot = hot.select(F.col("host").alias("__host")), host_of(F.col(url_col)) == F.col("__host")
    cold = page_blocks(pages.join(*at_hot, "left_anti"), id_col, url_col, html_col)

    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        streams: dict[tuple, int] = {}
        rows = []
        for b in batches:
            for i, url, role, texts in zip(*(b.column(c).to_pylist() for c in ("id", "url", "role", "texts")), strict=True):
                rows.append((i, url, streams.setdefault((role, tuple(texts)), len(streams))))
        distinct = list(streams)
        gone = boilerplate(distinct)
        kept = [_left(texts, drop) for (_, texts), drop in zip(distinct, gone, strict=True)]
        for at in range(0, len(rows), 1024):
            part = rows[at:at + 1024]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in part], pa.int64()), pa.array([r[1] for r in part], pa.string()),
                 pa.array([kept[r[2]] for r in part], pa.string()),
                 pa.array([int(gone[r[2]].sum()) for r in part], pa.int64())],
                names=["id", "url", "text", "n_dropped"])

    out = cold.groupBy("host").applyInArrow(run, "id long, url string, text string, n_dropped long")
    if not hot.isEmpty():
        read = page_blocks(pages.join(*at_hot, "left_semi"), id_col, url_col, html_col)
        out = out.unionByName(extract_hot(read, hot))
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                      F.length("text").cast("long").alias("n_chars"), "n_dropped")

"""SentencePiece encoding and decoding of merge-type (BPE) vocabularies.

A text becomes symbols, one a character; an agenda holds the adjacent pairs
whose concatenation is a piece, highest score first and leftmost among equals,
and the first pair whose symbols still stand is merged until the agenda is
empty.  A symbol that is no piece falls back to its UTF-8 bytes.

No piece of such a vocabulary holds a word mark behind another character or a
line break (checked when the model is opened), so merges never cross these
places and a text can be encoded chunk by chunk; each worker remembers the
chunks it has met (at most ``CACHE_CHUNKS``; then it forgets them all).  In
every Arrow batch the chunks met for the first time are encoded by the
sentencepiece library too, and a difference is an error.

Defined results: null and the empty text encode to the begin and end ids
alone; no sampling, no prefix, no length limit.  Rows are independent, so
repeated rows, null ids and further columns do not matter.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_CHUNKS = 500_000
MARK = "▁"
_open: dict[str, "Codec"] = {}


class Codec(dict):
    """chunk -> its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, model: str):
        super().__init__()
        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.score, self.ids, self.bytes = {}, {}, {}
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                self.ids[piece] = i
                self.score[piece] = -sp.get_score(i)
                if "\n" in piece or MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {piece!r} crosses a chunk border")
        self.unk = sp.unk_id()
        self.ends = np.array([sp.bos_id(), sp.eos_id()], "<u4")
        self.new: list[str] = []
        self.split = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n").findall

    def agenda(self, chunk: str) -> list[str]:
        """The symbols of a chunk when no adjacent pair can be merged."""
        sym: list[str | None] = list(chunk)
        n = len(sym)
        if n < 2:
            return sym
        score, after, before = self.score, list(range(1, n + 1)), list(range(-1, n - 1))
        heap = []
        for i in range(n - 1):
            both = sym[i] + sym[i + 1]
            s = score.get(both)
            if s is not None:
                heap.append((s, i, both))
        heapq.heapify(heap)
        while heap:
            _, i, both = heapq.heappop(heap)
            left = sym[i]
            if left is None:
                continue
            j = after[i]
            if j >= n or left + sym[j] != both:
                continue
            sym[i], sym[j] = both, None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                pair = both + sym[k]
                s = score.get(pair)
                if s is not None:
                    heapq.heappush(heap, (s, i, pair))
            k = before[i]
            if k >= 0:
                pair = sym[k] + both
                s = score.get(pair)
                if s is not None:
                    heapq.heappush(heap, (s, k, pair))
        return [x for x in sym if x is not None]

    def __missing__(self, chunk: str) -> bytes:
        out = []
        for x in self.agenda(chunk):
            i = self.ids.get(x)
            if i is not None:
                out.append(i)
            elif self.bytes:
                out.extend(self.bytes[b] for b in x.encode("utf-8", "replace"))
            else:
                out.append(self.unk)
        if len(self) >= CACHE_CHUNKS:
            self.check()
            self.clear()
        got = self[chunk] = np.array(out, "<u4").tobytes()
        self.new.append(chunk)
        return got

    def body(self, text: str | None) -> bytes:
        """The ids of a text without begin and end."""
        if not text:
            return b""
        return b"".join(map(self.__getitem__, self.split(MARK + text.replace(" ", MARK))))

    def check(self) -> None:
        """The chunks met since the last check, by the library.  It puts a
        word mark in front of every text; a chunk that has none of its own is
        therefore given behind a line break, which is an id of its own."""
        head = len(self.sp.encode("\n"))
        new, self.new = self.new, []
        texts = [c[1:].replace(MARK, " ") if c[0] == MARK else "\n" + c for c in new]
        full = [c for c, t in zip(new, texts, strict=True) if t]
        got = self.sp.encode([t for t in texts if t], num_threads=1)
        for c, ids in zip(full, got, strict=True):
            if c[0] != MARK:
                ids = ids[head:]
            if np.array(ids, "<u4").tobytes() != self[c]:
                raise ValueError(f"chunk {c!r} differs from the sentencepiece library")


def codec(model: str) -> Codec:
    """Of this worker; opened once."""
    if model not in _open:
        _open[model] = Codec(model)
    return _open[model]


def encode(docs: DataFrame, model: str, text_col: str = "text", id_col: str = "doc_id",
           with_ids: bool = True, with_text: bool = True, carry: list[str] | None = None) -> DataFrame:
    """id, ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, where asked
    for, ``ids`` and ``decoded``, and the columns named in ``carry``; one row
    per input row."""
    carry = carry or []
    src = docs.select(F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"), *carry)
    schema = f"{id_col} long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema += ", ids array<int>" if with_ids else ""
    schema += ", decoded string" if with_text else ""
    schema += "".join(f", {c} {docs.schema[c].dataType.simpleString()}" for c in carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(model)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                all_ids = []
                for t in part.column("__text"):
                    body = np.frombuffer(c.body(t.as_py()), "<u4")
                    all_ids.append(np.concatenate([c.ends[:1], body, c.ends[1:]]))
                c.check()
                texts = c.sp.decode([x.tolist() for x in all_ids], num_threads=1)
                cols = [part.column("__id"), pa.array([len(x) for x in all_ids], pa.int64()),
                        pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in all_ids]),
                        pa.array([hashlib.sha256(t.encode()).hexdigest() for t in texts])]
                names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols.append(pa.array([x.astype("i4") for x in all_ids], pa.list_(pa.int32())))
                    names.append("ids")
                if with_text:
                    cols.append(pa.array(texts, pa.string()))
                    names.append("decoded")
                cols += [part.column(c) for c in carry]
                names += carry
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return src.mapInArrow(run, schema)


def decode(encoded: DataFrame, model: str, ids_col: str = "ids", id_col: str = "doc_id") -> DataFrame:
    """id and ``text``: the library's decode of the ids (null ids: null)."""
    src = encoded.select(F.col(id_col).cast("long").alias("__id"), F.col(ids_col).alias("__ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = codec(model).sp
        for b in batches:
            out = [None if x is None else sp.decode(x) for x in b.column("__ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("__id"), pa.array(out, pa.string())],
                                             names=[id_col, "text"])

    return src.mapInArrow(run, f"{id_col} long, text string")

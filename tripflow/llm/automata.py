"""Weighted acyclic automata of word n-grams (up to three words).

An automaton accepts the n-grams of a shard and gives each its count.  Words
are numbered in byte order; arcs stand in the order of their words, so states
are built level by level from sorted n-grams:

* the arcs out of the start state carry the counts of single words;
* the arcs out of a word's state carry the counts of its two-word strings;
* the state behind a two-word string holds the third words with their counts.
  States with the same arcs and counts are registered once and shared.

``union`` adds the weights of several automata, ``part`` cuts one by the range
of its two-word prefixes.  All steps work on whole levels as numpy arrays.
"""

from __future__ import annotations

import pickle
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard

from tripflow.llm.rolling import U, mixed

# A-Z lower-cased, piece ends become line feeds, tabs become blanks.
FOLD = bytes(b + 32 if 65 <= b <= 90 else 10 if chr(b) in ".,;:!?\n\x0b\x0c\r" else 32 if b == 9 else b
             for b in range(256))
END = b"\xff"  # never part of UTF-8; sorts after all words


class Automaton(NamedTuple):
    words: list[bytes]  # the alphabet, in byte order
    c1: np.ndarray  # count of each word (0: not here)
    first: np.ndarray  # two-word arcs, ascending by (first, second)
    second: np.ndarray
    c2: np.ndarray
    state: np.ndarray  # the registered state behind each
    offset: np.ndarray  # arcs of the registered states
    third: np.ndarray
    c3: np.ndarray

    def arcs3(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(two-word arc, third word, count) of every three-word string."""
        size = np.diff(self.offset)[self.state]
        owner = np.repeat(np.arange(len(size)), size)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(self.offset[self.state], size)
        return owner, self.third[at], self.c3[at]

    def __bytes__(self) -> bytes:
        small = [a.astype(np.min_scalar_type(int(a.max(initial=0))))
                 for a in (self.c1, np.diff(self.first, prepend=0), self.second, self.c2, self.state,
                           np.diff(self.offset), self.third, self.c3)]
        return zstandard.ZstdCompressor(level=1).compress(pickle.dumps((END.join(self.words), small)))


def load(blob: bytes) -> Automaton:
    words, arrays = pickle.loads(zstandard.ZstdDecompressor().decompress(blob))
    c1, first, second, c2, state, size, third, c3 = (a.astype("i8") for a in arrays)
    return Automaton(words.split(END) if len(c1) else [], c1, np.cumsum(first), second, c2, state,
                     np.concatenate([[0], np.cumsum(size)]).astype("i8"), third, c3)


def _registered(owner: np.ndarray, third: np.ndarray, c3: np.ndarray, n: int) -> tuple:
    """States behind n two-word arcs; equal ones are shared."""
    size = np.bincount(owner, minlength=n).astype("i8")
    offset = np.concatenate([[0], np.cumsum(size)]).astype("i8")
    sums = np.concatenate([[U(0)], np.cumsum(mixed(mixed(third.astype("u8") + U(1)) + c3.astype("u8")), dtype="u8")])
    mark = sums[offset[1:]] - sums[offset[:-1]] + size.astype("u8")
    _, one, state = np.unique(mark, return_index=True, return_inverse=True)
    at = np.arange(len(third)) - offset[owner] + np.repeat(offset[one[state]], size)
    alike = np.array_equal(size, size[one[state]]) and np.array_equal(third, third[at]) and np.array_equal(c3, c3[at])
    if not alike:  # two states share a mark by chance: share none
        one = state = np.arange(n)
    size1 = size[one]
    at = np.arange(int(size1.sum())) - np.repeat(np.cumsum(size1) - size1, size1) + np.repeat(offset[one], size1)
    return state, np.concatenate([[0], np.cumsum(size1)]).astype("i8"), third[at], c3[at]


def _build(words: list[bytes], c1: np.ndarray, key2: np.ndarray, c2: np.ndarray, owner: np.ndarray,
           third: np.ndarray, c3: np.ndarray) -> Automaton:
    """From sorted n-grams; two-word keys are first * len(words) + second."""
    v = max(len(words), 1)
    return Automaton(words, c1, key2 // v, key2 % v, c2, *_registered(owner, third, c3, len(key2)))


def count(texts: list[bytes]) -> Automaton:
    """The automaton of folded texts, whose pieces end at line feeds."""
    tokens = b"\n".join(texts).replace(b"\n", b" \xff ").split()
    coded = pa.array(tokens, pa.binary()).dictionary_encode()
    words = coded.dictionary.to_pylist()
    order = sorted(range(len(words)), key=words.__getitem__)
    number = np.empty(len(words), "i8")
    number[order] = np.arange(len(words))
    words = [words[i] for i in order]
    ids = number[coded.indices.to_numpy()] if len(tokens) else np.zeros(0, "i8")
    if words and words[-1] == END:
        ids[ids == len(words) - 1] = -1
        words.pop()
    v = max(len(words), 1)
    ok = (ids[:-1] >= 0) & (ids[1:] >= 0)
    at = np.flatnonzero(ok)
    key2, arc, c2 = np.unique(ids[at] * v + ids[at + 1], return_inverse=True, return_counts=True)
    arc_at = np.zeros(len(ids), "i8")
    arc_at[at] = arc
    at3 = np.flatnonzero(ok[:-1] & ok[1:])
    key3, c3 = np.unique(arc_at[at3] * v + ids[at3 + 2], return_counts=True)
    return _build(words, np.bincount(ids[ids >= 0], minlength=len(words)).astype("i8"), key2, c2,
                  key3 // v, key3 % v, c3)


def _summed(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, their summed weights, and the place of each key."""
    found, place = np.unique(key, return_inverse=True)
    total = np.zeros(len(found), "i8")
    np.add.at(total, place, weight)
    return found, total, place


def union(parts: list[Automaton]) -> Automaton:
    """One automaton with the summed weights."""
    words = sorted(set().union(*(p.words for p in parts)))
    number = {w: i for i, w in enumerate(words)}
    v = max(len(words), 1)
    c1 = np.zeros(len(words), "i8")
    key2, c2, key3, third, c3, seen = [], [], [], [], [], 0
    for p in parts:
        to = np.fromiter(map(number.__getitem__, p.words), "i8", len(p.words))
        c1[to] += p.c1
        key2.append(to[p.first] * v + to[p.second])
        c2.append(p.c2)
        owner, w, c = p.arcs3()
        key3.append(owner + seen)
        third.append(to[w])
        c3.append(c)
        seen += len(p.c2)
    key2, c2, place = _summed(np.concatenate(key2), np.concatenate(c2))
    key3, c3, _ = _summed(place[np.concatenate(key3)] * v + np.concatenate(third), np.concatenate(c3))
    return _build(words, c1, key2, c2, key3 // v, key3 % v, c3)


def ranges(a: Automaton, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The prefix range, of n, of every word and of every two-word arc: ranges
    of a fingerprint of the first two words (of one, for single words)."""
    mark = np.fromiter(map(zlib.crc32, a.words), "u8", len(a.words))
    h1 = mixed(mark * U(0x9E3779B97F4A7C15))
    h2 = mixed(mark[a.first] * U(0x9E3779B97F4A7C15) + mixed(mark[a.second] + U(1)))
    return tuple(((h >> U(32)) * U(n) >> U(32)).astype("i8") for h in (h1, h2))


def parts(a: Automaton, n: int) -> list[tuple[int, Automaton]]:
    """The automaton cut into those of n prefix ranges; empty ones left out."""
    r1, r2 = ranges(a, n)
    owner, third, c3 = a.arcs3()
    r3 = r2[owner]
    by1, by2, by3 = (np.argsort(r, kind="stable") for r in (np.where(a.c1 > 0, r1, n), r2, r3))
    cuts = [np.searchsorted(r[by], np.arange(n + 1)) for r, by in
            ((np.where(a.c1 > 0, r1, n), by1), (r2, by2), (r3, by3))]
    out = []
    for i in range(n):
        one, two, three = (by[c[i]:c[i + 1]] for by, c in zip((by1, by2, by3), cuts, strict=True))
        if not len(one) and not len(two):
            continue
        used = np.unique(np.concatenate([one, a.first[two], a.second[two], third[three]]))
        to = np.zeros(len(a.words), "i8")
        to[used] = np.arange(len(used))
        c1 = np.zeros(len(used), "i8")
        c1[to[one]] = a.c1[one]
        place = np.zeros(len(a.c2), "i8")
        place[two] = np.arange(len(two))
        out.append((i, _build([a.words[w] for w in used], c1, to[a.first[two]] * len(used) + to[a.second[two]],
                              a.c2[two], place[owner[three]], to[third[three]], c3[three])))
    return out

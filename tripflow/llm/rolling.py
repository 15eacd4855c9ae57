"""Rolling polynomial fingerprints of byte ranges, vectorised over a buffer.

The fingerprint of a range is the sum of a random 64-bit value per byte times
a power of an odd base, modulo 2**64, moved to the range's start.  Prefix sums
give the fingerprint of any range in O(1), equal ranges have equal values
wherever they stand.  Two bases together make 128 bits.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_CHUNK = 1 << 20
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> U(31))
    h = h * U(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U(29))
    h = h * U(0x94D049BB133111EB)
    return h ^ (h >> U(32))


_TABLES = [mixed(np.arange(1, 257, dtype="u8") * U(b)) for b in _BASES]


def _power(which: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of a base and of its inverse."""
    have = _powers.get(which)
    if have is None or len(have[0]) < n:
        size = 1 << (n - 1).bit_length()
        base, inv = _BASES[which], pow(_BASES[which], -1, 1 << 64)
        both = []
        for b in (base, inv):
            p = np.full(size, b, "u8")
            p[0] = 1
            both.append(np.multiply.accumulate(p))
        have = _powers[which] = (both[0], both[1])
    return have


def prefix(data: np.ndarray, which: int = 0) -> np.ndarray:
    """Prefix sums over the bytes of a buffer (one longer than it)."""
    out = np.zeros(len(data) + 1, "u8")
    np.cumsum(_TABLES[which][data] * _power(which, len(data) + 1)[0][:len(data)], out=out[1:])
    return out


def of_ranges(sums: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    return mixed((sums[end] - sums[start]) * _power(which, len(sums))[1][start])


def short_ranges(data: np.ndarray, start: np.ndarray, end: np.ndarray, which: int = 0) -> np.ndarray:
    """Fingerprints of ranges much shorter than a long buffer, chunk by chunk
    (bounded memory however long the buffer)."""
    if len(data) <= _CHUNK:
        return of_ranges(prefix(data, which), start, end, which)
    out = np.empty(len(start), "u8")
    chunk = start // _CHUNK
    for c in np.unique(chunk):
        at = np.flatnonzero(chunk == c)
        off = int(c) * _CHUNK
        sums = prefix(data[off:int(end[at].max())], which)
        out[at] = of_ranges(sums, start[at] - off, end[at] - off, which)
    return out


def sliding_argmin(key: np.ndarray, width: int) -> np.ndarray:
    """For every start the least key of ``width`` neighbours (van Herk)."""
    n = len(key) - width + 1
    if n <= 0:
        return key[:0]
    pad = -len(key) % width
    full = np.concatenate([key, np.full(pad, np.iinfo("u8").max, "u8")]).reshape(-1, width)
    ahead = np.minimum.accumulate(full, axis=1).ravel()
    back = np.minimum.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])

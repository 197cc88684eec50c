"""Hashes of the words of texts, without an object for each word."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: A random odd number for each byte, and an odd base.
_BYTES = np.random.default_rng(11).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x5851F42D4C957F2D
_MIX, _SHIFT = np.uint64(0x9E3779B97F4A7C15), np.uint64(29)
_WHITE = np.isin(np.arange(256), [32, *range(9, 14)])
_FOLD = np.arange(256, dtype=np.uint8) + 32 * np.isin(np.arange(256), range(65, 91)).astype(np.uint8)
#: Bytes that are hashed at once (more where a single word is longer).
PIECE = 1 << 19


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        p = np.full(n, base, np.uint64)
        p[:1] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


@lru_cache(maxsize=1)
def _usual_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(PIECE + 1)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of ``texts`` in a row (words as split at ASCII white space, A-Z
    folded), and each text's number of words.

    A word's hash is a polynomial in its bytes. With sums over all prefixes of the joined texts each
    word costs two look-ups, whatever its length; nothing is cached, and memory is bounded by PIECE."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _WHITE[data])).astype(np.int8)))
    starts, ends = edge[0::2], edge[1::2]  # every word is followed by white space
    hashes = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + PIECE, "right")))
        lo, hi = starts[first], ends[last - 1]
        up, down = _usual_powers() if hi - lo <= PIECE else _powers(hi - lo + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[_FOLD[data[lo:hi]]] * up[: hi - lo], dtype=np.uint64)))
        s, e = starts[first:last] - lo, ends[first:last] - lo
        hashes[first:last] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        first = last
    hashes = (hashes ^ (hashes >> _SHIFT)) * _MIX
    after = np.cumsum([len(t) + 1 for t in texts])
    return hashes ^ (hashes >> _SHIFT), np.diff(np.searchsorted(starts, after), prepend=0)

"""Word shingles of whole texts as 64-bit hashes, computed with numpy on UTF-8 bytes.

Words are the runs of bytes other than 20 and 09 to 0D (hex), after A-Z became a-z. A
shingle of five words is hashed from the hashes of its words; shingles count as equal
if their 64-bit hashes are.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A fixed random 64-bit value for each byte, upper case as lower case.
BYTE = np.random.default_rng(20_240_101).integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE[65:91] = BYTE[97:123]
#: Bytes hashed at a time.
CHUNK = 1 << 20
ODD = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


UP = _powers(ODD, CHUNK + 1)
DOWN = _powers(pow(ODD, -1, 1 << 64), CHUNK + 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every bit depends on all."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (in bytes) of the words of a text, and their hashes."""
    data = np.frombuffer(text, np.uint8)
    gap = SPACE[data]
    edges = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    starts, ends = edges[::2], edges[1::2]
    if len(data) <= CHUNK:
        return starts, ends, _hashes(data, starts, ends)
    out, begin = np.empty(len(starts), np.uint64), 0
    while begin < len(starts):
        # as many words as end within a chunk; a word longer than that is hashed by its parts
        last = max(begin + 1, int(np.searchsorted(ends, starts[begin] + CHUNK, "right")))
        at, to = int(starts[begin]), int(ends[last - 1])
        if to - at > CHUNK:
            h = np.zeros(1, np.uint64)
            for i in range(at, to, CHUNK):
                j = min(i + CHUNK, to)
                h = mix(h * np.uint64(ODD) + _hashes(data[i:j], np.array([0]), np.array([j - i])))
            out[begin] = h[0]
        else:
            out[begin:last] = _hashes(data[at:to], starts[begin:last] - at, ends[begin:last] - at)
        begin = last
    return starts, ends, out


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * UP[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * DOWN[starts] + (ends - starts).astype(np.uint64))


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` words, in order of their first word."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(ODD) + hashes[k : len(hashes) - n + 1 + k]
    return mix(out)


def shingle_set(text: bytes | None, n: int = 5) -> np.ndarray:
    """Distinct shingles, sorted by hash; a text of fewer words is one shingle, one without words has none."""
    hashes = words(text or b"")[2]
    if 0 < len(hashes) < n:
        return grams(hashes, len(hashes)) ^ np.uint64(len(hashes))
    return np.unique(grams(hashes, n))

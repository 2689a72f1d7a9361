"""Rolling hashes over whole batches of texts, as numpy arrays.

A polynomial hash modulo 2**64 with an odd base: prefix sums make the hash
of any stretch two look-ups, and the multiplicative inverse of the base
shifts it to a common origin.  Every stretch hash is mixed afterwards, so
all 64 bits are usable for sampling and routing.

All functions work on the concatenation of a batch's texts, so the cost
per text is a few vector operations shared by the batch, whatever the
number and the lengths of the texts.
"""
from __future__ import annotations

import numpy as np

BYTE_BASE = np.uint64(0x9E3779B97F4A7C15)
WORD_BASE = np.uint64(0xC2B2AE3D27D4EB4F)
_MASK = (1 << 64) - 1
#: Bytes that separate words: [\x20\x09-\x0D].
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Powers that a worker keeps (32 MB a base); longer texts make theirs anew.
KEPT = 1 << 22
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (murmur3 constants)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64; kept and grown per process, up to
    ``KEPT`` of them."""
    base = int(base) & _MASK
    have = _powers.get(base)
    if have is None:
        have = np.ones(1, dtype=np.uint64)
    while len(have) < n:
        step = np.uint64(pow(base, len(have), 1 << 64))
        have = np.concatenate([have, have * step])
    if len(have) <= KEPT:
        _powers[base] = have
    return have[:n]


def inverse(base: int) -> int:
    return pow(int(base), -1, 1 << 64)


def prefix(values: np.ndarray, base: np.uint64) -> np.ndarray:
    """Prefix sums of values[j] * base**j, with a leading zero."""
    out = np.empty(len(values) + 1, dtype=np.uint64)
    out[0] = 0
    np.cumsum(values * powers(base, len(values)), out=out[1:])
    return out


def stretches(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: np.uint64) -> np.ndarray:
    """Mixed hash of each stretch [start, end) of the hashed sequence."""
    back = powers(inverse(base), len(sums))
    return mix((sums[ends] - sums[starts]) * back[starts])


def fixed(sums: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """Mixed hash of every stretch of ``length`` symbols, by its start."""
    n = len(sums) - 1 - length + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    return mix((sums[length:] - sums[:n]) * powers(inverse(base), n))


def words_of(data: np.ndarray, breaks: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes that are not ``breaks``
    (a table of 256 flags, white space by default)."""
    inside = np.empty(len(data) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(breaks[data], out=inside[1:-1])
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[0::2], edge[1::2]


def words_of_texts(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for texts at ``off`` (n + 1 offsets) of one array: a word
    also ends where its text ends."""
    starts, ends = words_of(data)
    if not len(starts):
        return starts, ends
    inner = off[1:-1]
    at = np.searchsorted(starts, inner, side="right") - 1
    cut = np.unique(inner[(at >= 0) & (starts[np.maximum(at, 0)] < inner) & (ends[np.maximum(at, 0)] > inner)])
    if len(cut):
        starts, ends = np.sort(np.concatenate([starts, cut])), np.sort(np.concatenate([ends, cut]))
    return starts, ends


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One mixed hash per word.  Bytes count from 1, lengths are mixed in."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    sums = prefix(data.astype(np.uint64) + np.uint64(1), BYTE_BASE)
    return mix(stretches(sums, starts, ends, BYTE_BASE) + (ends - starts).astype(np.uint64))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values, by its start."""
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        out = np.minimum(out[: len(out) - (width - have)], out[width - have:])
    return out

"""Word shingles as 64-bit hashes, whole Arrow batches at a time in numpy.

A word is a run of bytes outside [\\x20\\x09-\\x0D], with A-Z lower-cased. Its hash is a
polynomial in its bytes modulo 2**64, read off one running sum over the batch, then
mixed; a shingle's hash mixes those of its words in their order.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C55
_INVERSE = pow(_BASE, -1, 1 << 64)
_SLICE = 1 << 19
_WORD_FACTORS = np.array(
    [pow(0xD1342543DE82EF95, 2 * k + 1, 1 << 64) for k in range(16)], dtype=np.uint64
)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, values of bytes, and which bytes are white space."""
    powers = np.full(_SLICE, _BASE, dtype=np.uint64)
    inverses = np.full(_SLICE, _INVERSE, dtype=np.uint64)
    powers[0] = inverses[0] = 1
    values = np.arange(256, dtype=np.uint64)
    values[65:91] += np.uint64(32)
    space = np.zeros(256, dtype=bool)
    space[[32, *range(9, 14)]] = True
    return np.multiply.accumulate(powers), np.multiply.accumulate(inverses), values + np.uint64(1), space


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Slice by slice, so that a very long text needs no sums as long as itself."""
    powers, inverses, values, _ = _tables()
    at_start, at_end, factor = (np.empty(len(starts), dtype=np.uint64) for _ in range(3))
    before = np.uint64(0)
    for a in range(0, len(data), _SLICE):
        b = min(a + _SLICE, len(data))
        sums = np.empty(b - a + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(values[data[a:b]] * powers[: b - a] * np.uint64(pow(_BASE, a, 1 << 64)), out=sums[1:])
        sums += before
        before = sums[-1]
        i, j = np.searchsorted(starts, (a, b))
        at_start[i:j] = sums[starts[i:j] - a]
        # what makes the hash independent of the word's place
        factor[i:j] = inverses[starts[i:j] - a] * np.uint64(pow(_INVERSE, a, 1 << 64))
        i, j = np.searchsorted(ends, (a + 1, b + 1))
        at_end[i:j] = sums[ends[i:j] - a]
    return mixed((at_end - at_start) * factor + (ends - starts).astype(np.uint64))


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes (uint64) of each text; null has none.

    A text of fewer than ``k`` words has its whole sequence as its one shingle.
    """
    if not len(texts):
        return []
    texts = texts.cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    if raw is None or offsets[-1] == offsets[0]:
        return [np.empty(0, dtype=np.uint64)] * len(texts)
    data = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    word = ~_tables()[3][data]
    joint = np.zeros(len(data) + 1, dtype=bool)  # where one text ends and the next begins
    joint[offsets] = True
    before = np.concatenate(([False], word[:-1]))
    starts = np.flatnonzero(word & (~before | joint[:-1]))
    after = np.concatenate((word[1:], [False]))
    ends = np.flatnonzero(word & (~after | joint[1:])) + 1
    hashes = _word_hashes(data, starts, ends)
    first = np.searchsorted(starts, offsets)
    whole = np.zeros(len(hashes), dtype=np.uint64)
    for t in range(k):
        whole[: max(len(hashes) - t, 0)] += mixed(hashes[t:] + np.uint64(t + 1)) * _WORD_FACTORS[t]
    whole = mixed(whole)
    sets = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            sets.append(np.unique(whole[a : b - k + 1]))
        elif b > a:
            few = sum(
                (mixed(hashes[a + t : a + t + 1] + np.uint64(t + 1)) * _WORD_FACTORS[t] for t in range(b - a)),
                np.zeros(1, dtype=np.uint64),
            )
            sets.append(mixed(few + np.uint64(b - a)))
        else:
            sets.append(np.empty(0, dtype=np.uint64))
    return sets


def common(a: np.ndarray, b: np.ndarray) -> int:
    """How many hashes two sorted sets share."""
    if len(a) < len(b):
        a, b = b, a
    if not len(b):
        return 0
    at = np.minimum(np.searchsorted(a, b), len(a) - 1)
    return int((a[at] == b).sum())

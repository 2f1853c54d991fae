"""Words, shingles and their hashes over whole Arrow text columns, in numpy.

Work runs in slices of about a megabyte, so the memory in use depends on the
longest single text and not on the batch. Hashes have 64 bits and depend on the
word bytes alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
SKETCH_BITS = 18

_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER += np.uint64(1)
_PLAIN = np.arange(256, dtype=np.uint64) + np.uint64(1)

_BASE = 0x9E3779B97F4A7C15
_LOW56 = np.uint64((1 << 56) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the hash base, as many as the longest word so far needs."""

    table = np.cumprod(np.full(64, _BASE, np.uint64))

    @classmethod
    def upto(cls, n: int) -> np.ndarray:
        if n >= len(cls.table):
            cls.table = np.cumprod(np.full(2 * n + 2, _BASE, np.uint64))
        return cls.table


def slices(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, row offsets into them) for pieces of a text column; null: no bytes."""
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        to = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, "right")) - 1
        to = min(max(to, at + 1), len(column), at + 60_000)
        yield at, to, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def word_hashes(data: np.ndarray, starts_of_rows: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first byte) of every word; a row's end also ends a word."""
    solid = ~_SPACE[data]
    first = solid.copy()
    edge = np.zeros(len(data) + 1, bool)
    edge[starts_of_rows] = True
    first[1:] &= ~solid[:-1] | edge[1:len(data)]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), starts
    lead = starts[0]
    solid = solid[lead:]
    length = np.diff(np.append(starts, len(data)))
    place = (np.arange(len(solid)) - np.repeat(starts - lead, length)) * solid
    values = (_LOWER if lower else _PLAIN)[data[lead:]]
    values *= _Powers.upto(int(place.max()))[place]
    values *= solid
    hashes = np.add.reduceat(values, starts - lead)
    chars = np.add.reduceat(solid, starts - lead, dtype=np.uint64)
    return mix(hashes ^ (chars << np.uint64(48))), starts


def segment_shingles(hashes: np.ndarray, segment: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle hash, segment) of all runs of k words; 1 to k - 1 words: the whole run as one.

    ``segment`` is ascending; a shingle lies in one segment.
    """
    n = len(hashes)
    out, of = np.empty(0, np.uint64), np.empty(0, segment.dtype)
    if n >= k:
        out = hashes[:n - k + 1].copy()
        for j in range(1, k):
            out = mix(out * np.uint64(0x2545F4914F6CDD1D) + hashes[j:n - k + 1 + j])
        whole = segment[:n - k + 1] == segment[k - 1:]
        out, of = out[whole], segment[:n - k + 1][whole]
    names, begin, count = np.unique(segment, return_index=True, return_counts=True)
    short = np.flatnonzero(count < k)
    if len(short):
        extra = hashes[begin[short]].copy()
        for j in range(1, k - 1):
            more = short[count[short] > j]
            place = np.flatnonzero(count[short] > j)
            extra[place] = mix(extra[place] * np.uint64(0x2545F4914F6CDD1D) + hashes[begin[more] + j])
        extra = mix(extra + count[short].astype(np.uint64) * np.uint64(_BASE))
        out, of = np.concatenate([out, extra]), np.concatenate([of, names[short]])
        order = np.argsort(of, kind="stable")
        out, of = out[order], of[order]
    return out, of


def ranked(shingles: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Shingle names whose numeric order is rarest first: 8 bits of frequency, then 56 of the hash."""
    bucket = (shingles & np.uint64(len(weight) - 1)).astype(np.int64)
    return (weight[bucket].astype(np.uint64) << np.uint64(56)) | (shingles >> np.uint64(8))


def distinct(names: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each segment's distinct names, ascending; segments stay in order."""
    order = np.argsort(names)
    base = segment[0] if len(segment) else 0
    local = segment[order] - base
    local = local.astype(np.uint16) if not len(local) or local.max() < 65536 else local
    order = order[np.argsort(local, kind="stable")]
    names, segment = names[order], segment[order]
    keep = np.ones(len(names), bool)
    keep[1:] = (names[1:] != names[:-1]) | (segment[1:] != segment[:-1])
    return names[keep], segment[keep]


def jaccard_counts(one: str, other: str, k: int, lower: bool) -> tuple[int, int]:
    """(size of intersection, size of union) of the shingle sets of two texts."""
    sets = []
    for text in (one, other):
        data = np.frombuffer((text or "").encode(), np.uint8)
        hashes, _ = word_hashes(data, np.array([0, len(data)]), lower)
        sets.append(np.unique(segment_shingles(hashes, np.zeros(len(hashes), np.int64), k)[0]))
    both = len(np.intersect1d(*sets, assume_unique=True))
    return both, len(sets[0]) + len(sets[1]) - both

"""Exact set-similarity joins by prefixes: what documents and lines have in common.

A set is a text's distinct word shingles. Shingles are ordered rarest first, by a
frequency sketch over the whole corpus; two sets that reach the threshold share a
shingle of their prefixes (n - ceil(t * n) + 1 rarest ones). The sketch has a fixed
number of buckets, so it is small at every size, and it only settles the order:
whatever it holds, no pair is lost.

A threshold is a percentage in whole numbers, so that no rounding enters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veil.llm import textscan as S
from veil.runtime import measured

#: 128 parity bits of a set, as two columns; see ``may_match``.
BITS = ("bit0", "bit1")
#: Buckets of the frequency sketch that are sent in one row.
COUNTS = 512


def corpus_weights(docs: DataFrame, text: str, per_text: Callable, bits: int = S.SKETCH_BITS):
    """Broadcast frequency class (a byte) of each hash bucket, from all shingles of all texts.

    ``per_text(column)`` yields arrays of shingle hashes. A task sends its counts as
    blocks of ``COUNTS`` buckets, which are added up by block as they come in;
    2**bits sums reach the driver, a fixed number.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for shingles in per_text(batch.column(0)):
                total += np.bincount((shingles & np.uint64(len(total) - 1)).astype(np.int64), minlength=len(total))
        blocks = [(i, part) for i, part in enumerate(total.reshape(-1, COUNTS)) if part.any()]
        if blocks:
            yield packed(blocks)

    def packed(blocks: list[tuple[int, np.ndarray]]) -> pa.RecordBatch:
        return pa.record_batch([pa.array([i for i, _ in blocks], pa.int32()), pa.array([c.tobytes() for _, c in blocks], pa.binary())], ["block", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                part = np.frombuffer(counts.as_buffer(), np.int64)
                sums[i] = sums[i] + part if i in sums else part.copy()
        if sums:
            yield packed(list(sums.items()))

    blocks = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "block int, counts binary")
    sums = blocks.repartition("block").mapInArrow(add, "block int, counts binary").toArrow()
    n = np.zeros(((1 << bits) // COUNTS, COUNTS), np.int64)
    for i, counts in zip(sums.column("block").to_pylist(), sums.column("counts").to_pylist(), strict=True):
        n[i] = np.frombuffer(counts, np.int64)
    weight = np.minimum(255, np.floor(4 * np.log2(np.maximum(n.reshape(-1), 1)))).astype(np.uint8)
    return docs.sparkSession.sparkContext.broadcast(weight)


def prefix_features(names: np.ndarray, segment: np.ndarray, percent: int) -> dict[str, object]:
    """Per segment: size, two signature words of the set and of its prefix, parity bits, the prefix."""
    first = np.flatnonzero(np.append(True, segment[1:] != segment[:-1])) if len(segment) else np.empty(0, np.int64)
    size = np.diff(np.append(first, len(names)))
    if not len(first):
        return {"segment": first, "n": size}
    keep = size - -(-size * percent // 100) + 1
    rank = np.arange(len(names)) - np.repeat(first, size)
    inside = rank < np.repeat(keep, size)
    one, two = S.mix(names), S.mix(names ^ np.uint64(0x5851F42D4C957F2D))
    offsets = np.append(0, np.cumsum(keep)).astype(np.int32)
    bit = one >> np.uint64(57)
    parity = [
        np.bitwise_xor.reduceat(np.where(bit >> np.uint64(6) == half, np.uint64(1) << (bit & np.uint64(63)), np.uint64(0)), first)
        for half in (0, 1)
    ]
    total = lambda x: np.add.reduceat(x, first).astype(np.int64)
    return {
        "segment": segment[first], "n": size, "sig0": total(one), "sig1": total(two),
        "pre0": total(one * inside), "pre1": total(two * inside),
        "bit0": parity[0].astype(np.int64), "bit1": parity[1].astype(np.int64),
        "prefix": pa.ListArray.from_arrays(pa.array(offsets), pa.array(names[inside].astype(np.int64))),
    }


def overlap_needed(n1, n2, percent: int):
    """Smallest intersection of sets of n1 and n2 that reaches the threshold."""
    return F.ceil(F.lit(percent) * (n1 + n2) / F.lit(100.0 + percent) - F.lit(1e-9))


def positional(n1, p1, n2, p2, percent: int):
    """Length and positional filter at a shared prefix shingle; true for it if it is the first one shared."""
    small, large = F.least(n1, n2), F.greatest(n1, n2)
    return (F.lit(100) * small >= F.lit(percent) * large) & (
        F.lit(1) + F.least(n1 - p1, n2 - p2) - F.lit(1) >= overlap_needed(n1, n2, percent)
    )


def may_match(n1, n2, bits1: list, bits2: list, percent: int):
    """Length and parity filter: each differing parity bit is at least one shingle in one set only."""
    differ = sum((F.bit_count(a.bitwiseXOR(b)) for a, b in zip(bits1, bits2, strict=True)), F.lit(0))
    small, large = F.least(n1, n2), F.greatest(n1, n2)
    return (F.lit(100) * small >= F.lit(percent) * large) & (
        n1 + n2 - differ >= F.lit(2) * overlap_needed(n1, n2, percent)
    )


def verify(pairs: DataFrame, texts: DataFrame, keys: list[str], k: int, percent: int, lower: bool) -> DataFrame:
    """The pairs whose texts reach the threshold, compared shingle by shingle.

    ``pairs`` has the key columns with suffixes 1 and 2 and one row for each pair;
    ``texts`` has the keys and ``text``. Only texts that occur in a pair are shuffled.
    """
    ids = [f"{c}{side}" for side in (1, 2) for c in keys]
    mine = texts.select(*keys, F.col("text").alias("_text"))

    def side(frame, i):
        named = mine.select(*(F.col(c).alias(f"{c}{i}") for c in keys), F.col("_text").alias(f"_text{i}"))
        return frame.join(named, [f"{c}{i}" for c in keys])

    both = side(side(pairs.select(*ids), 1), 2)

    def check(batches):
        for batch in batches:
            ones, others = batch.column("_text1"), batch.column("_text2")
            ok = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                meet, union = S.jaccard_counts(ones[i].as_py(), others[i].as_py(), k, lower)
                ok[i] = union > 0 and 100 * meet >= percent * union
            yield batch.select(ids).filter(pa.array(ok))

    return both.select(*ids, "_text1", "_text2").mapInArrow(check, pairs.select(*ids).schema)


def needed_texts(docs: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """Rows of ``docs`` whose key occurs in ``wanted`` (one column); broadcast if its measured size allows."""
    return docs.join(measured(wanted.select(key).distinct()), key, "left_semi")

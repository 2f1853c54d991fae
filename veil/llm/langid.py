"""Language identification: multinomial naive Bayes over hashed character n-grams.

The model is a matrix of log probabilities (buckets x languages), broadcast to the
tasks. A batch of texts is one sparse matrix of n-gram occurrences in row order, and its
product with the model is a gather and a segmented sum in numpy. Long texts are cut
into pieces whose n-grams overlap nowhere and miss nothing, and their sums add up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from veil.runtime import measured

BUCKET_BITS = 15
ORDERS = (1, 2, 3)
PIECE = 1 << 19
#: Training texts of each language, about; chosen by a hash of the id.
TRAIN_PER_LANGUAGE = 1_500

_ALPHA: np.ndarray | None = None


def _letters() -> np.ndarray:
    """Whether each code point is a letter."""
    global _ALPHA
    if _ALPHA is None:
        _ALPHA = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _ALPHA


@dataclass(frozen=True)
class Model:
    languages: list[str]
    log_probability: np.ndarray  # buckets x languages
    prior: np.ndarray


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(code points, row of each code point) of lower-cased texts, some texts at a time; a long text in several pieces.

    Every text is led and ended by a blank, so that n-grams see where words end. A later
    piece repeats the last two code points of the one before; they only serve as a start.
    """
    held, rows, size = [], [], 0
    for i, text in enumerate(texts):
        text = f" {(text or '').lower()} "
        for at in range(0, len(text), PIECE):
            part = text[max(0, at - max(ORDERS) + 1):at + PIECE]
            held.append(np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32))
            rows.append(np.full(len(part), -i - 1 if at else i, np.int64))
            size += len(part)
            if size >= PIECE:
                yield np.concatenate(held), np.concatenate(rows)
                held, rows, size = [], [], 0
    if held:
        yield np.concatenate(held), np.concatenate(rows)


def ngrams(points: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(bucket, row) of the n-grams of each order, in row order, without those of blanks alone."""
    row = np.where(rows < 0, -rows - 1, rows)
    start = np.flatnonzero(np.append(True, rows[1:] != rows[:-1]))
    lead = np.zeros(len(rows), np.int64)  # code points that only serve as a start
    for s in start[rows[start] < 0]:
        lead[s:s + max(ORDERS) - 1] = 1
    clean = np.where(_letters()[points] | (points > 127), points, 32).astype(np.uint32)
    word = clean != 32
    value = np.zeros(len(points), np.uint32)
    for order in range(1, max(ORDERS) + 1):
        n = len(points) - order + 1
        if n <= 0:
            return
        value = value[:n] * np.uint32(0x01000193) + clean[order - 1:] * np.uint32(0x9E3779B1)
        if order not in ORDERS:
            continue
        keep = (rows[:n] == rows[order - 1:]) & (lead[order - 1:] == 0)
        some = word[:n].copy()
        for j in range(1, order):
            some |= word[j:n + j]
        keep &= some
        mixed = (value ^ (value >> np.uint32(15))) * np.uint32(0x85EBCA6B) + np.uint32(order * 0x27D4EB2F & 0xFFFFFFFF)
        yield (mixed[keep] >> np.uint32(32 - BUCKET_BITS)).astype(np.int64), row[:n][keep]


def train(labelled: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> Model:
    """A model of (doc_id, text, lang), from about ``per_language`` whole texts of each language, all if it has no more.

    The texts are those whose hashed id lies in the language's share of the hash range, so
    reruns agree and no text is shuffled. n-gram counts are made in the
    tasks and summed by Spark; (buckets x languages) sums reach the driver.
    """
    labelled = labelled.where("lang is not null and text is not null")
    sizes = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))  # one row for each language
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 31)) / F.lit(float(1 << 31))
    sample = labelled.join(measured(sizes), "lang").where(place * F.col("_n") < per_language).select("lang", "text")

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])
            for points, rows in _pieces(texts):
                for bucket, row in ngrams(points, rows):
                    cell = code[row] << BUCKET_BITS | bucket
                    found = np.bincount(cell, minlength=len(names) << BUCKET_BITS)
                    for i, name in enumerate(names):
                        part = found[i << BUCKET_BITS:(i + 1) << BUCKET_BITS]
                        total[name] = total.get(name, 0) + part
        for name, counts in total.items():
            at = np.flatnonzero(counts)
            yield pa.record_batch(
                [pa.array([name] * len(at)), pa.array(at.astype(np.int32)), pa.array(counts[at])], ["lang", "bucket", "n"]
            )

    sums = sample.mapInArrow(count, "lang string, bucket int, n bigint").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    langs = np.array(sums.column("lang").to_pylist(), dtype=object)
    names = sorted(set(langs.tolist()))
    counts = np.ones((1 << BUCKET_BITS, len(names)))
    for j, name in enumerate(names):
        mine = langs == name
        counts[sums.column("bucket").to_numpy()[mine], j] += sums.column("n").to_numpy()[mine]
    # Equal priors: a text's language shows in the text alone.
    prior = np.full(len(names), -np.log(max(1, len(names))))
    return Model(names, np.log(counts / counts.sum(axis=0)).astype(np.float32), prior)


def score(texts: list[str | None], model: Model) -> tuple[list[str], np.ndarray]:
    """(language, posterior) of each text; ``und`` and 0 for null or no letter, or if the model knows no language."""
    sums = np.tile(model.prior, (len(texts), 1))
    lettered = np.zeros(len(texts), bool)
    for points, rows in _pieces(texts):
        row = np.where(rows < 0, -rows - 1, rows)
        lettered[np.unique(row[_letters()[points]])] = True
        for bucket, of in ngrams(points, rows):
            if len(of) and len(model.languages):
                begin = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                sums[of[begin]] += np.add.reduceat(model.log_probability[bucket], begin, axis=0, dtype=np.float64)
    if not model.languages:
        return ["und"] * len(texts), np.zeros(len(texts))
    best = sums.argmax(axis=1)
    sure = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    names = np.array([*model.languages, "und"], dtype=object)[np.where(lettered, best, len(model.languages))]
    return names.tolist(), np.where(lettered, sure, 0.0)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1), of the whole text alone.

    Null text, empty text and text without a letter: ``und``, 0. Columns of those names are
    replaced; an empty table gives an empty result; equal texts score alike.
    """
    known = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(*(F.col(f"`{c}`") for c in kept))
    place = kept.index(text_col)
    schema = T.StructType([*rows.schema, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def label(batches):
        for batch in batches:
            step = 2_000
            for at in range(0, batch.num_rows, step):
                part = batch.slice(at, step)
                names, sure = score(part.column(place).to_pylist(), known.value)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(sure, pa.float64())], names=[*kept, "lang_pred", "score"]
                )

    return rows.mapInArrow(label, schema)


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 4, is 2; a null id is not."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))

"""Line dedup: an exact set-similarity join of lines, the later of two matching lines goes.

A line's tokens are its distinct k-word shingles (the whole line, if it has fewer
words), ordered rarest first. Equal sets fall together in one aggregation. Of the
others each prefix shingle has a list of lines; every line is first compared with the
earliest line of its lists. Lines that match it are settled; only lines still open are
compared with all earlier ones of their lists, after length, position and parity filters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veil.llm import setjoin as J
from veil.llm import textscan as S
from veil.llm.common import SPACES, stored, tidy
from veil.runtime import measured

LINES = "doc_id bigint, line int, n int, sig0 bigint, sig1 bigint, bit0 bigint, bit1 bigint, prefix array<bigint>"
KEY = ["doc_id", "line"]


def _line_shingles(column: pa.Array, k: int, lower: bool) -> Iterator[tuple]:
    """(rows from, row of line, number of line in its row, shingles, line of shingle) for each slice."""
    for at, _, data, offsets in S.slices(column):
        breaks = np.flatnonzero(data == 10) + 1
        first = np.union1d(offsets[:-1], breaks[breaks < len(data)])
        hashes, starts = S.word_hashes(data, offsets, lower)
        of = np.searchsorted(first, starts, "right") - 1
        # the last of the rows that start here is the one that has text here
        row = np.searchsorted(offsets, first, "right") - 1
        number = np.searchsorted(breaks, first, "right") - np.searchsorted(breaks, offsets[np.minimum(row, len(offsets) - 1)], "right")
        yield at, row, number, *S.segment_shingles(hashes, of, k)


def line_features(docs: DataFrame, k: int, percent: int, lower: bool) -> DataFrame:
    """``LINES`` of every line with a word, of (doc_id, text)."""
    weights = J.corpus_weights(docs, "text", lambda column: (x[3] for x in _line_shingles(column, k, lower)))

    def features(batches):
        for batch in batches:
            ids = batch.column(0)
            for at, row, number, shingles, of in _line_shingles(batch.column(1), k, lower):
                f = J.prefix_features(*S.distinct(S.ranked(shingles, weights.value), of), percent)
                line = f["segment"]
                if not len(line):
                    continue
                yield pa.record_batch(
                    [
                        ids.take(pa.array(at + row[line])), pa.array(number[line].astype(np.int32)), pa.array(f["n"].astype(np.int32)),
                        *(pa.array(f[c]) for c in ("sig0", "sig1", *J.BITS)), f["prefix"],
                    ],
                    [*KEY, "n", "sig0", "sig1", *J.BITS, "prefix"],
                )

    return docs.select("doc_id", "text").where("doc_id is not null").mapInArrow(features, LINES)


def _line_texts(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, line, text) of the given lines (doc_id, line)."""
    wanted = lines.groupBy("doc_id").agg(F.collect_set("line").alias("lines"))
    # A text is split once. The size keeps the split a column of its own: inside the lambda it would be made for every line.
    split = docs.join(measured(wanted), "doc_id").select("doc_id", "lines", F.split("text", "\n").alias("all"))
    line = lambda i: F.struct(i.alias("line"), F.element_at("all", i + 1).alias("text"))
    found = split.select("doc_id", F.explode(F.when(F.size("all") > 0, F.transform("lines", line))).alias("found"))
    return found.select("doc_id", "found.*")


def _matches(pairs: DataFrame, docs: DataFrame, k: int, percent: int, lower: bool) -> DataFrame:
    """Pairs (doc_id1, line1, doc_id2, line2) that reach the threshold; ``pairs`` has passed the filters."""
    near = stored(pairs, "line-candidates")
    lines = near.select("doc_id1", "line1").union(near.select("doc_id2", "line2")).toDF(*KEY).distinct()
    return stored(J.verify(near, _line_texts(docs, lines), KEY, k, percent, lower), "line-matches")


@tidy
def repeated_lines(docs: DataFrame, k: int = 5, percent: int = 80, lower: bool = True) -> DataFrame:
    """(doc_id, line) of every line, counted from 0, that matches an earlier one.

    Earlier means a smaller (doc_id, line), whether that line itself stays or not. Lines
    match when the Jaccard similarity of their sets of k-word shingles is at least
    ``percent`` / 100. Lines without a word match nothing. Rows with a null id or null text
    take no part. If rows repeat an id, their lines with the same number count as one.
    """
    feats = stored(line_features(docs, k, percent, lower), "lines")
    at = F.struct(*KEY)
    sets = ["n", "sig0", "sig1"]
    first = feats.groupBy(*sets).agg(F.min(at).alias("first"), F.count(F.lit(1)).alias("copies"))
    first = stored(first.where("copies > 1").select(*sets, "first"), "line-classes")
    copies = stored(
        feats.select(*KEY, *sets).join(measured(first), sets).where(at != F.col("first")).select(*KEY), "line-copies"
    )

    # Lists hold keys alone; sizes and places are looked up for the lists that are left.
    heads = feats.join(measured(copies), KEY, "left_anti")
    postings = heads.select(*KEY, F.explode("prefix").alias("token"))
    lists = postings.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("doc_id").alias("from_doc")).where("c > 1")
    # The lists left are few, so the postings are looked up as they come and never sorted.
    shared = stored(postings.join(lists.hint("shuffle_hash"), "token").drop("c"), "line-lists")
    place = (F.array_position("prefix", F.col("token")) - 1).cast("int")
    rows = shared.join(feats.select(*KEY, "n", *J.BITS, "prefix"), KEY).withColumn("pos", place).drop("prefix")
    rows = stored(rows, "line-rows")
    pivots = rows.where("doc_id = from_doc").groupBy("token").agg(F.min(F.struct("line", "n", "pos", *J.BITS)).alias("p"))
    pivots = pivots.select(F.col("token").alias("at"), *(F.col(f"p.{c}").alias(f"{c}_p") for c in ("line", "n", "pos", *J.BITS)))
    star = (
        rows.join(
            pivots,
            (F.col("token") == F.col("at")) & ((F.col("doc_id") != F.col("from_doc")) | (F.col("line") != F.col("line_p")))
            & J.positional(F.col("n"), F.col("pos"), F.col("n_p"), F.col("pos_p"), percent)
            & J.may_match(F.col("n"), F.col("n_p"), [F.col(c) for c in J.BITS], [F.col(f"{c}_p") for c in J.BITS], percent),
        )
        .select("doc_id", "line", "from_doc", "line_p").toDF("doc_id1", "line1", "doc_id2", "line2").distinct()
    )
    star = stored(star, "line-stars")
    settled = _matches(star, docs, k, percent, lower).select("doc_id1", "line1").toDF(*KEY).distinct()
    settled = stored(settled, "settled")
    rows = rows.drop("from_doc")
    left = rows.join(settled, KEY, "left_anti").alias("a")
    right = rows.alias("b")
    x, y = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    earlier = (y("doc_id") < x("doc_id")) | ((y("doc_id") == x("doc_id")) & (y("line") < x("line")))
    rest = left.join(
        right,
        (x("token") == y("token")) & earlier & J.positional(x("n"), x("pos"), y("n"), y("pos"), percent)
        & J.may_match(x("n"), y("n"), [x(c) for c in J.BITS], [y(c) for c in J.BITS], percent),
    ).select(x("doc_id"), x("line"), y("doc_id"), y("line")).toDF("doc_id1", "line1", "doc_id2", "line2").distinct()
    rest = rest.join(star, rest.columns, "left_anti")
    late = _matches(rest, docs, k, percent, lower).select("doc_id1", "line1").toDF(*KEY)
    return copies.union(settled).union(late).distinct()


def dedup_lines(docs: DataFrame, text_col: str = "text", k: int = 5, percent: int = 80, lower: bool = True) -> DataFrame:
    """``docs`` with repeated lines taken out of the text: ``n_lines``, ``n_blank`` of them without a word, ``n_removed``, and
    ``chars_removed``, the characters of those.

    See ``repeated_lines`` for what goes. Kept lines stay in order, joined by line breaks; a
    text that loses all lines becomes empty; null texts stay null. Columns with these
    names are replaced. Reads ``doc_id`` and the text column.
    """
    plain = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    gone = repeated_lines(plain, k, percent, lower)
    per_doc = gone.groupBy("doc_id").agg(F.collect_set("line").alias("_gone"))
    out = docs.join(measured(per_doc), "doc_id", "left")
    text = F.col(f"`{text_col}`")
    # A column of its own: inside a lambda the text would be split for every line.
    out = out.withColumn("_lines", F.split(text, "\n"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_gone"))
    rest = F.array_join(F.transform(kept, lambda i: F.element_at("_lines", i + 1)), "\n")
    return (
        out.withColumn("n_lines", F.when(text.isNull(), 0).otherwise(F.size("_lines")).cast("bigint"))
        .withColumn("n_blank", F.when(text.isNull(), 0).otherwise(F.size(F.filter("_lines", lambda x: F.trim(x, F.lit(SPACES)) == ""))).cast("bigint"))
        .withColumn("n_removed", F.coalesce(F.size("_gone"), F.lit(0)).cast("bigint"))
        .withColumn("_rest", F.when(F.col("_gone").isNull() | text.isNull(), text).otherwise(rest))
        .withColumn("chars_removed", F.coalesce(F.length(text) - F.length("_rest"), F.lit(0)).cast("bigint"))
        .withColumn(text_col, F.col("_rest"))
        .drop("_gone", "_lines", "_rest")
    )

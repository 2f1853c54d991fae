"""Mixing sources to target weights: random keys, range-sorted, cut at exact budgets.

Every document gets a pseudo-random key of its id. Keys are uniform, so cutting their
range into equal pieces (as many as a source has rows for) is a range partition without
sampling, equal in every run. Sums of the pieces give each piece its offset, a window
inside the piece gives each document its own, and the budget cuts the running sum.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from veil.llm.common import words

#: Rows of one piece of a source's key range, on average.
ROWS_PER_PIECE = 5_000


def word_count(text: Column) -> Column:
    """Number of words of a text; null: 0."""
    return F.size(words(text)).cast("bigint")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most_epochs: float) -> DataFrame:
    """(source, rows, source_size, target) of (source, rows, source_size), one row for each source.

    Sources in code point order, null last, weigh ``weights`` in turn. ``share`` times all words
    are given out by weight; a source takes at most ``most_epochs`` times its own words, and what
    is above goes to the others by weight until nothing is above: target = min(cap, level * weight),
    where the level is found at the first source, in order of cap / weight, that stays below its cap.
    """
    cap = F.col("source_size") * F.lit(float(most_epochs))
    order = Window.orderBy(F.col("source").asc_nulls_last())
    table = F.array(*(F.lit(float(w)) for w in weights))
    rated = sizes.withColumn("weight", F.element_at(table, (F.row_number().over(order) - 1) % len(weights) + 1))
    rated = rated.withColumn("cap", cap)
    fill = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy()
    rated = (
        rated.withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
        .withColumn("full", F.coalesce(F.sum("cap").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("left", F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
        .withColumn("level", (F.col("budget") - F.col("full")) / F.col("left"))
    )
    open_level = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "level"))).over(every)
    return (
        rated.withColumn("open", open_level["level"])
        .withColumn("target", F.when(F.col("open").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("open") * F.col("weight"))))
        .select("source", "rows", "source_size", "target")
    )


def mix_sources(
    docs: DataFrame, size: Column, source_col: str = "source", id_col: str = "doc_id", weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5, most_epochs: float = 2.0, seed: int = 0, carry: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) and the columns in ``carry``, one row for each document.

    ``taken`` is how many words of the document the mix holds: whole epochs of its source count it
    in full, the last epoch holds the first documents by key and cuts the one that crosses the
    budget, so a source's taken words sum to its target rounded down. Null source is a source of its
    own; null size counts as 0; an empty table gives an empty result; rows that repeat an id
    have one key and are told apart by size. Reruns agree. Sources without words take nothing. Texts may be of any length; columns in ``carry`` may have any
    name but those of the result, which win.
    """
    names = ("doc_id", "source", "size", "source_size", "target", "taken")
    carry = [c for c in carry if c not in names]
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
        F.coalesce(size, F.lit(0)).cast("bigint").alias("size"), *([F.struct(*(F.col(f"`{c}`") for c in carry)).alias("carried")] if carry else []),
    )
    rows = rows.withColumn("key", F.xxhash64(F.lit(seed), F.col("doc_id")))
    totals = rows.groupBy("source").agg(F.count(F.lit(1)).alias("rows"), F.sum("size").alias("source_size"))
    targets = source_targets(totals, weights, share, most_epochs)
    pieces = F.ceil(F.col("rows") / F.lit(ROWS_PER_PIECE))
    place = (F.shiftrightunsigned("key", 11) / F.lit(float(1 << 53)) * pieces).cast("bigint")
    rows = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).drop(targets["source"]).withColumn("piece", place)

    sums = rows.groupBy("source", "piece").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("source").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("source", "piece", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("source", "piece").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ahead", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(offsets.withColumnRenamed("source", "of"), rows["source"].eqNullSafe(F.col("of")) & (rows["piece"] == offsets["piece"])).drop("of", offsets["piece"])
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("offset") - F.col("ahead")))
    return rows.select(
        "doc_id", "source", "size", "source_size", "target", (epochs * F.col("size") + last).cast("bigint").alias("taken"),
        *(F.col(f"carried.`{c}`").alias(c) for c in carry),
    )

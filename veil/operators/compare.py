"""Comparison of two copies of a table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from veil.functions.values import to_text
from veil.runtime import measured

CHANGED, ONLY_LEFT, ONLY_RIGHT, DUPLICATE = "changed", "only_left", "only_right", "duplicate"


def shown(c: Column, kind: T.DataType) -> Column:
    """Text form for the report; timestamps keep their microseconds."""
    return c.cast("string") if isinstance(kind, T.TimestampType) else to_text(c, kind)


def text(both: DataFrame, side: str, column: str) -> Column:
    return shown(F.col(side)[column], both.schema[side].dataType[column].dataType)


def _compared(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None
) -> tuple[list[str], Callable[[DataFrame, str], Column]]:
    """The columns to compare, and the form of a side's value in which they are compared."""
    every = list(dict.fromkeys([*left.columns, *right.columns]))
    columns = [c for c in every if c not in keys] if columns is None else list(columns)
    kinds = {c: [df.schema[c].dataType for df in (left, right) if c in df.columns] for c in columns}

    def value(df: DataFrame, c: str) -> Column:
        """Typed, so that nothing is rounded; as text if the sides' types differ or have no order."""
        kind = kinds[c][0]
        alike = all(k == kind for k in kinds[c]) and not isinstance(kind, (T.MapType, T.VariantType))
        if c not in df.columns:
            return F.lit(None).cast(kind if alike else "string")
        return F.col(f"`{c}`") if alike else shown(F.col(f"`{c}`"), df.schema[c].dataType)

    return columns, value


def diff(left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None) -> DataFrame:
    """Differing columns per key: (keys, column, left, right, kind), values as text.

    Values are compared with their types. A column that one side lacks counts
    as null there. Keys on one side only list all their columns. A key that occurs more than
    once on a side has no single row to compare: it gives one ``duplicate``
    row with the two row counts. Both copies meet in one aggregation by key,
    not in a join: one shuffle, and repeated keys are merged before it instead
    of being paired.
    """
    keys = list(keys)
    columns, value = _compared(left, right, keys, columns)

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        image = F.struct(*[value(df, c).alias(c) for c in columns])
        return df.select(*[F.col(f"`{k}`") for k in keys], F.lit(is_left).alias("_left"), image.alias("_row"))

    on_left = F.col("_left")
    both = (
        side(left, True).unionByName(side(right, False)).groupBy(*keys).agg(
            F.max(F.when(on_left, F.col("_row"))).alias("l"),
            F.max(F.when(~on_left, F.col("_row"))).alias("r"),
            F.count_if(on_left).alias("n_left"),
            F.count_if(~on_left).alias("n_right"),
        )
    )
    n_left, n_right = F.col("n_left"), F.col("n_right")

    def entry(column: str | None, l: Column, r: Column, kind, same: Column) -> Column:
        return F.struct(
            F.lit(column).cast("string").alias("column"), l.alias("left"), r.alias("right"), same.alias("same"),
            (F.lit(kind) if isinstance(kind, str) else kind).alias("kind"),
        )

    kind = F.when(n_right == 0, ONLY_LEFT).when(n_left == 0, ONLY_RIGHT).otherwise(CHANGED)
    cells = F.array(*[
        entry(c, text(both, "l", c), text(both, "r", c), kind, F.col("l")[c].eqNullSafe(F.col("r")[c])) for c in columns
    ])
    differing = F.filter(cells, lambda e: (e["kind"] != CHANGED) | ~e["same"])
    counts = F.array(entry(None, n_left.cast("string"), n_right.cast("string"), DUPLICATE, F.lit(False)))
    repeated = (n_left > 1) | (n_right > 1)
    return both.filter(repeated | ~F.col("l").eqNullSafe(F.col("r"))).select(
        *keys, F.inline(F.when(repeated, counts).otherwise(differing))
    ).drop("same")


#: Hash ranges of keys whose digests are compared first.
DIGEST_RANGES = 16_384


def diff_by_digest(
    left: DataFrame, right: DataFrame, keys: Sequence[str], columns: Sequence[str] | None = None, ranges: int = DIGEST_RANGES,
) -> DataFrame:
    """:func:`diff` of two large copies that differ in few rows, found down a tree of digests.

    First each side's rows are summed up to one digest for each hash range of keys; then, in the ranges that
    differ, to one for each key; only rows of keys that differ are shuffled whole. What is
    shuffled otherwise are ``ranges`` rows a task and the digests of differing ranges. Both copies are
    scanned three times.

    Keys are taken to be unique: a key that repeats with the very same rows on both sides isn't
    reported. A difference could only be missed if 64-bit hashes of two rows were equal.
    """
    keys = list(keys)
    compared, value = _compared(left, right, keys, columns)
    key = [F.col(f"`{k}`") for k in keys]
    some = F.pmod(F.xxhash64(F.lit("range"), *key, *[k.isNull() for k in key]), F.lit(ranges)).alias("_range")

    def digests(df: DataFrame, sign: int) -> DataFrame:
        """Rows with their count and hash in summable halves; a right row counts negative."""
        values = [value(df, c) for c in compared]
        h = F.xxhash64(*key, *[k.isNull() for k in key], *values, *[v.isNull() for v in values])
        parts = {"_n": F.lit(1), "_high": F.shiftright(h, 32), "_low": h.bitwiseAND(F.lit(0xFFFFFFFF))}
        return df.select(*key, some, *[(F.lit(sign) * p).cast("bigint").alias(n) for n, p in parts.items()])

    def differing(frames: Sequence[DataFrame], by: Sequence[str]) -> DataFrame:
        """The groups whose sums over both sides don't cancel out."""
        l, r = frames
        both = l.unionByName(r).groupBy(*by).agg(*[F.sum(c).alias(c) for c in ("_n", "_high", "_low")])
        return both.filter("_n <> 0 or _high <> 0 or _low <> 0").select(*by)

    def within(df: DataFrame, found: DataFrame, by: Sequence[str]) -> DataFrame:
        same = F.lit(True)
        for c in by:
            same &= F.col(f"`{c}`").eqNullSafe(F.col(f"`_is_{c}`"))
        return df.join(measured(found.select(*[F.col(f"`{c}`").alias(f"_is_{c}") for c in by])), same, "left_semi")

    sides = [digests(left, 1), digests(right, -1)]
    in_ranges = differing(sides, ["_range"])
    in_keys = differing([within(s, in_ranges, ["_range"]) for s in sides], keys)
    return diff(within(left, in_keys, keys), within(right, in_keys, keys), keys, columns)

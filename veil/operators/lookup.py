"""Lookups by key lists and key ranges, ordering, and set operations."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from veil.operators.cuts import count_while, depth_cuts, not_above, search_steps
from veil.operators.intervals import interval_union
from veil.runtime import measured
from veil.spec import any_of

#: Parts of the key axis that a table of ranges is dealt to, about.
PARTS = 512
#: Longer literal lists become a table; the rows found are the same.
LITERALS_IN_PLAN = 1000


def lookup(df: DataFrame, keys: DataFrame | Iterable, on: str | Sequence[str], negate: bool = False) -> DataFrame:
    """Rows whose key is in a list of keys (or, with ``negate``, is not), each row once.

    A short literal list becomes an ``IN`` predicate that reaches the scan. A
    table of keys becomes a semi join: broadcast when its measured size
    allows, shuffled otherwise. As in SQL, a row with a null key is in neither
    answer, and nothing is outside a list that holds a null.
    """
    names = [on] if isinstance(on, str) else list(on)
    if not isinstance(keys, DataFrame):
        values = list(dict.fromkeys(keys))
        if len(names) == 1 and len(values) <= LITERALS_IN_PLAN:
            found = F.col(names[0]).isin(values)
            return df.filter(~found if negate else found)
        schema = T.StructType([T.StructField(n, df.schema[n].dataType) for n in names])
        keys = df.sparkSession.createDataFrame([v if len(names) > 1 else (v,) for v in values], schema)
    asked = keys.select(*names).distinct()
    if not negate:
        return df.join(measured(asked), names, "left_semi")
    missing = F.lit(False)
    for n in names:
        missing = missing | F.col(n).isNull()
    if not asked.filter(missing).isEmpty():
        return df.filter(F.lit(False))
    return df.filter(~missing).join(measured(asked), names, "left_anti") if not asked.isEmpty() else df


def _inside(key: Column, lo, hi) -> Column:
    """Half-open range test; a missing bound is open."""
    parts = ([key >= lo] if lo is not None else []) + ([key < hi] if hi is not None else [])
    if not parts:
        return key.isNotNull()
    return parts[0] if len(parts) == 1 else parts[0] & parts[1]


def range_lookup(df: DataFrame, ranges: DataFrame | Iterable[tuple], key: str) -> DataFrame:
    """Rows whose key lies in any of several half-open ranges, each row once.

    A short literal list becomes an ``OR`` of ranges that reaches the scan. A
    table of ranges (columns ``lo``, ``hi``) is merged first, so ranges are
    disjoint, and dealt to parts of the key axis that are cut at quantiles of
    their starts: however wide single ranges are or whatever prefix the keys
    share, a part has its even share of ranges. A part is one row with its ranges in
    order, among them the one that reaches into it from the left. The lookup is
    an equality join on the part and a binary search in it, never a
    comparison of all keys with all ranges.
    """
    if not isinstance(ranges, DataFrame):
        pairs = list(ranges)
        if not pairs:
            return df.filter(F.lit(False))
        if len(pairs) <= LITERALS_IN_PLAN:
            return df.filter(any_of([_inside(F.col(key), lo, hi) for lo, hi in pairs]))
        ends = T.StructType([T.StructField(c, df.schema[key].dataType) for c in ("lo", "hi")])
        ranges = df.sparkSession.createDataFrame(pairs, ends)

    kind = df.schema[key].dataType
    ranges = ranges.select(F.col("lo").cast(kind), F.col("hi").cast(kind))
    ranges = ranges.filter(F.col("lo").isNull() | F.col("hi").isNull() | (F.col("lo") < F.col("hi")))
    n, starts, open_lo, open_hi, first_lo, last_hi = ranges.agg(
        F.count(F.lit(1)), F.approx_count_distinct("lo"), F.count_if(F.col("lo").isNull()), F.count_if(F.col("hi").isNull()), F.min("lo"), F.max("hi")
    ).first()
    if not n:
        return df.filter(F.lit(False))
    # The cut points are a row that every key looks itself up in; they are bounded, however many ranges there are.
    sampled = depth_cuts(ranges.select(F.lit(0).alias("_all"), "lo"), ["_all"], "lo", -(-max(1, starts) // PARTS)).select("cuts").first()
    found = list(sampled["cuts"]) if sampled else []
    cuts = F.array(*[F.lit(c) for c in found]).cast(T.ArrayType(kind))
    powers = F.array(*[F.lit(2**e) for e in range(len(found).bit_length(), -1, -1)])

    def part(value: Column) -> Column:
        return not_above(cuts, powers, value)

    run = F.struct("lo", "hi")
    parts = interval_union(ranges).groupBy(part(F.col("lo")).alias("_part")).agg(F.sort_array(F.collect_list(run)).alias("_own"), F.max(run).alias("_last"))
    every = df.sparkSession.range(len(found) + 1).select(F.col("id").cast("int").alias("_part"))
    # Also a part without a start of its own may be covered by the range that started last before it.
    left = F.last("_last", ignorenulls=True).over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    carried = every.join(parts.select("_part", "_last"), "_part", "left").select("_part", left.alias("_left"))
    runs = F.concat(F.when(F.col("_left").isNull(), F.array()).otherwise(F.array("_left")), F.coalesce("_own", F.array()))
    held = carried.join(parts.select("_part", "_own"), "_part", "left").select("_part", runs.alias("_runs")).filter(F.size("_runs") > 0)
    held = held.withColumn("_steps", search_steps(F.col("_runs")))

    k = F.col(key)
    # The outer bounds are plain comparisons, which let the scan skip files and row groups.
    outer = _inside(k, None if open_lo else first_lo, None if open_hi else last_hi)
    started = count_while(F.col("_runs"), F.col("_steps"), lambda r: r.isNotNull() & (r["lo"].isNull() | (r["lo"] <= k)))
    run = F.get(F.col("_runs"), started - 1)
    inside = (started > 0) & (run["hi"].isNull() | (k < run["hi"]))
    found = df.filter(outer & k.isNotNull()).join(measured(held), part(k) == F.col("_part"))
    return found.filter(inside).select(*[F.col(f"`{c}`") for c in df.columns])


def in_key_order(df: DataFrame, *keys: str) -> DataFrame:
    """Rows in key order (bytes compare unsigned).

    All remaining columns break ties, so the order is fixed and a key with very
    many rows can be split over several sorted partitions. Maps, which have no
    order, count by their sorted entries.
    """
    rest = [_ordered(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields if f.name not in keys]
    return df.orderBy(*keys, *rest)


def _has_order(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_has_order(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _has_order(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def _ordered(c: Column, kind: T.DataType) -> Column:
    """A form of a value that can be sorted by."""
    if _has_order(kind):
        return c
    if isinstance(kind, T.MapType) and _has_order(kind.valueType):
        return F.array_sort(F.map_entries(c))
    return F.to_json(F.struct(c))


def preview(df: DataFrame, n: int, *order_by: str) -> DataFrame:
    """The first ``n`` rows in a fixed order (a top-n, not a full sort)."""
    return in_key_order(df, *order_by).limit(n)


def first_per_key(df: DataFrame, keys: str | Sequence[str], *order) -> DataFrame:
    """One row per key, the first in the given order.

    ``row_number() = 1`` is pruned inside every input partition before the
    shuffle, so a hot key sends one row per partition.
    """
    names = [keys] if isinstance(keys, str) else list(keys)
    if not order:
        raise ValueError("a fixed order is needed to say which row is first")
    window = Window.partitionBy(*names).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") == 1).drop("_rank")


def together(*frames: DataFrame) -> DataFrame:
    """Results of several lookups put together, by column name."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Distinct values of ``a`` that ``b`` lacks."""
    return a.subtract(b)

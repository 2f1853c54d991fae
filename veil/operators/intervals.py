"""Sets of half-open intervals ``[lo, hi)``: merging and intersecting.

Both operators sweep over the interval ends: +1 where one opens, -1 where one
closes, and a running sum tells where the set covers the axis. No interval is
ever paired with all others of its group.

A group that is too big for one task is cut into slabs of the axis of equal
depth, at quantiles of its own interval ends. Each slab is swept on its own,
starting from the sum carried over from the slabs before it; the carries come
from one small row per slab.

A null ``lo`` is open to the left, a null ``hi`` to the right; empty intervals
are ignored, touching ones merge.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from veil.operators.cuts import depth_cuts, not_above
from veil.runtime import measured

ROWS_PER_SLAB = 2_000_000
# Slabs per filling of a slab: spare room for the unevenness of a sample.
SLABS_PER_FILL = 4
# Slabs whose carries are summed in one step; the sums of such blocks make the second one.
SLABS_PER_BLOCK = 1024


def _ends(df: DataFrame, by: Sequence[str], lo: str, hi: str, a: int, b: int) -> DataFrame:
    """Interval ends as (group, t, change of a, change of b); ``t`` null opens at minus infinity."""
    t_lo, t_hi = F.col(lo), F.col(hi)
    solid = df.filter(t_lo.isNull() | t_hi.isNull() | (t_lo < t_hi))
    ends = F.array(
        F.struct(t_lo.alias("t"), F.lit(1).alias("d")),
        F.struct(t_hi.alias("t"), F.lit(-1).alias("d")),
    )
    points = solid.select(*by, F.inline(ends)).filter(F.col("t").isNotNull() | (F.col("d") > 0))
    d = F.col("d").cast("bigint")
    return points.select(*by, "t", (d * a).alias("da"), (d * b).alias("db"))


def _is_on(a: Column, b: Column, two_sided: bool) -> Column:
    return (a > 0) & (b > 0) if two_sided else a > 0


def _changes(df: DataFrame, group: Sequence[str]) -> DataFrame:
    """One row per group and position, where the sums really change."""
    steps = df.groupBy(*group, "t").agg(F.sum("da").alias("da"), F.sum("db").alias("db"))
    return steps.filter((F.col("da") != 0) | (F.col("db") != 0))


def _sweep(points: DataFrame, by: Sequence[str], two_sided: bool) -> DataFrame:
    """Every group in one task: a single shuffle by group serves all steps."""
    steps = _changes(points.repartition(*by) if by else points, by)
    order = Window.partitionBy(*by).orderBy(F.col("t").asc_nulls_first())
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    a, b = F.sum("da").over(running), F.sum("db").over(running)
    edges = steps.select(
        *by, "t", _is_on(a, b, two_sided).alias("on"),
        _is_on(a - F.col("da"), b - F.col("db"), two_sided).alias("was"),
    ).filter(F.col("on") != F.col("was"))
    pieces = edges.select(*by, F.col("t").alias("lo"), F.lead("t").over(order).alias("hi"), "on")
    return pieces.filter("on").drop("on")


def _sweep_slabs(points: DataFrame, by: Sequence[str], two_sided: bool) -> DataFrame:
    """Every slab of a group in a task of its own.

    What a slab inherits from the slabs before it goes first in it, as one
    more row, so no join is needed.
    """
    cell = [*by, "slab"]
    in_order = F.col("t").asc_nulls_first()
    running = Window.partitionBy(*cell).orderBy("step", in_order).rowsBetween(Window.unboundedPreceding, 0)

    def inherited(df: DataFrame, *columns: str) -> DataFrame:
        """What every slab gets from those before it: sums inside a block of slabs, and sums of whole blocks."""
        before = Window.partitionBy(*by, "block").orderBy("slab").rowsBetween(Window.unboundedPreceding, -1)
        blocks_before = Window.partitionBy(*by).orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        zero = F.lit(0).cast("bigint")
        block = F.floor(F.col("slab") / SLABS_PER_BLOCK).alias("block")
        per_slab = df.groupBy(*cell, block).agg(*[F.sum(c).alias(c) for c in columns])
        per_block = per_slab.groupBy(*by, "block").agg(*[F.sum(c).alias(c) for c in columns])
        per_block = per_block.select(
            *[F.col(c).alias(f"_of_{c}") for c in [*by, "block"]], *[F.coalesce(F.sum(c).over(blocks_before), zero).alias(f"_all_{c}") for c in columns]
        )
        same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in [*by, "block"]])
        inside = per_slab.select(*cell, "block", *[F.coalesce(F.sum(c).over(before), zero).alias(c) for c in columns])
        carried = [(F.col(c) + F.col(f"_all_{c}")).alias(c) for c in columns]
        return inside.join(per_block, same).select(*cell, *carried, F.lit(False).alias("step"))

    steps = _changes(points, cell).withColumn("step", F.lit(True))
    swept = steps.unionByName(inherited(steps, "da", "db"), allowMissingColumns=True)
    a, b = F.sum("da").over(running), F.sum("db").over(running)
    edges = (
        swept.select(
            *cell, "t", "step", _is_on(a, b, two_sided).alias("on"),
            _is_on(a - F.col("da"), b - F.col("db"), two_sided).alias("was"),
        )
        .filter(F.col("step") & (F.col("on") != F.col("was")))
        .select(*cell, "t", "step", "on", F.col("on").cast("bigint").alias("opens"))
    )
    counted = edges.unionByName(inherited(edges, "opens"), allowMissingColumns=True)
    numbered = counted.select(*by, "t", "step", "on", F.sum("opens").over(running).alias("piece")).filter("step")
    return (
        numbered.groupBy(*by, "piece")
        .agg(F.max(F.when(F.col("on"), F.col("t"))).alias("lo"), F.max(F.when(~F.col("on"), F.col("t"))).alias("hi"))
        .drop("piece")
    )


def _covered(
    sides: Sequence[tuple[DataFrame, int, int]], by: Sequence[str], lo: str, hi: str, rows_per_slab: int
) -> DataFrame:
    """Pieces of the axis that all sides cover.

    The groups are measured first. Those that fit a task are swept as they
    are; only the big ones are cut, each over its own part of the axis.
    """
    two_sided = len(sides) > 1

    def together(frames: Sequence[DataFrame]) -> DataFrame:
        return reduce(DataFrame.unionByName, frames)

    def points() -> DataFrame:
        return together([_ends(df, by, lo, hi, a, b) for df, a, b in sides])

    ends = together([df.select(*by) if by else df.select(F.lit(0).alias("_all")) for df, _, _ in sides])
    sizes = ends.groupBy(*(by or ["_all"])).agg((F.count(F.lit(1)) * 2).alias("_n"))
    biggest = sizes.agg(F.max("_n")).first()[0]
    if (biggest or 0) <= rows_per_slab:
        return _sweep(points(), by, two_sided)

    # No group at all is one group.
    groups = list(by) or ["_all"]
    sides = sides if by else [(df.withColumn("_all", F.lit(0)), a, b) for df, a, b in sides]
    big = measured(sizes.filter(F.col("_n") > rows_per_slab).select(*[F.col(c).alias(f"_big_{c}") for c in groups]))
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_big_{c}")) for c in groups])

    def ends_of(how: str) -> DataFrame:
        return together([_ends(df.join(big, same, how), groups, lo, hi, a, b) for df, a, b in sides])

    big_points = ends_of("left_semi")
    cuts = depth_cuts(big_points.select(*groups, "t"), groups, "t", max(1, rows_per_slab // SLABS_PER_FILL))
    cuts = measured(cuts.withColumnsRenamed({c: f"_cut_{c}" for c in groups}))
    same_cuts = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_cut_{c}")) for c in groups])
    slab = F.when(F.col("t").isNull(), -1).otherwise(F.coalesce(not_above(F.col("cuts"), F.col("steps"), F.col("t")), F.lit(0))).cast("bigint")
    placed = big_points.join(cuts, same_cuts, "left").select(*groups, "t", "da", "db", slab.alias("slab"))
    pieces = _sweep_slabs(placed, groups, two_sided)
    if not by:
        return pieces.drop("_all")
    return _sweep(ends_of("left_anti"), by, two_sided).unionByName(pieces)


def interval_union(
    df: DataFrame, by: Sequence[str] = (), lo: str = "lo", hi: str = "hi", rows_per_slab: int = ROWS_PER_SLAB
) -> DataFrame:
    """Merge the overlapping and touching intervals of every group."""
    return _covered([(df, 1, 0)], list(by), lo, hi, rows_per_slab)


def interval_intersect(
    a: DataFrame, b: DataFrame, by: Sequence[str] = (), lo: str = "lo", hi: str = "hi",
    rows_per_slab: int = ROWS_PER_SLAB,
) -> DataFrame:
    """The parts of the axis covered by both sets, group by group."""
    return _covered([(a, 1, 0), (b, 0, 1)], list(by), lo, hi, rows_per_slab)

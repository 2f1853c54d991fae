"""Cut points: an axis of any ordered type cut into parts of equal depth.

Cut points are quantiles of a sample of the values themselves, so neither a far outlier nor a long
common prefix leaves a part that holds most of them. The sample is drawn by hash: it is the same
in every run, and a value that repeats counts once.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Sampled values for each part of the axis.
SAMPLES = 64


def count_while(values: Column, steps: Column, holds: Callable[[Column], Column]) -> Column:
    """How many entries of a sorted array a predicate holds for, given that it holds for its first ones only.

    A binary search: ``steps`` has the powers of two up to the array's length, falling.
    """
    return F.reduce(steps, F.lit(0), lambda at, step: at + F.when(holds(F.get(values, at + step - 1)), step).otherwise(0))


def search_steps(values: Column) -> Column:
    """The steps of a binary search in an array; worth to be kept in a column beside it."""
    top = F.floor(F.log2(F.greatest(F.size(values), F.lit(1)).cast("double"))).cast("int")
    return F.transform(F.sequence(top, F.lit(0), F.lit(-1)), lambda e: F.pow(F.lit(2.0), e).cast("int"))


def not_above(cuts: Column, steps: Column, value: Column) -> Column:
    """The number of cut points at or below a value, which is the number of its part; a null value is in part 0."""
    return count_while(cuts, steps, lambda cut: cut <= value)


def depth_cuts(values: DataFrame, by: Sequence[str], value: str, depth: int) -> DataFrame:
    """(by, ``cuts``, ``steps``): for each group its cut points, with about ``depth`` distinct values between two.

    What a group collects is some ``SAMPLES`` values for each of its parts.
    """
    sampled = max(1, depth // SAMPLES)
    every = max(1, depth // sampled)
    some = values.filter(F.col(value).isNotNull() & (F.pmod(F.xxhash64(value), F.lit(sampled)) == 0))
    cuts = F.filter(F.sort_array(F.collect_set(value)), lambda _, i: i % every == every - 1)
    return some.groupBy(*by).agg(cuts.alias("cuts")).withColumn("steps", search_steps(F.col("cuts")))

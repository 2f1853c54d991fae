"""Coders: a column's own stored form, both ways."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Coder:
    """How a column's values are stored (``encode``: typed to stored) and read again (``decode``: stored to typed).

    Both are column expressions; the stored form is what the cell table holds, text or bytes. A null
    stays null both ways.
    """

    encode: Callable[[Column], Column]
    decode: Callable[[Column], Column]


def decoder(coder: Coder | Callable[[Column], Column]) -> Callable[[Column], Column]:
    """The reading half of a coder; a bare function is one itself."""
    return coder.decode if isinstance(coder, Coder) else coder


def broken_round_trips(rows: DataFrame, coders: Mapping[str, Coder]) -> DataFrame:
    """(column, value, stored, again): values that a coder doesn't give back, as texts."""
    failures = []
    for name, coder in coders.items():
        value = F.col(f"`{name}`")
        stored = coder.encode(value)
        again = coder.decode(stored)
        shown = F.struct(
            F.lit(name).alias("column"), value.cast("string").alias("value"), stored.cast("string").alias("stored"), again.cast("string").alias("again")
        )
        failures.append(F.when(~value.eqNullSafe(again), shown))
    return rows.select(F.explode(F.array_compact(F.array(*failures))).alias("f")).select("f.*")


def check_round_trips(rows: DataFrame, coders: Mapping[str, Coder]) -> None:
    """Raise an error if some value of ``rows`` isn't given back by its coder."""
    bad = broken_round_trips(rows, coders).first()
    if bad is not None:
        raise ValueError(f"the coder of {bad['column']!r} stores {bad['value']!r} as {bad['stored']!r} and reads {bad['again']!r}")

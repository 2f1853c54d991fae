"""Row predicates with SQL three-valued logic.

They are ordinary columns: Catalyst normalises negations, moves key predicates
below the cell aggregation and into the Parquet scan, and keeps predicates on
values above it, where they test the newest version. A missing value makes a
comparison unknown, and the row is dropped, also under ``NOT``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def _column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def in_list(c, values: Iterable) -> Column:
    """``c IN (...)``: a hash set in the plan, of any length; a table of values belongs in ``lookup``."""
    return _column(c).isin(list(values))


def not_in_list(c, values: Iterable) -> Column:
    return ~in_list(c, values)


def in_but_not_in(c, values: Iterable, excluded: Iterable) -> Column:
    """In the first list and not in the second."""
    return in_list(c, values) & not_in_list(c, excluded)


def contains(c, text: str, ci: bool = False) -> Column:
    """Literal substring; case counts unless ``ci``."""
    c = _column(c)
    return F.lower(c).contains(text.lower()) if ci else c.contains(text)


def not_contains(c, text: str, ci: bool = False) -> Column:
    return ~contains(c, text, ci)


def starts_with(c, text: str) -> Column:
    return _column(c).startswith(text)


def ends_with(c, text: str) -> Column:
    """Literal suffix: no pattern characters."""
    return _column(c).endswith(text)


def select_fields(df: DataFrame, fields: str) -> DataFrame:
    """Columns named by a comma-separated configuration text; empty names are skipped."""
    names = [n.strip() for n in fields.split(",")]
    return df.select(*[n for n in names if n])

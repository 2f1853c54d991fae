"""Mapping spec: how columns of a typed view lie in a table of versioned cells.

A cell table is a long DataFrame: the key column(s), ``cf`` (family),
``qualifier``, ``ts`` (bigint) and ``value``. A spec is a plain dict::

    {"key": [("bp", "string")],
     "columns": {"iban": {"cf": "demographics", "col": "iban", "type": "string"}}}

Column forms, by type and ``col``:

* any type, ``col`` given                  one value per key (the newest)
* ``map<bigint,T>``, ``col`` given         time series: timestamp -> value
* ``map<string,T>``, empty ``col``         dynamic: undeclared qualifier -> newest value
* ``map<string,map<bigint,T>>``, empty     dynamic with history
* ``map<string,T>``, ``regex`` given       dynamic over the qualifiers the pattern matches
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, functions as F, types as T

CF, QUALIFIER, TS, VALUE = "cf", "qualifier", "ts", "value"

FIXED_WIDTH = {
    T.BooleanType: 1,
    T.ByteType: 1,
    T.ShortType: 2,
    T.IntegerType: 4,
    T.LongType: 8,
    T.FloatType: 4,
    T.DoubleType: 8,
}


def parse_type(ddl: str | T.DataType) -> T.DataType:
    if isinstance(ddl, T.DataType):
        return ddl
    return T.StructType.fromDDL(f"c {ddl}")["c"].dataType


@dataclass(frozen=True)
class KeyField:
    name: str
    type: T.DataType
    length: int | None = None

    @property
    def width(self) -> int | None:
        """Bytes in a raw key; ``None`` when only the data tells."""
        return self.length or FIXED_WIDTH.get(type(self.type))


@dataclass(frozen=True)
class CellColumn:
    name: str
    cf: str
    qualifier: str
    type: T.DataType
    regex: str | None = None

    @property
    def is_dynamic(self) -> bool:
        return self.regex is not None or self.qualifier == ""

    @property
    def is_series(self) -> bool:
        """True when the column keeps the version history of a cell."""
        kind = self.type
        if self.is_dynamic:
            kind = kind.valueType
        return isinstance(kind, T.MapType) and isinstance(kind.keyType, T.LongType)

    @property
    def value_type(self) -> T.DataType:
        """Type of a single cell value."""
        kind = self.type
        if self.is_dynamic:
            kind = kind.valueType
        return kind.valueType if self.is_series else kind


@dataclass(frozen=True)
class CellSpec:
    keys: tuple[KeyField, ...]
    columns: tuple[CellColumn, ...]

    @property
    def key_names(self) -> list[str]:
        return [k.name for k in self.keys]

    @property
    def names(self) -> list[str]:
        return self.key_names + [c.name for c in self.columns]

    @property
    def families(self) -> list[str]:
        return list(dict.fromkeys(c.cf for c in self.columns))

    @property
    def schema(self) -> T.StructType:
        fields = [T.StructField(k.name, k.type) for k in self.keys]
        return T.StructType(fields + [T.StructField(c.name, c.type) for c in self.columns])

    def column(self, name: str) -> CellColumn:
        for c in self.columns:
            if c.name == name:
                return c
        raise ValueError(f"no column {name!r} in the spec; it has {self.names}")

    def declared(self, cf: str) -> list[str]:
        """Qualifiers of a family that have a column of their own."""
        return [c.qualifier for c in self.columns if c.cf == cf and not c.is_dynamic]

    def match(self, c: CellColumn) -> Column:
        """Predicate on a cell: does it feed column ``c``?

        A dynamic column never takes a declared qualifier, whether or not that
        qualifier's column is part of the current projection.
        """
        same_family = F.col(CF) == c.cf
        if c.regex is not None:
            return same_family & F.col(QUALIFIER).rlike(f"^(?:{c.regex})$")
        if c.is_dynamic:
            declared = self.declared(c.cf)
            return same_family & ~F.col(QUALIFIER).isin(declared) if declared else same_family
        return same_family & (F.col(QUALIFIER) == c.qualifier)

    def map_key(self, c: CellColumn) -> Column:
        """Map key of a dynamic column: the qualifier, or the part its pattern captures."""
        if c.regex is not None:
            return F.regexp_extract(F.col(QUALIFIER), f"^(?:{c.regex})$", 1)
        return F.col(QUALIFIER)


def cell_spec(spec: CellSpec | Mapping) -> CellSpec:
    """Build and check a spec from its dict form (needs an active session for type texts)."""
    if isinstance(spec, CellSpec):
        return spec
    keys = []
    for entry in spec["key"]:
        name, ddl, *length = entry
        keys.append(KeyField(name, parse_type(ddl), length[0] if length else None))
    columns = []
    for name, c in spec["columns"].items():
        if not c.get("cf"):
            raise ValueError(f"column {name!r} has no family")
        column = CellColumn(
            name, c["cf"], c.get("col", name), parse_type(c.get("type", "string")), c.get("regex")
        )
        if column.is_dynamic and not (
            isinstance(column.type, T.MapType) and isinstance(column.type.keyType, T.StringType)
        ):
            raise ValueError(f"dynamic column {name!r} needs a map<string,...> type")
        columns.append(column)
    out = CellSpec(tuple(keys), tuple(columns))
    if not out.keys:
        raise ValueError("a spec needs at least one key column")
    if len(set(out.names)) != len(out.names):
        raise ValueError("duplicate column names in the spec")
    return out


def check_key_layout(dims: Sequence[KeyField]) -> None:
    """In a raw composite key only the last dimension may have a varying width."""
    for dim in dims[:-1]:
        if dim.width is None:
            raise ValueError(f"key dimension {dim.name!r} varies in length and is not the last one")


def check_time_options(timestamp=None, min_ts=None, max_ts=None) -> None:
    """None, one timestamp, or both ends of a range; anything else is an error."""
    ends = (min_ts is not None) + (max_ts is not None)
    if timestamp is not None and ends:
        raise ValueError("give either a timestamp or a time range, not both")
    if ends == 1:
        raise ValueError("a time range needs both min_ts and max_ts")


def any_of(predicates: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, predicates)

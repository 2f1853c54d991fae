"""Cell values as text, nested values, and value normalisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from veil.spec import parse_type

_NESTED = (T.StructType, T.ArrayType, T.MapType)


def to_text(c: Column, kind: T.DataType) -> Column:
    """Text form of a typed value; null stays null."""
    if isinstance(kind, T.BinaryType):
        return F.base64(c)
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(c).cast("string")
    if isinstance(kind, _NESTED):
        return F.to_json(c)
    return c.cast("string")


def from_text(c: Column, kind: T.DataType) -> Column:
    """Typed value of a cell text; malformed text gives null, not an error."""
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.BinaryType):
        return F.try_to_binary(c, F.lit("base64"))
    if isinstance(kind, T.TimestampType):
        return F.timestamp_millis(c.try_cast("bigint"))
    if isinstance(kind, _NESTED):
        return F.from_json(c, kind)
    return c.try_cast(kind)


def decode_value(c: Column, stored: T.DataType, wanted: T.DataType) -> Column:
    """A stored cell value as the type its column declares."""
    if stored == wanted:
        return c
    if isinstance(stored, T.StringType):
        return from_text(c, wanted)
    return c.try_cast(wanted)


def encode_value(c: Column, have: T.DataType, stored: T.DataType | None = None) -> Column:
    if stored is None or isinstance(stored, T.StringType):
        return to_text(c, have)
    return c if have == stored else c.cast(stored)


def nested_value(df: DataFrame, column: str, schema: str | T.DataType) -> DataFrame:
    """Turn a text column holding a record, array or map into a typed one."""
    return df.withColumn(column, F.from_json(F.col(column), parse_type(schema)))


def nested_text(df: DataFrame, column: str) -> DataFrame:
    """The way back of :func:`nested_value`."""
    return df.withColumn(column, F.to_json(F.col(column)))


def normalised(c: Column, kind: T.DataType) -> Column:
    """Widened, store-independent form of one value.

    Integers become bigint, floating numbers double, decimals text, and
    timestamps epoch milliseconds (rounded down); records, arrays and maps are
    normalised inside.
    """
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return c.cast("bigint")
    if isinstance(kind, T.FloatType):
        return c.cast("double")
    if isinstance(kind, T.DecimalType):
        return c.cast("string")
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(c)
    if isinstance(kind, T.TimestampNTZType):
        return ntz_millis(c)
    if isinstance(kind, T.StructType):
        inner = [normalised(c[f.name], f.dataType).alias(f.name) for f in kind.fields]
        return F.when(c.isNotNull(), F.struct(*inner))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: normalised(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(c, lambda _, v: normalised(v, kind.valueType))
    return c


def normalise(df: DataFrame) -> DataFrame:
    return df.select(*[normalised(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def ntz_millis(c: Column) -> Column:
    """Epoch milliseconds of a zone-less timestamp read as UTC, whatever the session zone."""
    day = F.unix_date(c.cast("date")).cast("bigint")
    clock = F.hour(c) * 3_600_000 + F.minute(c) * 60_000
    seconds = F.floor(F.extract(F.lit("SECOND"), c) * 1000).cast("bigint")
    return day * F.lit(86_400_000).cast("bigint") + clock.cast("bigint") + seconds

"""Composite row keys: fixed-width dimensions first, an open one only at the end."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from veil.functions.codec import from_bytes, to_bytes
from veil.spec import FIXED_WIDTH, KeyField, check_key_layout, parse_type


def _dims(dims: Sequence) -> list[KeyField]:
    out = []
    for d in dims:
        if not isinstance(d, KeyField):
            name, ddl, *length = d
            d = KeyField(name, parse_type(ddl), length[0] if length else None)
        out.append(d)
    check_key_layout(out)
    return out


def key_bytes(dims: Sequence) -> Column:
    """Raw key as one binary column; null when any dimension is null."""
    return F.concat(*[to_bytes(F.col(d.name), d.type, d.length) for d in _dims(dims)])


def key_parts(rowkey: Column, dims: Sequence) -> list[Column]:
    """Typed dimensions of a raw key, in order; those that a key is too short for are null."""
    parts, start = [], 1
    for d in _dims(dims):
        if d.width is None:
            piece = F.substr(rowkey, F.lit(start))
        else:
            piece = F.when(F.octet_length(rowkey) >= start + d.width - 1, F.substring(rowkey, start, d.width))
            start += d.width
        parts.append(from_bytes(piece, d.type).alias(d.name))
    return parts


def build_key(df: DataFrame, dims: Sequence, rowkey: str = "rowkey") -> DataFrame:
    """Replace the dimension columns by one binary key column."""
    fields = _dims(dims)
    names = {d.name for d in fields}
    rest = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(key_bytes(fields).alias(rowkey), *rest)


def split_key(df: DataFrame, dims: Sequence, rowkey: str = "rowkey") -> DataFrame:
    """Replace a binary key column by its typed dimensions."""
    rest = [F.col(f"`{c}`") for c in df.columns if c != rowkey]
    return df.select(*key_parts(F.col(rowkey), dims), *rest)


def key_block(rowkey: Column, prefix: bytes) -> Column:
    """Rows whose raw key starts with ``prefix``, as a range that Parquet statistics can prune."""
    lower = rowkey >= F.lit(bytes(prefix))
    trimmed = bytes(prefix).rstrip(b"\xff")
    if not trimmed:
        return lower
    return lower & (rowkey < F.lit(trimmed[:-1] + bytes([trimmed[-1] + 1])))


def first_dimension(rowkey: Column, kind, op: str, value: int) -> Column:
    """Predicate on an integer first dimension, put on the raw key itself.

    The rows form one or two contiguous blocks of the key order, so a table
    laid out by key range is pruned by file statistics; nothing is decoded.
    Negative numbers lie behind the others in byte order.
    """
    width = FIXED_WIDTH[type(parse_type(kind))]
    half = 1 << (8 * width - 1)
    if not -half <= value < half:
        raise ValueError(f"{value} does not fit into {width} bytes")
    if op in ("<=", ">="):
        edge = -half if op == ">=" else half - 1
        if value == edge:
            return rowkey.isNotNull()
        return first_dimension(rowkey, kind, op[0], value + (1 if op == "<=" else -1))

    def key(v: int) -> Column:
        return F.lit(v.to_bytes(width, "big", signed=True))

    negatives = rowkey >= key(-half)
    if op == "=":
        return key_block(rowkey, value.to_bytes(width, "big", signed=True))
    if op == "<":
        if value > 0:
            return (rowkey < key(value)) | negatives
        return negatives if value == 0 else negatives & (rowkey < key(value))
    if op == ">":
        if value == half - 1:
            return rowkey.isNull() & rowkey.isNotNull()
        if value >= -1:
            return (rowkey >= key(value + 1)) & ~negatives
        return (rowkey >= key(value + 1)) | ~negatives
    raise ValueError(f"unknown comparison {op!r}")

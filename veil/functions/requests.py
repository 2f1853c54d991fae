"""Request lines: comma-separated text whose first field is the key to forget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# The field order of a full request record.
REQUEST_FIELDS = "rowkey string, level string, bp string, pdl string, custid string"


def request_key(line: Column) -> Column:
    """First field of a line, trimmed; null for a blank one."""
    return F.nullif(F.trim(F.split(line, ",", 2)[0]), F.lit(""))


def parse_requests(lines: DataFrame, key: str = "bp", line: str = "value") -> DataFrame:
    """One row per usable request line, holding only the key (text, never a number)."""
    return lines.select(request_key(F.col(line)).alias(key)).filter(F.col(key).isNotNull())


def request_record(line: Column, fields: str = REQUEST_FIELDS) -> Column:
    """The full record of a line as a struct; fields missing at the end are null."""
    spaces = {"ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    return F.from_csv(line, fields, spaces)


def parse_records(lines: DataFrame, line: str = "value", fields: str = REQUEST_FIELDS) -> DataFrame:
    return lines.select(request_record(F.col(line), fields).alias("r")).select("r.*")


def request_counts(lines: DataFrame, line: str = "value") -> DataFrame:
    """How many lines came in, and how many of them were blank and so dropped."""
    return lines.agg(
        F.count(F.lit(1)).alias("lines"),
        F.count_if(request_key(F.col(line)).isNull()).alias("blank"),
    )

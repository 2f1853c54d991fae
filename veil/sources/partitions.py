"""Erasure in tables with partition columns of their own, by path or by catalog name.

The partitions to rewrite are found by a semi join that reads the key and the partition columns
only. Their new contents are staged and noted in a log, then moved into the table partition
by partition, and the log says when that is done: whatever step is interrupted, the next call
finishes it from the staged copy.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F, types as T

from veil.operators.erase import KINDS, answer, request_keys, unmatched
from veil.runtime import file_system, measured, remove_folder, work_base, work_dir
from veil.sources.commits import CommitLog
from veil.sources.tables import _is_path, _spread, read_table, rewrite_partitions
from veil.spec import any_of

#: Partitions that are named in a predicate; more of them are found by a join.
PARTITIONS_IN_PLAN = 200
LOG_PROPERTY = "veil.erasures"
# Fixed value: the folder name of a null partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    """The partition columns of a table: from the catalog, or from the folder names below its path."""
    if not _is_path(table):
        return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    fs, path = file_system(spark, table)
    names, at = [], path(table)
    while True:
        below = [s.getPath() for s in fs.listStatus(at) if s.isDirectory() and "=" in s.getPath().getName()]
        if not below:
            return names
        names.append(below[0].getName().split("=", 1)[0])
        at = below[0]


def erasure_log(spark: SparkSession, table: str) -> CommitLog:
    """Where erasures of a table are noted: beside its files, or in the shared work folder.

    There the table itself names the folder, so a new table of an old name starts afresh.
    """
    if _is_path(table):
        return CommitLog(spark, f"{table.rstrip('/')}/_erasures")
    noted = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == LOG_PROPERTY).first()
    name = noted["value"] if noted else uuid.uuid4().hex
    if not noted:
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{LOG_PROPERTY}' = '{name}')")
    return CommitLog(spark, f"{work_base(spark)}/erasures-{name}")


def touched_partitions(target: DataFrame, requests: DataFrame, key: str, by: Sequence[str]) -> DataFrame:
    """The distinct partition values of the rows of requested keys; no other column is read."""
    asked = request_keys(requests, key)
    rows = target.select(*dict.fromkeys([key, *by]))
    hit = rows.join(measured(asked), F.col(key).cast("string") == F.col("_request"), "left_semi")
    return hit.select(*by).distinct()


def _same(by: Sequence[str], row: Row) -> Column:
    out = F.lit(True)
    for c in by:
        out &= F.col(c).isNull() if row[c] is None else F.col(c) == F.lit(row[c])
    return out


def only_partitions(target: DataFrame, partitions: DataFrame, values: Sequence[Row], by: Sequence[str]) -> DataFrame:
    """Rows of some partitions: a predicate the scan is pruned by, or a null-safe join where they are many."""
    if len(values) <= PARTITIONS_IN_PLAN:
        return target.filter(any_of([_same(by, r) for r in values]))
    named = partitions.select(*[F.col(c).alias(f"_{c}") for c in by])
    same = F.lit(True)
    for c in by:
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return target.join(measured(named), same, "left_semi")


def stage_partitions(
    spark: SparkSession, table: str, requests: DataFrame, key: str, kind: str = "mask", masks: Mapping | None = None,
    order: Sequence | None = None, staging: str | None = None, by: Sequence[str] | None = None,
) -> dict | None:
    """Write the new contents of all touched partitions to a staging folder; ``None`` if there is nothing to do.

    The names of partitions reach the driver, never keys or values. ``by`` is needed only for an
    empty table given by its path.
    """
    by = list(by or partition_columns(spark, table))
    if not by:
        raise ValueError(f"{table} has no partition columns")
    if key in by:
        raise ValueError("a table partitioned by the key itself has a folder for every person")
    target = read_table(spark, table)
    found = touched_partitions(target, requests, key, by)
    upsert = bool((KINDS[kind] or {}).get("upsert_unmatched"))
    values = found.collect()
    rest = [c for c in target.columns if c != key] if order is None else order
    staging = staging or work_dir(spark, "partitions")
    if upsert:
        # A key without a row gets one in the null partition, beside the rows that are there.
        nowhere = Row(**dict.fromkeys(by))
        held = [r for r in values if any(r[c] is not None for c in by)] + [nowhere]
        present = only_partitions(target, found.unionByName(spark.createDataFrame([nowhere], found.schema)), held, by)
        changed = answer(present, requests, key, kind, masks, rest)
        if nowhere not in values and unmatched(present, requests, key).isEmpty():
            changed = changed.filter(~_same(by, nowhere))
            held = held[:-1]
        values = held
    elif values:
        changed = answer(only_partitions(target, found, values, by), requests, key, kind, masks, rest)
    if not values:
        return None
    try:
        _spread(changed, by).write.mode("overwrite").partitionBy(*by).parquet(staging)
    except Exception:
        remove_folder(spark, staging)
        raise
    shown = spark.createDataFrame(values, found.schema).select(*_texts(by))
    return {"staging": staging, "by": by, "partitions": [list(r) for r in shown.collect()]}


def _texts(by: Sequence[str]) -> list[Column]:
    return [F.col(c).cast("string").alias(c) for c in by]


def _partition_path(by: Sequence[str], values: Sequence[str | None], spark: SparkSession) -> str:
    escape = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    return "/".join(f"{c}={NULL_PARTITION if v in (None, '') else escape(v)}" for c, v in zip(by, values, strict=True))


def publish_partitions(spark: SparkSession, table: str, entry: Mapping) -> None:
    """Move staged partitions into the table, and drop those that lost all their rows; may be repeated."""
    by, staging = entry["by"], entry["staging"]
    staged = spark.read.schema(read_table(spark, table).schema).parquet(staging)
    kept = {tuple(r) for r in staged.select(*_texts(by)).distinct().collect()}
    if kept:
        rewrite_partitions(staged, table, by)
    gone = [p for p in map(tuple, entry["partitions"]) if p not in kept]
    if _is_path(table):
        for p in gone:
            remove_folder(spark, f"{table.rstrip('/')}/{_partition_path(by, p, spark)}")
    elif gone:
        kinds = {f.name: f.dataType for f in staged.schema.fields}

        def literal(column, value):
            if value is None:
                return "null"
            text = "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
            if isinstance(kinds[column], (T.NumericType, T.BooleanType)):
                return value
            return f"DATE {text}" if isinstance(kinds[column], T.DateType) else text

        def named(p):
            return "PARTITION (" + ", ".join(f"`{c}` = {literal(c, v)}" for c, v in zip(by, p, strict=True)) + ")"

        for p in gone:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {named(p)}")


def recover(spark: SparkSession, table: str) -> bool:
    """Finish an erasure that was interrupted while it was published; tells whether there was one."""
    log = erasure_log(spark, table)
    number, entry = log.last()
    if entry.get("state") != "staged":
        return False
    publish_partitions(spark, table, entry)
    log.put(number, {"state": "applied", "token": entry.get("token")})
    remove_folder(spark, entry["staging"])
    log.trim()
    return True


def erase_in_partitions(
    spark: SparkSession, table: str, requests: DataFrame, key: str, kind: str = "mask", masks: Mapping | None = None,
    order: Sequence | None = None, token: str | None = None, by: Sequence[str] | None = None,
) -> list[list[str | None]]:
    """Answer requests in a table with partition columns of its own; returns the rewritten partitions as texts.

    An interrupted erasure is finished first. A ``token`` (a batch's name) that was the last
    one applied is not applied again.
    """
    recover(spark, table)
    log = erasure_log(spark, table)
    number, last = log.last()
    if token is not None and last.get("token") == token:
        return []
    entry = stage_partitions(spark, table, requests, key, kind, masks, order, by=by)
    if entry is None:
        return []
    log.put(number, {**entry, "state": "staged", "token": token})
    recover(spark, table)
    return entry["partitions"]

"""Parquet tables: partitioned client tables, cell tables, and snapshots."""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from veil.operators.erase import answer, erase, purge, request_keys
from veil.runtime import file_system, remove_folder, work_dir
from veil.spec import CF, QUALIFIER, TS, any_of

BUCKET = "bucket"
MIN_RANGES = 4
#: Files of a cell table that a purge rewrites in one step.
FILES_AT_ONCE = 500
LAYOUT_FILE = "_layout.json"
LAYOUT_PROPERTY = "veil.layout"


# --- partitioned tables -----------------------------------------------------
# A table is given by its path, or by its name in the session catalog.

def _is_path(table: str) -> bool:
    return "/" in table


def _write_layout(spark: SparkSession, table: str, key: str, buckets: int, schema: T.StructType) -> None:
    """Note key, bucket count and schema with the table: a hidden file, or a table property."""
    if not _is_path(table):
        text = json.dumps({"key": key, "buckets": buckets}).replace("'", "\\'")
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{LAYOUT_PROPERTY}' = '{text}')")
        return
    fs, make = file_system(spark, table)
    out = fs.create(make(make(table), LAYOUT_FILE), True)
    try:
        out.write(json.dumps({"key": key, "buckets": buckets, "schema": schema.jsonValue()}).encode())
    finally:
        out.close()


def read_layout(spark: SparkSession, table: str) -> dict | None:
    """What :func:`write_bucketed` or :func:`adopt_bucketed` noted of a table, if anything."""
    if not _is_path(table):
        noted = spark.sql(f"SHOW TBLPROPERTIES {table}").filter(F.col("key") == LAYOUT_PROPERTY).first()
        return None if noted is None else json.loads(noted["value"])
    fs, make = file_system(spark, table)
    path = make(make(table), LAYOUT_FILE)
    if not fs.exists(path):
        return None
    source = fs.open(path)
    try:
        layout = json.loads(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8"))
    finally:
        source.close()
    layout["schema"] = T.StructType.fromJson(layout["schema"])
    return layout


def _bucket_count(spark: SparkSession, table: str, key: str, expected: int | None) -> int:
    """The bucket count noted with the table; whoever expects another key or count is refused."""
    layout = read_layout(spark, table)
    if layout is None:
        raise ValueError(f"{table} has no noted bucket layout; see adopt_bucketed()")
    if layout["key"] != key:
        raise ValueError(f"{table} is bucketed by {layout['key']!r}, not by {key!r}")
    if expected is not None and expected != layout["buckets"]:
        raise ValueError(f"{table} has {layout['buckets']} buckets, not {expected}")
    return layout["buckets"]


def adopt_bucketed(spark: SparkSession, table: str, key: str, buckets: int) -> None:
    """Note the layout of a bucketed table that has none yet, after a look at the bucket of every row."""
    df = read_table(spark, table)
    wrong = df.filter(~F.col(BUCKET).eqNullSafe(bucket_of(F.col(key), buckets)))
    if not wrong.isEmpty():
        raise ValueError(f"{table} is not laid out in {buckets} buckets of {key!r}")
    _write_layout(spark, table, key, buckets, df.schema)


def read_table(spark: SparkSession, table: str, **partition_values) -> DataFrame:
    """A partitioned table, optionally only some partitions (pruned before any file is opened).

    A table whose layout is noted can be read when all its partitions are gone, too.
    """
    if _is_path(table):
        layout = read_layout(spark, table)
        df = spark.read.parquet(table) if layout is None else spark.read.schema(layout["schema"]).parquet(table)
    else:
        # another session (a stream has its own) may have replaced files since the last listing
        spark.catalog.refreshTable(table)
        df = spark.table(table)
    for name, value in partition_values.items():
        column = F.col(name)
        df = df.filter(column.isin(list(value)) if isinstance(value, (list, tuple, set)) else column == value)
    return df


def bucket_of(key: Column, buckets: int) -> Column:
    """Partition number of a key: one folder per bucket, not one per person."""
    return F.pmod(F.xxhash64(key.cast("string")), F.lit(buckets)).cast("int")


def _spread(df: DataFrame, partition_columns: Sequence[str]) -> DataFrame:
    """Rows of one partition together, but split over several tasks where a partition is large."""
    return df.hint("rebalance", *partition_columns)


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int, mode: str = "errorifexists") -> None:
    """Write a table partitioned by the hash bucket of its key, and note key and bucket count with it.

    Appending to a table that has another layout is refused.
    """
    spark = df.sparkSession
    if mode == "append" and _exists(spark, table):
        _bucket_count(spark, table, key, buckets)
    placed = df.withColumn(BUCKET, bucket_of(F.col(key), buckets))
    writer = _spread(placed, [BUCKET]).write.mode(mode).partitionBy(BUCKET).format("parquet")
    if mode == "ignore" and _exists(spark, table):
        return
    writer.save(table) if _is_path(table) else writer.saveAsTable(table)
    # Files hold nullable columns only, whatever the frame says.
    fields = [*[f for f in placed.schema.fields if f.name != BUCKET], placed.schema[BUCKET]]
    schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in fields])
    _write_layout(spark, table, key, buckets, schema)


def _exists(spark: SparkSession, table: str) -> bool:
    if not _is_path(table):
        return spark.catalog.tableExists(table)
    fs, make = file_system(spark, table)
    return fs.exists(make(table))


@contextmanager
def _dynamic_partitions(spark: SparkSession) -> Iterator[None]:
    """Inserts into a catalog table obey the session settings only, not the writer's options."""
    wanted = {
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "hive.exec.dynamic.partition.mode": "nonstrict",
    }
    before = {k: spark.conf.get(k, None) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rewrite_partitions(df: DataFrame, table: str, partition_columns: Sequence[str]) -> None:
    """Replace the partitions present in ``df``; all others stay as they are.

    Columns are matched by name and keep their types. ``df`` must not read from
    the table itself: write it to a staging folder first, as
    :func:`apply_to_table` does.
    """
    spread = _spread(df, list(partition_columns))
    if _is_path(table):
        writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(*partition_columns).parquet(table)
        return
    spark = df.sparkSession
    in_table_order = spread.select(*spark.table(table).columns)
    with _dynamic_partitions(spark):
        in_table_order.write.mode("overwrite").insertInto(table)


def touched_buckets(requests: DataFrame, key: str, buckets: int) -> list[int]:
    """Bucket numbers the requests fall into: at most ``buckets`` integers reach the driver."""
    keys = request_keys(requests, key)
    rows = keys.select(bucket_of(F.col("_request"), buckets).alias(BUCKET)).distinct().collect()
    return sorted(r[BUCKET] for r in rows)


def stage_erasure(
    spark: SparkSession, table: str, requests: DataFrame, key: str, buckets: int | None = None,
    masks: Mapping | None = None, delete: bool = False, staging: str | None = None, kind: str = "mask",
    order: Sequence | None = None,
) -> tuple[str | None, list[int]]:
    """Write the new contents of all touched partitions to a staging folder.

    The table itself is not changed. Only touched partitions are read, and every
    row of them is tested to lie in the bucket of its key: a table laid out
    otherwise fails here rather than keep requested rows unseen. ``buckets`` is
    only compared with the count noted with the table. A staging folder given by
    the caller is overwritten. ``kind`` says what the requests ask for
    (:func:`veil.operators.erase.answer`); ``delete`` is short for the kind "delete".
    """
    kind = "delete" if delete else kind
    buckets = _bucket_count(spark, table, key, buckets)
    touched = touched_buckets(requests, key, buckets)
    if not touched:
        return None, []
    current = read_table(spark, table, **{BUCKET: touched})
    rest = [c for c in current.columns if c not in (key, BUCKET)] if order is None else order
    changed = answer(current, requests, key, kind, masks, rest)
    return _stage(spark, table, changed, key, buckets, staging), touched


def _stage(spark: SparkSession, table: str, changed: DataFrame, key: str, buckets: int, staging: str | None) -> str:
    """Write new contents of buckets to a staging folder, with a look at the bucket of every row."""
    # Rows for unknown keys come without a bucket.
    changed = changed.withColumn(BUCKET, F.coalesce(F.col(BUCKET), bucket_of(F.col(key), buckets)))
    misplaced = F.raise_error(F.lit(f"a row of {table} is not in the bucket of its key")).cast("int")
    right = F.col(BUCKET) == bucket_of(F.col(key), buckets)
    changed = changed.withColumn(BUCKET, F.when(right, F.col(BUCKET)).otherwise(misplaced))
    staging = staging or work_dir(spark, "staging")
    try:
        _spread(changed, [BUCKET]).write.mode("overwrite").partitionBy(BUCKET).parquet(staging)
    except Exception:
        remove_folder(spark, staging)
        raise
    return staging


def publish_erasure(
    spark: SparkSession, table: str, staging: str | None, touched: Sequence[int], delete: bool = False
) -> None:
    """Move a staged result into the table.

    The staging folder stays complete until the end, so an interrupted publish
    is repeated from it and never from a half-written table; the caller removes
    it afterwards. A partition that lost all its rows has nothing to replace it
    and is dropped. If the touched partitions hold no rows at all, nothing happens.
    """
    if staging is None:
        return
    staged = spark.read.schema(read_table(spark, table).schema).parquet(staging)
    kept = {r[BUCKET] for r in staged.select(BUCKET).distinct().collect()}
    if kept:
        rewrite_partitions(staged, table, [BUCKET])
    if delete:
        drop_buckets(spark, table, [b for b in touched if b not in kept])


def drop_buckets(spark: SparkSession, table: str, buckets: Sequence[int]) -> None:
    """Drop whole partitions of a bucketed table."""
    if not buckets:
        return
    if not _is_path(table):
        parts = ", ".join(f"PARTITION ({BUCKET} = {int(b)})" for b in buckets)
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {parts}")
        return
    for b in buckets:
        remove_folder(spark, f"{table.rstrip('/')}/{BUCKET}={int(b)}")


def apply_to_table(
    spark: SparkSession, table: str, requests: DataFrame, key: str, buckets: int | None = None,
    masks: Mapping | None = None, delete: bool = False, kind: str = "mask", order: Sequence | None = None,
) -> list[int]:
    """Answer the requests of one kind in a bucketed table; returns the rewritten bucket numbers.

    The staging copy is removed at the end. If publishing fails it is the only
    whole copy of the touched partitions; the error then names it, and
    :func:`publish_erasure` can be repeated from it.
    """
    kind = "delete" if delete else kind
    staging, touched = stage_erasure(spark, table, requests, key, buckets, masks, kind=kind, order=order)
    try:
        publish_erasure(spark, table, staging, touched, kind == "delete")
    except Exception as error:
        error.add_note(f"the staged partitions are kept in {staging}")
        raise
    remove_folder(spark, staging)
    return touched


# --- cell tables ------------------------------------------------------------

def create_cells(cells: DataFrame, path: str, n_ranges: int, keys: Sequence[str] = ("rowkey",)) -> None:
    """Lay out a cell table by key range, unless it exists.

    Files hold disjoint, sorted key ranges, so key predicates skip most of
    them. Ranges may also cut inside a key that has very many cells.
    """
    if n_ranges < MIN_RANGES:
        raise ValueError(f"a new table needs more than {MIN_RANGES - 1} key ranges")
    order = [*keys, CF, QUALIFIER, TS]
    (
        cells.repartitionByRange(n_ranges, *order)
        .sortWithinPartitions(*order)
        .write.mode("ignore")
        .parquet(path)
    )


def append_cells(cells: DataFrame, path: str) -> None:
    """Add cells to a table; the newest version wins when it is read."""
    cells.write.mode("append").parquet(path)


def read_cells(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _pairs(columns: Sequence[tuple[str, str]]) -> Column:
    return any_of([(F.col(CF) == cf) & (F.col(QUALIFIER) == q) for cf, q in columns])


def stage_purge(
    spark: SparkSession, path: str, requests: DataFrame, key: str, columns: Sequence[tuple[str, str]] | None,
    staging: str, most: int | None = None,
) -> list[str]:
    """Write what is left of the files that hold requested cells; returns these files' names.

    ``columns`` are the (family, qualifier) pairs to purge, ``None`` all cells of
    the requested keys. Names of files reach the driver, never keys or values;
    with ``most`` not more than so many, the first by name.
    """
    cells = read_cells(spark, path)
    named = cells.withColumn("_file", F.col("_metadata.file_path"))
    wanted = request_keys(requests, key)
    found = named.select(key, CF, QUALIFIER, "_file")
    if columns is not None:
        found = found.filter(_pairs(columns))
    hit = found.join(wanted, F.col(key).cast("string") == F.col("_request"), "left_semi")
    named_files = hit.select("_file").distinct()
    if most is not None:
        named_files = named_files.orderBy("_file").limit(most)
    files = sorted(r["_file"] for r in named_files.collect())
    if files:
        held = spark.read.schema(cells.schema).parquet(*files)
        left = purge(held, requests, key, columns) if columns is not None else erase(held, requests, key)
        order = [key, CF, QUALIFIER, TS]
        left.repartitionByRange(len(files), *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(staging)
    return files


def publish_purge(spark: SparkSession, path: str, staging: str, files: Sequence[str]) -> None:
    """Move the staged files into the cell table, then delete the files they replace; may be repeated.

    In between a reader sees kept cells twice, with equal timestamps and values,
    which counts once in every view.
    """
    if not files:
        return
    fs, make = file_system(spark, path)
    if fs.exists(make(staging)):
        for status in fs.listStatus(make(staging)):
            name = status.getPath().getName()
            if name.endswith(".parquet") and not fs.rename(status.getPath(), make(make(path), name)):
                raise OSError(f"{name} could not be moved into {path}")
    for file in files:
        fs.delete(make(spark.sparkContext._jvm.java.net.URI(file)), False)
    remove_folder(spark, staging)


def purge_cells(
    spark: SparkSession, path: str, requests: DataFrame, key: str,
    columns: Sequence[tuple[str, str]] | None = None,
) -> int:
    """Delete requested cells, all versions of them, from a stored cell table; returns the number of rewritten files.

    Only files that hold such cells are read whole and rewritten, ``FILES_AT_ONCE`` at a time. What has been rewritten
    holds none any more, so a purge that was interrupted is simply repeated.
    """
    done = 0
    while True:
        staging = work_dir(spark, "purge")
        files = stage_purge(spark, path, requests, key, columns, staging, FILES_AT_ONCE)
        publish_purge(spark, path, staging, files)
        done += len(files)
        if len(files) < FILES_AT_ONCE:
            return done


# --- snapshots --------------------------------------------------------------

#: Rows of one file of a snapshot: files with line breaks inside values are read whole by one task each.
SNAPSHOT_FILE_ROWS = 1_000_000
# What writer and reader must agree on, so that every text comes back as it was.
_CSV = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "lineSep": "\n"}


def export_csv(df: DataFrame, path: str, header: bool = False) -> None:
    """CSV snapshot, replacing an older one. An export keeps what it was given: take it after erasure."""
    writer = df.write.mode("overwrite").options(**_CSV).option("header", header)
    writer.option("maxRecordsPerFile", SNAPSHOT_FILE_ROWS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType, header: bool = False) -> DataFrame:
    """A snapshot of :func:`export_csv`: line breaks, quotes and blanks inside values are as they were."""
    return spark.read.schema(schema).options(**_CSV).option("multiLine", True).option("header", header).csv(path)


def column_list(df: DataFrame) -> list[tuple[str, str]]:
    """Names and types of the columns of a loaded table."""
    return [(f.name, f.dataType.simpleString()) for f in df.schema.fields]


def describe_columns(df: DataFrame) -> DataFrame:
    """The same as a frame, with the number of non-null values of every column (one scan)."""
    filled = df.agg(*[F.count(f"`{f.name}`").alias(f.name) for f in df.schema.fields])
    return filled.select(F.inline(F.array(*[
        F.struct(
            F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f"`{f.name}`").alias("filled"),
        )
        for f in df.schema.fields
    ])))

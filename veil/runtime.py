"""Session settings, shared work folders and measured broadcasts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def build_session(app_name: str = "veil", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Nothing here is required for right results; adaptive execution gives
    runtime coalescing, skew-join splitting and rebalanced writes.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    if master and master.startswith("local"):
        settings["spark.ui.enabled"] = "false"
    settings.update({k.replace("__", "."): str(v) for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_base(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may do without it: it uses a folder below the
    warehouse, on the session's own file system.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/veil-work"


def work_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing folder path below the shared work folder."""
    return f"{work_base(spark)}/{label}-{uuid.uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """The file system of a path, and the maker of its paths."""
    jvm = spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs, jvm.org.apache.hadoop.fs.Path


def remove_folder(spark: SparkSession, path: str | None) -> None:
    """Delete a folder and what is in it, if it is there."""
    if path is not None:
        fs, make = file_system(spark, path)
        fs.delete(make(path), True)


def _octets(field: T.StructField):
    column = F.col(f"`{field.name}`")
    kind = field.dataType
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + F.lit(16)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) * F.lit(2) + F.lit(64)
    return F.lit(16)


def fits_broadcast(df: DataFrame) -> bool:
    """Measure ``df`` (one aggregate job) against the broadcast bounds.

    The bounds are ``veil.broadcast.maxRows`` and ``veil.broadcast.maxBytes``
    when set in the session.
    """
    spark = df.sparkSession
    max_rows = int(spark.conf.get("veil.broadcast.maxRows", str(BROADCAST_MAX_ROWS)))
    max_bytes = int(spark.conf.get("veil.broadcast.maxBytes", str(BROADCAST_MAX_BYTES)))
    width = F.lit(0)
    for field in df.schema.fields:
        width = width + _octets(field)
    rows, octets = df.agg(
        F.count(F.lit(1)), F.coalesce(F.sum(width.cast("bigint")), F.lit(0).cast("bigint"))
    ).first()
    return rows <= max_rows and octets <= max_bytes


def measured(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows it.

    Beyond the bound the frame is returned without a hint: the join is then a
    shuffle join, with skewed partitions split at run time.
    """
    return F.broadcast(df) if fits_broadcast(df) else df

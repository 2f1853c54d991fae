"""A request log: erasure that holds for readers at once, while files are rewritten later.

The log is a table of its own, a folder per batch with (key, kind). A view of the client table joins
the requests that haven't been worked into its files yet, so no requested value is seen
from the moment a batch is in the log. Compaction works many batches into the files together: each
touched bucket is rewritten once for all of them.

Answers may be repeated: a row that is masked, deleted or added once comes out the same if it
meets its request again. So a view is right before, during and after a compaction.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from veil.operators.erase import KINDS, MASKS, check_kind, request_keys
from veil.runtime import file_system, fits_broadcast, remove_folder, work_dir
from veil.sources.commits import CommitLog
from veil.sources.tables import BUCKET, _bucket_count, _stage, bucket_of, publish_erasure, read_table

LOG = T.StructType([T.StructField("key", T.StringType()), T.StructField("kind", T.StringType()), T.StructField("batch", T.LongType())])


def _state(spark: SparkSession, log: str) -> CommitLog:
    return CommitLog(spark, f"{log.rstrip('/')}/_state")


def log_batch(spark: SparkSession, requests: DataFrame, batch: int, log: str, key: str, kind: str = "mask") -> None:
    """Put the distinct keys of one batch into the log; a batch that is repeated replaces itself, or is skipped if it has been compacted."""
    check_kind(kind)
    if batch <= _state(spark, log).last()[1].get("through", -1):
        return
    keys = request_keys(requests, key).select(F.col("_request").alias("key"), F.lit(kind).alias("kind"))
    keys.write.mode("overwrite").parquet(f"{log.rstrip('/')}/batch={batch}")


def read_log(spark: SparkSession, log: str, pending: bool = True) -> DataFrame:
    """(key, kind, batch) of the log; with ``pending`` only what isn't in the files yet."""
    fs, path = file_system(spark, log)
    if not fs.exists(path(log)):
        return spark.createDataFrame([], LOG)
    entries = spark.read.schema(LOG).parquet(log)
    return entries.filter(F.col("batch") > _state(spark, log).last()[1].get("through", -1)) if pending else entries


def _kinds(**option) -> list[str]:
    return [k for k, v in KINDS.items() if v and option.items() <= v.items()]


def folded(entries: DataFrame) -> DataFrame:
    """One row per key for all its requests, in order of their batches.

    ``gone``: rows there were are deleted. ``one``: one of its rows is left. ``added``: a key without a row gets
    one, asked for after any deletion.
    """
    gone_at = F.max(F.when(F.col("kind") == "delete", F.col("batch")))
    added_at = F.max(F.when(F.col("kind").isin(_kinds(upsert_unmatched=True)), F.col("batch")))
    return entries.groupBy(F.col("key").alias("_request")).agg(
        gone_at.isNotNull().alias("_gone"), F.bool_or(F.col("kind").isin(_kinds(one_row_per_key=True))).alias("_one"),
        F.coalesce(added_at > F.coalesce(gone_at, F.lit(-1)), F.lit(False)).alias("_added"),
    )


def answered(
    target: DataFrame, entries: DataFrame, key: str, masks: Mapping[str, object] | None = None, order: Sequence | None = None,
) -> DataFrame:
    """The target after all requests of a log, in one join with the requests.

    The requests are broadcast if their measured size allows; otherwise the join is a shuffle
    join whose skewed partitions are split.
    """
    masks = dict(MASKS if masks is None else masks)
    asked = folded(entries)
    small = fits_broadcast(asked)
    n, any_one, any_added = asked.agg(F.count(F.lit(1)), F.bool_or("_one"), F.bool_or("_added")).first()
    if not n:
        return target
    side = F.broadcast(asked) if small else asked
    same = F.col(key).cast("string") == F.col("_request")
    found = target.join(side, same, "left").filter(~F.coalesce(F.col("_gone"), F.lit(False)))
    hit = F.col("_request").isNotNull()

    def value(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        return F.when(hit, F.lit(masks[field.name]).cast(field.dataType)).otherwise(column).alias(field.name) if field.name in masks else column

    if any_one:
        rest = [c for c in target.columns if c != key] if order is None else list(order)
        rank = F.row_number().over(Window.partitionBy(key).orderBy(*rest))
        single = F.coalesce(F.col("_one"), F.lit(False))
        first = found.filter(single).withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")
        found = found.filter(~single).unionByName(first)
    out = found.select(*[value(f) for f in target.schema.fields])
    if any_added:
        # Requested keys meet their rows in an aggregation, where repeated keys merge before the shuffle.
        kept = target.select(key).join(side, same).filter(~F.col("_gone"))
        there = kept.select("_request", F.lit(True).alias("_there")).unionByName(asked.filter("_added").select("_request", F.lit(False).alias("_there")))
        wanted = asked.filter("_added").select(F.col("_request").alias("_asked"))
        new = there.groupBy("_request").agg(F.bool_or("_there").alias("_there")).filter(~F.col("_there"))
        new = new.join(F.broadcast(wanted) if small else wanted, F.col("_request") == F.col("_asked"), "left_semi")
        out = out.unionByName(new.select(*[
            (F.col("_request").cast(f.dataType) if f.name == key else F.lit(masks.get(f.name)).cast(f.dataType)).alias(f.name)
            for f in target.schema.fields
        ]))
    return out


def logged_view(
    spark: SparkSession, table: str, log: str, key: str, masks: Mapping[str, object] | None = None, order: Sequence | None = None,
) -> DataFrame:
    """A table as its readers shall see it: with every request of the log answered."""
    current = read_table(spark, table)
    rest = [c for c in current.columns if c not in (key, BUCKET)] if order is None else order
    return answered(current, read_log(spark, log), key, masks, rest)


def _publish(spark: SparkSession, table: str, log: str, number: int, entry: Mapping) -> None:
    publish_erasure(spark, table, entry["staging"], entry["touched"], delete=True)
    _state(spark, log).put(number, {"through": entry["to"]})
    remove_folder(spark, entry["staging"])


def compact_log(
    spark: SparkSession, table: str, log: str, key: str, masks: Mapping[str, object] | None = None, order: Sequence | None = None,
) -> list[int]:
    """Work all pending batches into the files of a bucketed table; returns the rewritten buckets.

    New contents are staged and noted before they are published, so an interrupted compaction is
    finished from its staged copy by the next one. Batches in the files leave the log, and their keys with them.
    """
    state = _state(spark, log)
    number, entry = state.last()
    if entry.get("staging"):
        _publish(spark, table, log, number, entry)
        number, entry = state.last()
    through = entry.get("through", -1)
    entries = read_log(spark, log)
    to = entries.agg(F.max("batch")).first()[0]
    touched: list[int] = []
    if to is not None:
        buckets = _bucket_count(spark, table, key, None)
        asked = entries.filter(F.col("batch") <= to)
        touched = sorted(r[0] for r in asked.select(bucket_of(F.col("key"), buckets)).distinct().collect())
        current = read_table(spark, table, **{BUCKET: touched})
        rest = [c for c in current.columns if c not in (key, BUCKET)] if order is None else order
        staging = _stage(spark, table, answered(current, asked, key, masks, rest), key, buckets, work_dir(spark, "staging"))
        entry = {"through": through, "to": to, "staging": staging, "touched": touched}
        _publish(spark, table, log, state.put(number, entry), entry)
    _forget(spark, log)
    state.trim()
    return touched


def _forget(spark: SparkSession, log: str) -> None:
    """Remove the batches that are in the files."""
    fs, path = file_system(spark, log)
    through = _state(spark, log).last()[1].get("through", -1)
    for status in fs.listStatus(path(log)) if fs.exists(path(log)) else ():
        name = status.getPath().getName()
        if name.startswith("batch=") and int(name.removeprefix("batch=")) <= through:
            fs.delete(status.getPath(), True)

"""The life of a request: seen first, applied or without a row, and repeated, across all batches of a stream.

A stateful operator keyed by the request remembers every key. Only requests that are new reach the table, so
one that comes again, in the same batch or years later, rewrites nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from veil.functions.requests import request_key
from veil.operators.erase import check_kind, unmatched
from veil.sources.tables import BUCKET, _bucket_count, read_table, touched_buckets
from veil.streaming.erasure import BATCH_INTERVAL, answer_batch, request_stream, states

STORE = "spark.sql.streaming.stateStore.providerClass"
# Fixed value: the state store that state variables need.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Groups that the blank lines of a batch are dealt to, so that no task has them all.
BLANK_GROUPS = 64

#: A request of one batch: how often its key came in it, and how often before.
TRACKED = "key string, lines bigint, before bigint"

LIFE = T.StructType([T.StructField(c, T.LongType()) for c in ("batch", "lines", "blank", "new", "repeated", "applied", "unmatched")])


class _Seen(StatefulProcessor):
    """Counts the lines of a key; with a time to live a key that stays away is forgotten."""

    def __init__(self, forget_after_ms: int | None):
        self.forget_after_ms = forget_after_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "times bigint", self.forget_after_ms)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        lines = sum(1 for _ in rows)
        before = (self.seen.get() or (0,))[0]
        self.seen.update((before + lines,))
        yield Row(key=key[0], lines=lines, before=before)

    def close(self) -> None:
        pass


def track(lines: DataFrame, forget_after_ms: int | None = None) -> DataFrame:
    """``TRACKED`` of a stream of request lines. Blank lines come as a few rows with a null key and are not remembered."""
    # Keys are trimmed, so none of them is a blank and a number.
    blank = F.concat(F.lit(" "), F.floor(F.rand(0) * BLANK_GROUPS).cast("string"))
    keyed = lines.select(F.coalesce(request_key(F.col("value")), blank).alias("key"))
    tracked = keyed.groupBy("key").transformWithState(
        statefulProcessor=_Seen(forget_after_ms), outputStructType=TRACKED, outputMode="Append",
        timeMode="ProcessingTime" if forget_after_ms else "None",
    )
    return tracked.withColumn("key", F.when(~F.col("key").startswith(" "), F.col("key")))


def read_lives(spark: SparkSession, path: str) -> DataFrame:
    """``LIFE`` of all batches: counts only, no keys."""
    return spark.read.schema(LIFE).json(path)


def run_lifecycle_stream(
    spark: SparkSession,
    request_dir: str,
    table: str,
    checkpoint: str,
    key: str,
    masks: Mapping | None = None,
    *,
    kind: str = "mask",
    order: Sequence | None = None,
    forget_after_ms: int | None = None,
    once: bool = False,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start answering new requests in a bucketed table, each key once; ``{checkpoint}/lives`` has each batch's counts.

    ``forget_after_ms`` lets a key that hasn't come for so long count as new again, as data may have
    come in for it meanwhile.
    """
    check_kind(kind)
    ledger, lives = f"{checkpoint}/ledger", f"{checkpoint}/lives"

    def handle(tracked: DataFrame, batch: int) -> None:
        session = tracked.sparkSession
        if "applied" in states(session, ledger, batch) and _known(session, lives, batch):
            return
        tracked = tracked.persist()
        try:
            fresh = F.col("key").isNotNull() & (F.col("before") == 0)
            new = tracked.filter(fresh).select(F.col("key").alias(key))
            n = tracked.agg(
                F.coalesce(F.sum("lines"), F.lit(0)).alias("lines"),
                F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("lines"))), F.lit(0)).alias("blank"),
                F.count_if(fresh).alias("new"),
                F.coalesce(F.sum(F.when(F.col("key").isNotNull(), F.col("lines") - fresh.cast("bigint"))), F.lit(0)).alias("repeated"),
            ).first()
            if not _known(session, lives, batch):
                # Counted before anything is changed, so a batch that is repeated keeps its counts.
                buckets = touched_buckets(new, key, _bucket_count(session, table, key, None))
                missing = unmatched(read_table(session, table, **{BUCKET: buckets}).select(key), new, key).count() if buckets else 0
                life = Row(batch=batch, lines=n["lines"], blank=n["blank"], new=n["new"], repeated=n["repeated"], applied=n["new"] - missing, unmatched=missing)
                session.createDataFrame([life], LIFE).coalesce(1).write.mode("overwrite").json(f"{lives}/batch={batch}")
            answer_batch(session, new, batch, table, key, None, ledger, masks, kind, order, n["lines"], n["blank"])
        finally:
            tracked.unpersist()

    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        writer = track(request_stream(spark, request_dir, files_per_batch), forget_after_ms).writeStream.outputMode("append")
        writer = writer.option("checkpointLocation", f"{checkpoint}/progress").foreachBatch(handle)
        return writer.trigger(**({"availableNow": True} if once else {"processingTime": BATCH_INTERVAL})).start()
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


def _known(spark: SparkSession, lives: str, batch: int) -> bool:
    try:
        return not spark.read.schema(LIFE).json(f"{lives}/batch={batch}").isEmpty()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return False
        raise

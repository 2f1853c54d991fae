"""Streaming erasure: request files come in, every micro-batch is applied once.

Each batch is one set of joins, never a loop over keys. A batch is first
staged, then published; a small ledger, one folder per batch, remembers the
state, so a restarted query repeats an interrupted publish from the staged copy
and skips a batch that was already applied. A batch has one staging folder,
named after it: a repeated batch overwrites it, and it is removed once the
batch is applied.
"""

from __future__ import annotations

import hashlib
import time
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from veil.functions.requests import parse_requests, request_counts
from veil.operators.erase import PERSONAL_FAMILY, mask_entries, newer_than
from veil.runtime import work_base
from veil.sources.request_log import compact_log, log_batch
from veil.sources.tables import (
    append_cells, publish_erasure, publish_purge, read_cells, remove_folder, stage_erasure, stage_purge,
)
from veil.spec import CF, QUALIFIER, TS, VALUE

# Fixed value: the micro-batch interval.
BATCH_INTERVAL = "10 seconds"

LEDGER = T.StructType([
    T.StructField("batch", T.LongType()),
    T.StructField("state", T.StringType()),
    T.StructField("staging", T.StringType()),
    T.StructField("touched", T.ArrayType(T.IntegerType())),
    T.StructField("lines", T.LongType()),
    T.StructField("blank", T.LongType()),
    T.StructField("files", T.ArrayType(T.StringType())),
])


def request_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Lines of the text files in a folder; with a checkpoint every file is read once."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Batches seen so far, with counts and touched partitions, no keys and no values."""
    entries = spark.read.schema(LEDGER).option("pathGlobFilter", "*.json").json(path)
    return entries.select(*LEDGER.names)


def _folder(path: str, batch: int) -> str:
    return f"{path.rstrip('/')}/batch={batch}"


def _staging(spark: SparkSession, ledger: str, batch: int) -> str:
    """The one staging folder of a batch of this ledger."""
    return f"{work_base(spark)}/staging-{hashlib.sha256(ledger.encode()).hexdigest()[:32]}-{batch}"


def _note(spark: SparkSession, path: str, **entry) -> None:
    row = Row(**{f.name: entry.get(f.name) for f in LEDGER.fields})
    spark.createDataFrame([row], LEDGER).coalesce(1).write.mode("append").json(_folder(path, row["batch"]))


def states(spark: SparkSession, path: str, batch: int) -> dict[str, Row]:
    """What the ledger knows of one batch, by state (at most a few rows); no other batch is read."""
    try:
        return {r["state"]: r for r in read_ledger(spark, _folder(path, batch)).collect()}
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise


def apply_batch(
    spark: SparkSession, lines: DataFrame, batch: int, table: str, key: str, buckets: int | None, ledger: str,
    masks: Mapping | None = None, delete: bool = False, kind: str = "mask", order: Sequence | None = None,
) -> None:
    """Answer one batch of request lines in a bucketed table, exactly once."""
    kind = "delete" if delete else kind
    if "applied" in states(spark, ledger, batch):
        remove_folder(spark, _staging(spark, ledger, batch))
        return
    lines = lines.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        total, blank = request_counts(lines).first()
        answer_batch(spark, parse_requests(lines, key), batch, table, key, buckets, ledger, masks, kind, order, total, blank)
    finally:
        lines.unpersist()


def answer_batch(
    spark: SparkSession, requests: DataFrame, batch: int, table: str, key: str, buckets: int | None, ledger: str,
    masks: Mapping | None, kind: str, order: Sequence | None, lines: int, blank: int,
) -> None:
    """Answer the requests of one batch in a bucketed table, exactly once."""
    known = states(spark, ledger, batch)
    staging = _staging(spark, ledger, batch)
    if "applied" in known:
        remove_folder(spark, staging)
        return
    staged = known.get("staged")
    if staged is None:
        used, touched = stage_erasure(spark, table, requests, key, buckets, masks, staging=staging, kind=kind, order=order)
        entry = {"batch": batch, "staging": used, "touched": touched, "lines": lines, "blank": blank}
        _note(spark, ledger, state="staged", **entry)
    else:
        entry = {k: staged[k] for k in ("batch", "staging", "touched", "lines", "blank")}
    publish_erasure(spark, table, entry["staging"], entry["touched"], kind == "delete")
    _note(spark, ledger, state="applied", **entry)
    remove_folder(spark, entry["staging"])


def apply_cell_batch(
    spark: SparkSession, lines: DataFrame, batch: int, cells: str, key: str, ledger: str,
    masks: Mapping | None = None, family: str = PERSONAL_FAMILY, ts: int | None = None, delete: bool = False,
) -> None:
    """Mask or delete the cells of one batch in a cell table, exactly once.

    Masks are staged with their timestamps first, so a repeated batch appends
    the very same cells, and only those that are not there yet. A mask is newer
    than every version of its cell. ``delete`` removes all cells of the
    requested keys from the files that hold them.
    """
    known = states(spark, ledger, batch)
    staging = _staging(spark, ledger, batch)
    if "applied" in known:
        remove_folder(spark, staging)
        return
    staged = known.get("staged")
    if staged is None:
        lines = lines.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            total, blank = request_counts(lines).first()
            requests, files = parse_requests(lines, key), None
            if delete:
                files = stage_purge(spark, cells, requests, key, None, staging)
            else:
                stored = read_cells(spark, cells)
                clock = int(time.time() * 1000) if ts is None else ts
                new = mask_entries(
                    requests, key, clock, masks, family=family,
                    key_type=stored.schema[key].dataType, value_type=stored.schema[VALUE].dataType,
                )
                newer_than(new, stored, requests, key).write.mode("overwrite").parquet(staging)
        finally:
            lines.unpersist()
        entry = {"batch": batch, "staging": staging, "lines": total, "blank": blank, "files": files}
        _note(spark, ledger, state="staged", **entry)
    else:
        entry = {k: staged[k] for k in ("batch", "staging", "lines", "blank", "files")}
    if entry["files"] is not None:
        publish_purge(spark, cells, entry["staging"], entry["files"])
    else:
        new = spark.read.parquet(entry["staging"])
        if staged is not None:
            new = new.join(read_cells(spark, cells).select(*new.columns), new.columns, "left_anti")
        append_cells(new.select(key, CF, QUALIFIER, TS, VALUE), cells)
    _note(spark, ledger, state="applied", **entry)
    remove_folder(spark, entry["staging"])


def _start(spark, request_dir, checkpoint, once, files_per_batch, handle) -> StreamingQuery:
    writer = (
        request_stream(spark, request_dir, files_per_batch)
        .writeStream.option("checkpointLocation", f"{checkpoint}/progress")
        .foreachBatch(handle)
    )
    trigger = {"availableNow": True} if once else {"processingTime": BATCH_INTERVAL}
    return writer.trigger(**trigger).start()


def run_stream(
    spark: SparkSession,
    request_dir: str,
    table: str,
    checkpoint: str,
    key: str,
    buckets: int | None = None,
    masks: Mapping | None = None,
    *,
    delete: bool = False,
    kind: str = "mask",
    order: Sequence | None = None,
    once: bool = False,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start erasing from a folder of request files, in a bucketed table.

    ``kind`` says what all its requests ask for, ``delete`` is short for "delete".

    ``once`` handles what is there and stops; otherwise a batch starts every
    ten seconds. The checkpoint folder holds the stream's progress and the
    ledger, and must be shared and durable.
    """
    def handle(lines: DataFrame, batch: int) -> None:
        apply_batch(
            lines.sparkSession, lines, batch, table, key, buckets, f"{checkpoint}/ledger", masks, delete, kind, order
        )

    return _start(spark, request_dir, checkpoint, once, files_per_batch, handle)


def run_log_stream(
    spark: SparkSession,
    request_dir: str,
    table: str,
    log: str,
    checkpoint: str,
    key: str,
    masks: Mapping | None = None,
    *,
    kind: str = "mask",
    order: Sequence | None = None,
    compact_every: int | None = None,
    once: bool = False,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Start writing requests to a request log, which holds for readers of :func:`logged_view` at once.

    With ``compact_every`` the table's files are rewritten after every so many batches,
    for all of them together.
    """
    def handle(lines: DataFrame, batch: int) -> None:
        session = lines.sparkSession
        log_batch(session, parse_requests(lines, key), batch, log, key, kind)
        if compact_every and (batch + 1) % compact_every == 0:
            compact_log(session, table, log, key, masks, order)

    return _start(spark, request_dir, checkpoint, once, files_per_batch, handle)


def run_cell_stream(
    spark: SparkSession,
    request_dir: str,
    cells: str,
    checkpoint: str,
    key: str,
    masks: Mapping | None = None,
    *,
    family: str = PERSONAL_FAMILY,
    delete: bool = False,
    once: bool = False,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """The same for a cell table: newer mask cells are appended, nothing is rewritten.

    Older versions stay readable until the table is purged. With ``delete`` all
    cells of the requested keys go, and the files that held them are rewritten.
    """
    def handle(lines: DataFrame, batch: int) -> None:
        apply_cell_batch(
            lines.sparkSession, lines, batch, cells, key, f"{checkpoint}/ledger", masks, family, delete=delete
        )

    return _start(spark, request_dir, checkpoint, once, files_per_batch, handle)

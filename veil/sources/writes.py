"""Cell tables with numbered writes: the last write wins among equal timestamps, and appends can be merged.

Every append is a folder of its own under its write number, and a commit log says which folders
count. Readers see a write whole or not at all, and never both a folder and the one it was merged
into. The number comes with every cell as the column ``write``: as ``tie`` it decides which of two
rows of the same cell and timestamp counts, whatever their values are.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from veil.operators.cells import compact
from veil.operators.erase import erase, purge, request_keys
from veil.runtime import file_system, measured, remove_folder
from veil.sources.commits import CommitLog
from veil.sources.tables import _pairs
from veil.spec import CF, QUALIFIER, TS

WRITE = "write"
_TRY = "try"


def _log(spark: SparkSession, path: str) -> CommitLog:
    return CommitLog(spark, f"{path.rstrip('/')}/_commits")


def _folder(number: int) -> str:
    """A new folder for a write; what a failed one leaves behind is never read."""
    return f"{WRITE}={number}/{_TRY}={uuid.uuid4().hex}"


def append_write(cells: DataFrame, path: str, token: str | None = None) -> int:
    """Add cells as the next write; returns its number. A ``token`` that the last append had isn't added again."""
    spark = cells.sparkSession
    log = _log(spark, path)
    at, entry = log.last()
    if token is not None and entry.get("token") == token:
        return entry["next"] - 1
    number, folder = entry.get("next", 1), None
    folder = _folder(number)
    schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in cells.schema.fields])
    cells.write.parquet(f"{path.rstrip('/')}/{folder}")
    log.put(at, {"live": [*entry.get("live", []), folder], "next": number + 1, "token": token, "schema": entry.get("schema", schema.jsonValue())})
    return number


def read_writes(spark: SparkSession, path: str) -> DataFrame:
    """The cells of all writes that count, with their write number."""
    _, entry = _log(spark, path).last()
    if not entry:
        raise ValueError(f"{path} has no writes")
    return _read(spark, path, entry["live"], entry)


def _read(spark: SparkSession, path: str, folders: Sequence[str], entry: dict, named: bool = False) -> DataFrame:
    """The cells of some folders; ``named`` adds each one's folder."""
    schema = T.StructType.fromJson(entry["schema"]).add(WRITE, T.LongType())
    if not folders:
        return spark.createDataFrame([], schema)
    root = path.rstrip("/")
    whole = T.StructType([*schema.fields, T.StructField(_TRY, T.StringType())])
    cells = spark.read.schema(whole).option("basePath", root).parquet(*[f"{root}/{f}" for f in folders])
    return cells.withColumn(_TRY, F.concat(F.lit(f"{WRITE}="), WRITE, F.lit(f"/{_TRY}="), _TRY)) if named else cells.drop(_TRY)


def compact_writes(
    spark: SparkSession, path: str, keys: Sequence[str], n_ranges: int, last: int | None = None, versions: int | None = None,
) -> int | None:
    """Merge the ``last`` newest writes (all, if not given) into one, laid out by key range; returns its number.

    One row per cell and timestamp stays, that of the last write. Files hold disjoint, sorted key ranges,
    so a key lookup skips most of them. The merge counts from one commit on; if it is
    interrupted before, nothing has changed, and it may simply be repeated. Merging few
    writes often and all of them rarely keeps the cost of a table's growth low. ``versions`` keeps only the newest ones of a cell, and
    needs all writes.
    """
    if versions is not None and last is not None:
        raise ValueError("older versions can only be counted over all writes")
    log = _log(spark, path)
    at, entry = log.last()
    live = entry.get("live", [])
    merged = live if last is None else live[max(0, len(live) - last):]
    if not merged or (len(merged) < 2 and versions is None):
        return None
    number = entry["next"]
    folder = _folder(number)
    order = [*keys, CF, QUALIFIER, TS]
    one = compact(_read(spark, path, merged, entry), keys, (WRITE,), versions).drop(WRITE)
    one.repartitionByRange(n_ranges, *order).sortWithinPartitions(*order).write.parquet(f"{path.rstrip('/')}/{folder}")
    log.put(at, {**entry, "live": [*live[:len(live) - len(merged)], folder], "next": number + 1})
    return number


def purge_writes(
    spark: SparkSession, path: str, requests: DataFrame, key: str, columns: Sequence[tuple[str, str]] | None = None,
) -> int:
    """Delete requested cells from all writes and from disk; returns the number of rewritten folders.

    Only folders that hold such cells are rewritten, under their own numbers, and they change all at once.
    """
    log = _log(spark, path)
    at, entry = log.last()
    if not entry.get("live"):
        return 0
    found = _read(spark, path, entry["live"], entry, named=True).select(key, CF, QUALIFIER, _TRY)
    if columns is not None:
        found = found.filter(_pairs(columns))
    wanted = measured(request_keys(requests, key))
    hit = found.join(wanted, F.col(key).cast("string") == F.col("_request"), "left_semi")
    names = {r[0] for r in hit.select(_TRY).distinct().collect()}
    live = []
    for folder in entry["live"]:
        if folder not in names:
            live.append(folder)
            continue
        held = _read(spark, path, [folder], entry)
        left = erase(held, requests, key) if columns is None else purge(held, requests, key, columns)
        live.append(_folder(int(folder.split("/")[0].split("=")[1])))
        order = [key, CF, QUALIFIER, TS]
        left.drop(WRITE).sortWithinPartitions(*order).write.parquet(f"{path.rstrip('/')}/{live[-1]}")
    if names:
        log.put(at, {**entry, "live": live})
        log.trim(1)
    vacuum(spark, path)
    return len(names)


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove folders that don't count any more (merged, purged or never committed); returns how many.

    For times without a running append, merge or reader of an older state.
    """
    fs, make = file_system(spark, path)
    live = set(_log(spark, path).last()[1].get("live", []))
    root, gone = path.rstrip("/"), 0
    for write in fs.listStatus(make(root)):
        name = write.getPath().getName()
        if not name.startswith(f"{WRITE}="):
            continue
        tries = [f"{name}/{s.getPath().getName()}" for s in fs.listStatus(write.getPath())]
        for folder in tries:
            if folder not in live:
                remove_folder(spark, f"{root}/{folder}")
                gone += 1
        if not any(f in live for f in tries):
            remove_folder(spark, f"{root}/{name}")
    _log(spark, path).trim(1)
    return gone

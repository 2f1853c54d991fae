"""Numbered writes, merging, and bounded maps of cell tables."""

import json
import random
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from veil.operators import cells as C
from veil.sources import writes as W
from veil.sources.commits import CommitLog

SCHEMA = "k string, cf string, qualifier string, ts bigint, value string"
SPEC = {"key": [("k", "string")], "columns": {"a": {"cf": "f", "col": "a", "type": "string"}}}


def cells(spark, *entries):
    return spark.createDataFrame([(k, "f", "a", ts, v) for k, ts, v in entries], SCHEMA)


def folders(path):
    return {str(p.parent.relative_to(path)) for p in Path(path).rglob("*.parquet")}


def test_the_last_write_wins(spark, tmp_path):
    path = str(tmp_path / "t")
    assert W.append_write(cells(spark, ("x", 1, "z"), ("y", 1, "old")), path, token="b0") == 1
    assert W.append_write(cells(spark, ("x", 1, "a")), path, token="b1") == 2
    assert W.append_write(cells(spark, ("x", 1, "a")), path, token="b1") == 2  # the same batch again
    view = lambda: rows(C.to_rows(W.read_writes(spark, path), SPEC, tie=(W.WRITE,)))
    assert view() == [("x", "a"), ("y", "old")]
    assert rows(W.read_writes(spark, path).groupBy(W.WRITE).count()) == [(1, 2), (2, 1)]
    assert W.compact_writes(spark, path, ["k"], 2) == 3
    assert view() == [("x", "a"), ("y", "old")]
    assert rows(W.read_writes(spark, path).drop(W.WRITE)) == [("x", "f", "a", 1, "a"), ("y", "f", "a", 1, "old")]
    assert W.vacuum(spark, path) == 2
    assert view() == [("x", "a"), ("y", "old")]
    with pytest.raises(ValueError):
        W.read_writes(spark, str(tmp_path / "nothing"))


def test_fifty_appends_then_a_lookup_reads_few_files(spark, tmp_path):
    path, rnd = str(tmp_path / "t"), random.Random(2)
    newest = {}
    for n in range(50):
        some = [(f"k{rnd.randrange(400):03}", rnd.randrange(3), f"{rnd.randrange(9)}-{n}") for _ in range(40)]
        some = list({(k, t): (k, t, v) for k, t, v in some}.values())
        newest.update({(k, t): v for k, t, v in some})
        W.append_write(cells(spark, *some).coalesce(1), path)
        if n % 20 == 19:
            W.compact_writes(spark, path, ["k"], 2, last=10)
    seen = lambda df: {(r.k, r.ts): r.value for r in C.compact(df, ["k"], (W.WRITE,)).collect()}
    before = W.read_writes(spark, path)
    assert seen(before) == newest
    W.compact_writes(spark, path, ["k"], 8)
    after = W.read_writes(spark, path)
    assert seen(after) == newest and after.count() == len(newest)

    def may_hold(df, key):
        """Files whose statistics let a scan for one key skip them not."""
        count = 0
        for file in df.inputFiles():
            stats = [pq.ParquetFile(file.removeprefix("file://")).metadata.row_group(0).column(i).statistics for i in (0,)][0]
            count += stats.min <= key <= stats.max
        return count

    assert may_hold(before, "k200") > 10 and may_hold(after, "k200") <= 2


def test_an_interrupted_merge_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    for n in range(3):
        W.append_write(cells(spark, ("x", 1, f"v{n}")), path)
    put = CommitLog.put

    def fail(*args):
        raise OSError("gone")

    monkeypatch.setattr(CommitLog, "put", fail)
    with pytest.raises(OSError):
        W.compact_writes(spark, path, ["k"], 2)
    monkeypatch.setattr(CommitLog, "put", put)
    assert W.read_writes(spark, path).count() == 3
    assert W.vacuum(spark, path) == 1
    W.compact_writes(spark, path, ["k"], 2)
    assert [r.value for r in W.read_writes(spark, path).collect()] == ["v2"]


def test_two_writers_at_once_are_told(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.put(0, {"a": 1}) == 1
    with pytest.raises(RuntimeError):
        log.put(0, {"a": 2})
    assert log.last() == (1, {"a": 1})


def test_versions_are_counted_over_all_writes(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(4):
        W.append_write(cells(spark, ("x", n, f"v{n}"), ("x", 0, f"w{n}")), path)
    W.compact_writes(spark, path, ["k"], 2, versions=2)
    assert rows(W.read_writes(spark, path).select("ts", "value")) == [(2, "v2"), (3, "v3")]
    with pytest.raises(ValueError):
        W.compact_writes(spark, path, ["k"], 2, last=1, versions=2)


def test_purge_leaves_nothing_on_disk(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(3):
        W.append_write(cells(spark, ("x", n, "secret-x") if n != 1 else ("q", 1, "other"), ("y", n, f"y{n}")), path)
    asked = spark.createDataFrame([("x",), ("nobody",)], "k string")
    assert W.purge_writes(spark, path, asked, "k") == 2
    assert rows(W.read_writes(spark, path).select("k", "ts", W.WRITE)) == [("q", 1, 2), ("y", 0, 1), ("y", 1, 2), ("y", 2, 3)]
    for file in Path(path).rglob("*.parquet"):
        assert "secret-x" not in json.dumps(pq.read_table(file).to_pylist())
    assert W.purge_writes(spark, path, asked, "k") == 0
    assert W.purge_writes(spark, path, spark.createDataFrame([("y",)], "k string"), "k", [("f", "b")]) == 0


# --- maps in parts -----------------------------------------------------------

DYNAMIC = {"key": [("k", "string")], "columns": {"d": {"cf": "f", "col": "", "type": "map<string,string>"}}}
HISTORY = {"key": [("k", "string")], "columns": {"d": {"cf": "f", "col": "", "type": "map<string,map<bigint,string>>"}}}
PATTERN = {"key": [("k", "string")], "columns": {"d": {"cf": "f", "regex": "([a-z]).*", "type": "map<string,string>"}}}


def wide(spark, n=5000):
    """A key with very many qualifiers beside narrow ones, two versions each."""
    i = F.col("id")
    return spark.range(2 * n).select(
        F.when(i % 10 < 9, "wide").otherwise(F.concat(F.lit("n"), i % 100)).alias("k"), F.lit("f").alias("cf"),
        F.concat(F.lit("q"), F.floor(i / 2)).alias("qualifier"), (i % 2).alias("ts"), i.cast("string").alias("value"),
    )


@pytest.mark.parametrize("spec, options", [(DYNAMIC, {}), (HISTORY, {"max_versions": 2}), (PATTERN, {})])
def test_parts_add_up(spark, spec, options):
    table = wide(spark)
    parts = C.map_parts(table, spec, "d", entries=100, **options)
    assert parts.agg(F.max(F.size("d"))).first()[0] <= 100
    whole = C.to_rows(table, spec, scope="family", max_versions=2)
    flat = lambda df: rows(df.select("k", F.explode("d").alias("q", "v")).select("k", "q", F.col("v").cast("string")))
    assert flat(parts) == flat(whole)
    assert rows(C.map_entries(table, spec, "d", **options).select("k", "name", F.col("value").cast("string"))) == flat(whole)
    order = parts.filter("k = 'wide'").select(C.MAP_PART, F.array_min(F.map_keys("d")).alias("a"), F.array_max(F.map_keys("d")).alias("b")).orderBy(C.MAP_PART).collect()
    assert all(x.b < y.a for x, y in zip(order, order[1:]))


def test_no_task_collects_a_wide_key(spark):
    """No sort, window or list over a whole key: the only grouping is by part."""
    text = C.map_parts(wide(spark), DYNAMIC, "d", entries=100)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert "Window" not in text
    assert "rangepartitioning(k" in text


def test_parts_can_be_written(spark):
    table = wide(spark, 500)
    again = C.to_cells(C.map_parts(table, HISTORY, "d", entries=50, max_versions=2), HISTORY, ts=0)
    assert rows(again.select(*table.columns)) == rows(table)

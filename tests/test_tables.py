"""Tables on disk and the streaming job."""

import os
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from veil.operators import cells as C
from veil.operators.erase import MASKS, mask
from veil.runtime import fits_broadcast, measured, work_base, work_dir
from veil.sources import tables as S
from veil.streaming import erasure as E

N = 8


@pytest.fixture
def clients(spark):
    return spark.range(200).select(
        F.col("id").cast("string").alias("bp"), F.concat(F.lit("i"), F.col("id")).alias("iban"),
        F.concat(F.lit("s"), F.col("id")).alias("street"), F.col("id").cast("int").alias("age"),
    )


@pytest.fixture
def table(spark, clients, tmp_path):
    path = str(tmp_path / "clients")
    S.write_bucketed(clients, path, "bp", N)
    return path


def files(path):
    return {p.relative_to(path): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def asked(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "bp string")


def plain(spark, path):
    return spark.read.parquet(path).drop(S.BUCKET)


def test_only_touched_partitions_are_rewritten(spark, clients, table):
    before = files(table)
    touched = S.apply_to_table(spark, table, asked(spark, "3", "17", "unknown"), "bp", N)
    after = files(table)
    same = {p for p in before if after.get(p) == before[p]}
    assert {int(p.parts[0].split("=")[1]) for p in before if p not in same} == set(touched)
    assert 0 < len(touched) <= 3 and same
    assert rows(plain(spark, table)) == rows(mask(clients, asked(spark, "3", "17"), "bp"))
    assert plain(spark, table).schema.simpleString() == clients.schema.simpleString()


def test_delete_can_empty_a_partition(spark, clients, table):
    bucket = spark.read.parquet(table).filter(f"{S.BUCKET} = 2").select("bp")
    gone = {r["bp"] for r in bucket.collect()}
    assert S.apply_to_table(spark, table, asked(spark, *gone), "bp", N, delete=True) == [2]
    assert rows(plain(spark, table)) == rows(clients.filter(~F.col("bp").isin(list(gone))))


def test_no_requests_change_nothing(spark, table):
    before = files(table)
    assert S.apply_to_table(spark, table, asked(spark, "", " "), "bp", N) == []
    assert files(table) == before


def test_catalog_table_by_name(spark, clients, tmp_path):
    spark.sql("DROP TABLE IF EXISTS people")
    S.write_bucketed(clients, "people", "bp", N)
    try:
        S.apply_to_table(spark, "people", asked(spark, "3", "17"), "bp", N)
        want = mask(clients, asked(spark, "3", "17"), "bp")
        assert rows(spark.table("people").drop(S.BUCKET)) == rows(want)
        gone = [r["bp"] for r in spark.table("people").filter(f"{S.BUCKET} = 2").collect()]
        S.apply_to_table(spark, "people", asked(spark, "4", *gone), "bp", N, delete=True)
        assert rows(spark.table("people").drop(S.BUCKET)) == rows(want.filter(~F.col("bp").isin(["4", *gone])))
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"
        (tmp_path / "in").mkdir()
        drop_file(tmp_path / "in", "a.csv", "9,x\n")
        run(spark, tmp_path, "people")
        assert S.read_table(spark, "people").filter("bp = '9'").first()["iban"] == MASKS["iban"]
    finally:
        spark.sql("DROP TABLE people")


def test_rewrite_partitions_matches_by_name(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "p string, n int, s string")
    df.write.partitionBy("p").parquet(path)
    S.rewrite_partitions(df.filter("p = 'a'").select("s", "p", (F.col("n") + 10).alias("n")), path, ["p"])
    assert rows(spark.read.parquet(path).select("p", "n", "s")) == [("a", 11, "x"), ("b", 2, "y")]


def test_partition_scan_is_pruned(spark, table):
    df = S.read_table(spark, table, **{S.BUCKET: [1, 2]})
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert {r[0] for r in df.select(S.BUCKET).distinct().collect()} <= {1, 2}


def test_create_cells(spark, clients, tmp_path):
    path = str(tmp_path / "cells")
    spec = {"key": [("bp", "string")], "columns": {n: {"cf": "f", "col": n, "type": "string"} for n in ("iban", "street")}}
    cells = C.to_cells(clients.select("bp", "iban", "street"), spec, ts=1)
    with pytest.raises(ValueError):
        S.create_cells(cells, path, 3, ["bp"])
    S.create_cells(cells, path, 4, ["bp"])
    assert len(files(path)) == 4
    spans = []
    for f in Path(path).glob("*.parquet"):
        part = [r["bp"] for r in spark.read.parquet(str(f)).collect()]
        assert part == sorted(part)
        spans.append((min(part), max(part)))
    spans.sort()
    assert all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    S.create_cells(cells.limit(1), path, 4, ["bp"])
    assert S.read_cells(spark, path).count() == 400


def test_export_and_columns(spark, clients, tmp_path):
    path = str(tmp_path / "csv")
    S.export_csv(clients, path)
    S.export_csv(clients.limit(3), path)
    assert spark.read.schema(clients.schema).csv(path).count() == 3
    assert S.column_list(clients)[-1] == ("age", "int")


def test_work_folder_comes_from_the_session(spark):
    assert work_base(spark) == spark.conf.get("spark.checkpoint.dir")
    a, b = work_dir(spark, "x"), work_dir(spark, "x")
    assert a != b and a.startswith(work_base(spark)) and not os.path.exists(a)


def test_broadcast_is_measured(spark):
    small = spark.range(10)
    assert fits_broadcast(small) and fits_broadcast(small.filter("false"))
    spark.conf.set("veil.broadcast.maxBytes", "100")
    try:
        assert not fits_broadcast(small)
        assert "ResolvedHint" not in measured(small)._jdf.queryExecution().logical().toString()
    finally:
        spark.conf.unset("veil.broadcast.maxBytes")


# --- streaming --------------------------------------------------------------

def drop_file(folder, name, text):
    """Files appear at once, as a writer that renames would make them."""
    hidden = folder / f".{name}"
    hidden.write_text(text)
    hidden.rename(folder / name)


def run(spark, tmp_path, table, **options):
    E.run_stream(spark, str(tmp_path / "in"), table, str(tmp_path / "checkpoint"), "bp", N, once=True,
                 **options).awaitTermination()
    ledger = E.read_ledger(spark, str(tmp_path / "checkpoint/ledger"))
    return rows(ledger.filter("state = 'applied'").select("batch", "lines", "blank"))


def test_every_file_is_applied_once(spark, clients, table, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    drop_file(folder, "a.csv", "5,gold\n\n,\n")
    assert run(spark, tmp_path, table) == [(0, 3, 2)]
    drop_file(folder, "b.csv", " 7 \n5\nunknown,x\n")
    assert run(spark, tmp_path, table) == [(0, 3, 2), (1, 3, 0)]
    before = files(table)
    assert run(spark, tmp_path, table) == [(0, 3, 2), (1, 3, 0)]
    assert files(table) == before
    assert rows(plain(spark, table)) == rows(mask(clients, asked(spark, "5", "7"), "bp"))


def test_stream_equals_batch_over_several_batches(spark, clients, table, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(4):
        drop_file(folder, f"{i}.csv", "\n".join(str(k) for k in range(i * 10, i * 10 + 5)))
    assert len(run(spark, tmp_path, table, files_per_batch=1)) == 4
    keys = [str(k) for i in range(4) for k in range(i * 10, i * 10 + 5)]
    assert rows(plain(spark, table)) == rows(mask(clients, asked(spark, *keys), "bp"))


def test_deleting_stream(spark, clients, table, tmp_path):
    (tmp_path / "in").mkdir()
    drop_file(tmp_path / "in", "a.csv", "5\n6\n")
    run(spark, tmp_path, table, delete=True)
    assert rows(plain(spark, table)) == rows(clients.filter("bp not in ('5', '6')"))


def test_interrupted_publish_is_repeated_from_the_staged_copy(spark, clients, table, tmp_path, monkeypatch):
    ledger = str(tmp_path / "ledger")
    lines = spark.createDataFrame([("5",), ("7",)], "value string")

    def broken(session, path, staging, touched, delete=False):
        # the worst moment: old partitions are gone, new ones are not there yet
        S.drop_buckets(session, path, touched)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(E, "publish_erasure", broken)
        with pytest.raises(RuntimeError, match="lost"):
            E.apply_batch(spark, lines, 0, table, "bp", N, ledger)
    assert plain(spark, table).count() < 200
    E.apply_batch(spark, lines, 0, table, "bp", N, ledger)
    want = rows(mask(clients, asked(spark, "5", "7"), "bp"))
    assert rows(plain(spark, table)) == want
    E.apply_batch(spark, lines, 0, table, "bp", N, ledger)
    assert rows(plain(spark, table)) == want
    states = [r["state"] for r in E.read_ledger(spark, ledger).collect()]
    assert sorted(states) == ["applied", "staged"]


def test_ledger_holds_no_keys(spark, table, tmp_path):
    ledger = str(tmp_path / "ledger")
    E.apply_batch(spark, spark.createDataFrame([("secret-key-55",)], "value string"), 0, table, "bp", N, ledger)
    text = "".join(p.read_text() for p in Path(ledger).rglob("*.json"))
    assert text and "secret-key-55" not in text and MASKS["iban"] not in text


CELL_SPEC = {"key": [("bp", "string")], "columns": {
    n: {"cf": "demographics", "col": n, "type": "string"} for n in ("iban", "street")}}


def test_cell_stream_appends_masks_only(spark, clients, tmp_path):
    path = str(tmp_path / "cells")
    S.append_cells(C.to_cells(clients.drop("age"), CELL_SPEC, ts=1), path)
    before = files(path)
    (tmp_path / "in").mkdir()
    drop_file(tmp_path / "in", "a.csv", "5,x\n5\n\nnew\n")
    for _ in range(2):
        E.run_cell_stream(spark, str(tmp_path / "in"), path, str(tmp_path / "checkpoint"), "bp", once=True
                          ).awaitTermination()
    after = files(path)
    assert all(after[p] == t for p, t in before.items())
    cells = S.read_cells(spark, path)
    assert cells.filter("ts > 1").count() == 4
    want = mask(clients.drop("age"), asked(spark, "5", "new"), "bp", upsert_unmatched=True)
    assert rows(C.to_rows(cells, CELL_SPEC)) == rows(want)
    # a batch repeated after a crash leaves the views as they are
    lines = spark.createDataFrame([("5",)], "value string")
    for n in range(2):
        E.apply_cell_batch(spark, lines, 7, path, "bp", str(tmp_path / f"other{n}"))
    assert rows(C.to_rows(S.read_cells(spark, path), CELL_SPEC)) == rows(want)


def test_job_arguments(spark, clients, table, tmp_path):
    from veil.streaming import job

    (tmp_path / "in").mkdir()
    drop_file(tmp_path / "in", "a.csv", "8\n")
    base = ["--requests", str(tmp_path / "in"), "--checkpoint", str(tmp_path / "checkpoint"), "--once"]
    job.main([*base, "--table", table, "--buckets", str(N), "--mask", "iban=gone", "--mask", "street=a=b"])
    assert rows(plain(spark, table).filter("bp = '8'")) == [("8", "gone", "a=b", 8)]
    assert job.arguments([*base, "--cells", "/x"]).masks == MASKS
    for wrong in (["--cells", table, "--buckets", "8"], ["--table", table, "--cells", "/x", "--buckets", "8"], []):
        with pytest.raises(SystemExit):
            job.arguments([*base, *wrong])


# --- what must not be left behind -------------------------------------------

def stored_values(spark, *folders):
    """Every value in any Parquet file below the folders."""
    found = set()
    for folder in folders:
        for f in Path(folder).rglob("*.parquet"):
            for row in spark.read.parquet(str(f)).collect():
                found.update(row)
    return found


def test_other_bucket_counts_and_keys_are_refused(spark, clients, table, tmp_path):
    for wrong in (("bp", N * 2), ("iban", N)):
        with pytest.raises(ValueError):
            S.apply_to_table(spark, table, asked(spark, "3"), *wrong)
    assert S.apply_to_table(spark, table, asked(spark, "3"), "bp")
    # a table whose note is wrong fails at its rows, before anything is published
    S._write_layout(spark, table, "bp", N * 2, S.read_layout(spark, table)["schema"])
    before = files(table)
    with pytest.raises(Exception, match="not in the bucket of its key"):
        S.apply_to_table(spark, table, asked(spark, *map(str, range(50))), "bp")
    assert files(table) == before
    bare = str(tmp_path / "bare")
    clients.withColumn(S.BUCKET, S.bucket_of(F.col("bp"), N)).write.partitionBy(S.BUCKET).parquet(bare)
    with pytest.raises(ValueError, match="no noted bucket layout"):
        S.apply_to_table(spark, bare, asked(spark, "3"), "bp")
    with pytest.raises(ValueError, match="not laid out"):
        S.adopt_bucketed(spark, bare, "bp", N * 2)
    S.adopt_bucketed(spark, bare, "bp", N)
    assert S.apply_to_table(spark, bare, asked(spark, "3"), "bp")


def test_no_copy_of_a_requested_value_is_left(spark, clients, table, tmp_path, monkeypatch):
    monkeypatch.setattr("veil.runtime.work_base", lambda session: str(tmp_path / "work"))
    monkeypatch.setattr(E, "work_base", lambda session: str(tmp_path / "work"))
    ledger = str(tmp_path / "ledger")
    for batch, keys in enumerate((("5",), ("7", "8"), ("9",))):
        lines = spark.createDataFrame([(k,) for k in keys], "value string")
        E.apply_batch(spark, lines, batch, table, "bp", None, ledger)
    S.apply_to_table(spark, table, asked(spark, "11"), "bp")
    left = stored_values(spark, table, tmp_path / "work", ledger)
    assert not left & {f"{c}{k}" for c in "is" for k in (5, 7, 8, 9, 11)} and "i6" in left
    assert not list((tmp_path / "work").glob("*"))


@pytest.mark.parametrize("delete", [False, True])
def test_an_emptied_table_stays_readable_and_takes_batches(spark, clients, table, tmp_path, delete):
    S.apply_to_table(spark, table, asked(spark, *map(str, range(200))), "bp", delete=True)
    assert S.read_table(spark, table).count() == 0 and S.read_table(spark, table).columns == [*clients.columns, S.BUCKET]
    lines = spark.createDataFrame([("5",)], "value string")
    for _ in range(2):
        E.apply_batch(spark, lines, 0, table, "bp", None, str(tmp_path / "ledger"), delete=delete)
    assert S.read_table(spark, table).count() == 0


def test_deleting_cell_stream_rewrites_the_files_that_hold_the_key(spark, clients, tmp_path):
    path = str(tmp_path / "cells")
    cells = C.to_cells(clients.drop("age"), CELL_SPEC, ts=1)
    S.create_cells(cells, path, 4, ["bp"])
    before = files(path)
    (tmp_path / "in").mkdir()
    drop_file(tmp_path / "in", "a.csv", "5,x\nunknown\n")
    E.run_cell_stream(spark, str(tmp_path / "in"), path, str(tmp_path / "checkpoint"), "bp", delete=True, once=True
                      ).awaitTermination()
    after = files(path)
    assert len(set(before) & set(after)) == 3
    assert rows(S.read_cells(spark, path)) == rows(cells.filter("bp <> '5'"))
    assert not stored_values(spark, path) & {"i5", "s5", "5"}
    assert S.purge_cells(spark, path, asked(spark, "6"), "bp", [("demographics", "iban")]) == 1
    assert rows(S.read_cells(spark, path)) == rows(cells.filter("bp <> '5' and not (bp = '6' and qualifier = 'iban')"))
    assert S.purge_cells(spark, path, asked(spark, "unknown"), "bp") == 0


@pytest.mark.parametrize("delete", [False, True])
def test_cell_batch_is_applied_once(spark, clients, tmp_path, monkeypatch, delete):
    path, ledger = str(tmp_path / "cells"), str(tmp_path / "ledger")
    cells = C.to_cells(clients.drop("age"), CELL_SPEC, ts=1)
    S.append_cells(cells, path)
    lines = spark.createDataFrame([("5",)], "value string")

    def broken(real):
        def publish(*args):
            real(*args)
            raise RuntimeError("lost")
        return publish

    name = "publish_purge" if delete else "append_cells"
    with monkeypatch.context() as m:
        m.setattr(E, name, broken(getattr(E, name)))
        with pytest.raises(RuntimeError, match="lost"):
            E.apply_cell_batch(spark, lines, 0, path, "bp", ledger, delete=delete)
    for _ in range(2):
        E.apply_cell_batch(spark, lines, 0, path, "bp", ledger, delete=delete)
    mine = S.read_cells(spark, path).filter("bp = '5'")
    assert mine.count() == (0 if delete else 4)
    assert S.read_cells(spark, path).filter("bp <> '5'").count() == 398


def test_a_mask_is_newer_than_any_version(spark, tmp_path):
    path = str(tmp_path / "cells")
    far = 10**15
    S.append_cells(spark.createDataFrame(
        [("1", "demographics", "street", far, "ZETA STRASSE 1")],
        "bp string, cf string, qualifier string, ts bigint, value string"), path)
    lines = spark.createDataFrame([("1",)], "value string")
    E.apply_cell_batch(spark, lines, 0, path, "bp", str(tmp_path / "ledger"), ts=far)
    assert rows(C.to_rows(S.read_cells(spark, path), CELL_SPEC)) == [("1", MASKS["iban"], MASKS["street"])]


def test_snapshots_give_every_text_back(spark, tmp_path):
    texts = ["plain", "two\nlines", 'a "quoted" word', "comma, here", " blanks ", "back\\slash", "\\", '"', '\\"', "tab\there", None, "ünï", "'", "a\n\n\"b\",\\\n"]
    df = spark.createDataFrame([(i, t, None if i % 2 else 1.5) for i, t in enumerate(texts)], "id int, text string, x double")
    for header in (False, True):
        S.export_csv(df.repartition(3), str(tmp_path / "csv"), header)
        assert rows(S.read_csv(spark, str(tmp_path / "csv"), df.schema, header)) == rows(df)


def test_a_purge_goes_through_the_files_step_by_step(spark, clients, tmp_path, monkeypatch):
    path = str(tmp_path / "cells")
    spec = {"key": [("bp", "string")], "columns": {c: {"cf": "f", "col": c, "type": "string"} for c in ("iban", "street")}}
    S.create_cells(C.to_cells(clients, spec, ts=1), path, 8, ["bp"])
    monkeypatch.setattr(S, "FILES_AT_ONCE", 2)
    keys = [str(k) for k in range(0, 200, 9)]
    assert S.purge_cells(spark, path, asked(spark, *keys), "bp") > 2
    left = {r.bp for r in S.read_cells(spark, path).select("bp").distinct().collect()}
    assert left == {str(k) for k in range(200)} - set(keys)
    assert S.purge_cells(spark, path, asked(spark, *keys), "bp") == 0

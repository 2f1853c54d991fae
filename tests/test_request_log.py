"""Request logs, and erasure in tables with partition columns of their own."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from veil.operators.erase import answer, erase, mask
from veil.sources import partitions as P, request_log as L, tables as S
from veil.sources.commits import CommitLog
from veil.streaming.erasure import run_log_stream

N = 8


@pytest.fixture
def clients(spark):
    """Three rows per key, two partition columns, one of them sometimes null."""
    n = F.col("id")
    return spark.range(150).select(
        (n % 50).cast("string").alias("bp"), n.cast("string").alias("account"), F.concat(F.lit("i"), n).alias("iban"),
        F.concat(F.lit("s"), n).alias("street"), F.when(n % 7 != 0, F.concat(F.lit("c/"), n % 4)).alias("country"), (n % 3).cast("int").alias("year"),
    )


def asked(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "bp string")


def files(path):
    return {str(p): p.stat().st_mtime_ns for p in Path(path).rglob("*.parquet")}


def steps(spark, clients, batches):
    out = clients
    for kind, keys in batches:
        out = answer(out, asked(spark, *keys), "bp", kind, order=["account"])
    return out


BATCHES = [
    [("mask", ["1", "2", " 2 ", ""]), ("delete", ["3", "x"])],
    [("replace", ["4", "1"]), ("upsert", ["5", "new"]), ("delete", ["new", "6"])],
    [("delete", ["7"]), ("upsert", ["7", "8"]), ("replace_upsert", ["9", "late"]), ("replace", ["7"])],
    [("upsert", ["0"]), ("delete", ["0"]), ("mask", ["0", "unknown"])],
]


@pytest.mark.parametrize("batches, small", [(b, True) for b in BATCHES] + [(BATCHES[1], False)])
def test_view_equals_the_batches_one_by_one(spark, clients, tmp_path, batches, small):
    table, log = str(tmp_path / "t"), str(tmp_path / "log")
    S.write_bucketed(clients, table, "bp", N)
    before = files(table)
    spark.conf.set("veil.broadcast.maxRows", "1000" if small else "0")
    try:
        assert rows(L.logged_view(spark, table, log, "bp").drop(S.BUCKET)) == rows(clients)
        for n, (kind, keys) in enumerate(batches):
            L.log_batch(spark, asked(spark, *keys), n, log, "bp", kind)
            L.log_batch(spark, asked(spark, *keys), n, log, "bp", kind)
        want = rows(steps(spark, clients, batches))
        view = lambda: rows(L.logged_view(spark, table, log, "bp", order=["account"]).drop(S.BUCKET))
        assert view() == want
        assert files(table) == before
        touched = L.compact_log(spark, table, log, "bp", order=["account"])
        assert 0 < len(touched) <= N
        assert rows(S.read_table(spark, table).drop(S.BUCKET)) == want == view()
        assert L.read_log(spark, log, pending=False).count() == 0
        assert L.compact_log(spark, table, log, "bp") == []
        L.log_batch(spark, asked(spark, "11"), 0, log, "bp", "delete")  # an old batch comes again
        assert view() == want
    finally:
        spark.conf.unset("veil.broadcast.maxRows")


@pytest.mark.parametrize("step", ["stage", "publish", "half", "note"])
def test_interrupted_compaction(spark, clients, tmp_path, monkeypatch, step):
    table, log = str(tmp_path / "t"), str(tmp_path / "log")
    S.write_bucketed(clients, table, "bp", N)
    for n, (kind, keys) in enumerate(BATCHES[2]):
        L.log_batch(spark, asked(spark, *keys), n, log, "bp", kind)
    want = rows(steps(spark, clients, BATCHES[2]))

    def fail(*args, **kwargs):
        raise OSError("gone")

    with monkeypatch.context() as m:
        if step == "stage":
            m.setattr(L, "_stage", fail)
        elif step == "publish":
            m.setattr(L, "publish_erasure", fail)
        elif step == "half":
            whole = S.rewrite_partitions

            def half(df, path, by):
                some = df.select(S.BUCKET).distinct().orderBy(S.BUCKET).limit(2).collect()
                whole(df.filter(F.col(S.BUCKET).isin([r[0] for r in some])), path, by)
                fail()

            m.setattr(S, "rewrite_partitions", half)
        else:
            put = CommitLog.put
            m.setattr(CommitLog, "put", lambda self, n, e: fail() if "staging" not in e else put(self, n, e))
        with pytest.raises(OSError):
            L.compact_log(spark, table, log, "bp", order=["account"])
    assert rows(L.logged_view(spark, table, log, "bp", order=["account"]).drop(S.BUCKET)) == want
    L.compact_log(spark, table, log, "bp", order=["account"])
    assert rows(S.read_table(spark, table).drop(S.BUCKET)) == want


def test_log_stream(spark, clients, tmp_path):
    """No requested value is seen after a batch, though no file is rewritten before the compaction."""
    table, log, base = str(tmp_path / "t"), str(tmp_path / "log"), str(tmp_path)
    S.write_bucketed(clients, table, "bp", N)
    before = files(table)
    (tmp_path / "in").mkdir()

    def run(name, *keys, **more):
        (tmp_path / "in" / name).write_text("\n".join(keys))
        run_log_stream(spark, f"{base}/in", table, log, f"{base}/progress", "bp", once=True, **more).awaitTermination()
        return rows(L.logged_view(spark, table, log, "bp").drop(S.BUCKET))

    assert run("a", "1,x", "", "2") == rows(mask(clients, asked(spark, "1", "2"), "bp"))
    assert files(table) == before
    assert run("b", "40", "1") == rows(mask(clients, asked(spark, "1", "2", "40"), "bp"))
    assert files(table) == before
    want = rows(mask(clients, asked(spark, "1", "2", "40", "41"), "bp"))
    assert run("c", "41", compact_every=3) == want
    assert rows(S.read_table(spark, table).drop(S.BUCKET)) == want
    assert L.read_log(spark, log, pending=False).count() == 0


# --- tables with partition columns of their own ------------------------------

@pytest.fixture(params=["path", "catalog"])
def own(request, spark, clients, tmp_path):
    if request.param == "path":
        name = str(tmp_path / "own")
        clients.write.partitionBy("country", "year").parquet(name)
        yield name
        return
    spark.sql("DROP TABLE IF EXISTS own_parts")
    clients.write.partitionBy("country", "year").format("parquet").saveAsTable("own_parts")
    yield "own_parts"
    spark.sql("DROP TABLE own_parts")


def plain(spark, table, like):
    return rows(S.read_table(spark, table).select(*like.columns))


@pytest.mark.parametrize("kind", ["mask", "replace", "upsert", "delete"])
def test_own_partitions(spark, clients, own, kind):
    assert P.partition_columns(spark, own) == ["country", "year"]
    keys = asked(spark, "1", "7", "nobody")
    parts = P.erase_in_partitions(spark, own, keys, "bp", kind, order=["account"])
    want = answer(clients, keys, "bp", kind, order=["account"])
    assert plain(spark, own, clients) == rows(want)
    held = {(c, str(y)) for c, y in clients.filter("bp in ('1', '7')").select("country", "year").distinct().collect()}
    assert {tuple(p) for p in parts} == held | ({(None, None)} if kind == "upsert" else set())
    assert P.erase_in_partitions(spark, own, asked(spark, "nobody-else"), "bp") == []


def test_partitions_can_be_emptied(spark, clients, own):
    keys = clients.filter("year = 1 and country = 'c/2'").select("bp").distinct()
    gone = rows(keys)
    P.erase_in_partitions(spark, own, asked(spark, *[k for (k,) in gone]), "bp", "delete")
    assert plain(spark, own, clients) == rows(erase(clients, asked(spark, *[k for (k,) in gone]), "bp"))


@pytest.mark.parametrize("step", ["stage", "noted", "half", "published"])
def test_crash_at_each_step(spark, clients, own, monkeypatch, step):
    if own == "own_parts" and step in ("stage", "published"):
        pytest.skip("the same steps as for a path")
    keys = asked(spark, "1", "7")
    before = rows(clients)

    def fail(*args, **kwargs):
        raise OSError("gone")

    with monkeypatch.context() as m:
        if step == "stage":
            m.setattr(P, "stage_partitions", fail)
        elif step == "noted":
            m.setattr(P, "publish_partitions", fail)
        elif step == "half":
            whole = P.rewrite_partitions

            def half(df, table, by):
                whole(df.filter("year = 1"), table, by)
                fail()

            m.setattr(P, "rewrite_partitions", half)
        else:
            put = CommitLog.put
            m.setattr(CommitLog, "put", lambda self, n, e: fail() if e["state"] == "applied" else put(self, n, e))
        with pytest.raises(OSError):
            P.erase_in_partitions(spark, own, keys, "bp", token="b1")
    if step in ("stage", "noted"):
        assert plain(spark, own, clients) == before
    assert P.recover(spark, own) == (step != "stage")
    P.erase_in_partitions(spark, own, keys, "bp", token="b1")
    assert plain(spark, own, clients) == rows(mask(clients, keys, "bp"))
    assert not P.recover(spark, own)


def test_many_partitions_are_found_by_a_join(spark, clients, own, monkeypatch):
    monkeypatch.setattr(P, "PARTITIONS_IN_PLAN", 1)
    keys = asked(spark, *map(str, range(20)))
    P.erase_in_partitions(spark, own, keys, "bp")
    assert plain(spark, own, clients) == rows(mask(clients, keys, "bp"))

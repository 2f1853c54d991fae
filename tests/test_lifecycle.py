"""Requests across the batches of a stream."""

import pytest

from tests.conftest import rows
from tests.test_request_log import N, asked, clients, files  # noqa: F401
from veil.operators.erase import audit, mask
from veil.sources import tables as S
from veil.streaming import lifecycle as Y


@pytest.fixture
def run(spark, clients, tmp_path):  # noqa: F811
    base, table = str(tmp_path), str(tmp_path / "t")
    S.write_bucketed(clients, table, "bp", N)
    (tmp_path / "in").mkdir()

    def step(name, *lines, **more):
        (tmp_path / "in" / name).write_text("\n".join(lines))
        Y.run_lifecycle_stream(spark, f"{base}/in", table, f"{base}/c", "bp", once=True, **more).awaitTermination()
        return rows(Y.read_lives(spark, f"{base}/c/lives").select(*[f.name for f in Y.LIFE.fields]))

    step.table = table
    return step


def test_a_repeated_request_rewrites_nothing(spark, clients, run):  # noqa: F811
    assert run("a", "1,x", "", "2", "1", "nobody") == [(0, 5, 1, 3, 1, 2, 1)]
    keys = asked(spark, "1", "2", "nobody")
    assert rows(S.read_table(spark, run.table).drop(S.BUCKET)) == rows(mask(clients, keys, "bp"))
    found = audit(clients, keys, "bp", ["iban"]).collect()
    assert (sum(r.rows_found > 0 for r in found), sum(r.rows_found == 0 for r in found)) == (2, 1)
    before = files(run.table)
    assert run("b", "2", "nobody", " 1 ")[1:] == [(1, 3, 0, 0, 3, 0, 0)]
    assert files(run.table) == before
    assert run("c", "1", "3")[2:] == [(2, 2, 0, 1, 1, 1, 0)]
    assert rows(S.read_table(spark, run.table).drop(S.BUCKET)) == rows(mask(clients, asked(spark, "1", "2", "3"), "bp"))


def test_an_interrupted_batch_keeps_its_counts(spark, clients, run, monkeypatch):  # noqa: F811
    with monkeypatch.context() as m:
        def fail(*args, **kwargs):
            raise OSError("gone")

        m.setattr(Y, "answer_batch", fail)
        with pytest.raises(Exception, match="gone"):
            run("a", "1", "2", "nobody", kind="delete")
    assert run("b", "1", kind="delete") == [(0, 3, 0, 3, 0, 2, 1), (1, 1, 0, 0, 1, 0, 0)]
    assert S.read_table(spark, run.table).filter("bp in ('1', '2')").count() == 0


def test_blank_lines_are_dealt_to_several_groups(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a").write_text("\n".join(["", "  ", ",x"] * 1000 + [" 7 ,x", "7", "8"]))
    spark.conf.set(Y.STORE, Y.ROCKSDB)
    try:
        tracked = Y.track(spark.readStream.text(str(tmp_path / "in"))).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        tracked.option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.unset(Y.STORE)
    out = [tuple(r) for r in spark.read.schema(Y.TRACKED).parquet(str(tmp_path / "out")).collect()]
    blank = [lines for key, lines, _ in out if key is None]
    assert sum(blank) == 3000 and 1 < len(blank) <= Y.BLANK_GROUPS and max(blank) < 300
    assert sorted(r for r in out if r[0] is not None) == [("7", 2, 0), ("8", 1, 0)]

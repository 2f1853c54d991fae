"""Coders both ways, raw values of other lengths, and the digest tree."""

import struct

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from veil.functions.codec import from_bytes
from veil.functions.coders import Coder, broken_round_trips, check_round_trips
from veil.functions.keys import split_key
from veil.operators import cells as C
from veil.operators.compare import diff, diff_by_digest
from veil.spec import parse_type

SPEC = {"key": [("k", "string")], "columns": {
    "cents": {"cf": "f", "col": "cents", "type": "double"}, "plain": {"cf": "f", "col": "plain", "type": "int"},
    "log": {"cf": "f", "col": "", "type": "map<string,double>"},
}}
CENTS = Coder(lambda v: F.round(v * 100).cast("bigint").cast("string"), lambda s: s.cast("string").try_cast("bigint") / 100)


def test_a_coder_works_both_ways(spark):
    df = spark.createDataFrame([("x", 1.25, 7, {"a": 0.5, "b": 2.0}), ("y", None, None, None), ("z", -0.01, 0, {})], "k string, cents double, plain int, log map<string,double>")
    coders = {"cents": CENTS, "log": CENTS}
    cells = C.to_cells(df, SPEC, ts=1, coders=coders)
    assert {(r.k, r.qualifier): r.value for r in cells.collect()} == {
        ("x", "cents"): "125", ("x", "plain"): "7", ("x", "a"): "50", ("x", "b"): "200", ("z", "cents"): "-1", ("z", "plain"): "0"}
    again = C.to_rows(cells, SPEC, scope="family", decoders=coders)
    assert rows(again.select("k", "cents", "plain", "log.a")) == [("x", 1.25, 7, 0.5), ("z", -0.01, 0, None)]


def test_raw_cells(spark):
    spec = {"key": [("k", "string")], "columns": {c: SPEC["columns"][c] for c in ("cents", "plain")}}
    df = spark.createDataFrame([("x", 1.25, 7)], "k string, cents double, plain int")
    raw = C.encode_cells(C.to_cells(df, spec, ts=1), spec, coders={"cents": CENTS})
    assert {r.qualifier: bytes(r.value) for r in raw.collect()} == {"cents": b"125", "plain": struct.pack(">i", 7)}
    assert {r.qualifier: r.value for r in C.decode_cells(raw, spec, coders={"cents": CENTS}).collect()} == {"cents": "1.25", "plain": "7"}


def test_broken_coders_are_found(spark):
    df = spark.createDataFrame([(1.25, 1.0), (0.333, None)], "cents double, other double")
    assert rows(broken_round_trips(df, {"cents": CENTS, "other": CENTS})) == [("cents", "0.333", "33", "0.33")]
    with pytest.raises(ValueError, match="cents"):
        check_round_trips(df, {"cents": CENTS})
    check_round_trips(df.filter("cents > 1"), {"cents": CENTS})


@pytest.mark.parametrize("kind, form", [("bigint", ">q"), ("int", ">i"), ("smallint", ">h"), ("tinyint", ">b"), ("double", ">d"), ("float", ">f"), ("boolean", ">?")])
def test_values_of_other_lengths(spark, kind, form):
    width = struct.calcsize(form)
    values = [bytes((37 * (i + n) + 129) % 256 for i in range(n)) for n in range(11)] + [b"\xff" * 9, b"\x80" + b"\0" * 7]
    got = spark.createDataFrame([(v,) for v in values], "v binary").select("v", from_bytes(F.col("v"), parse_type(kind)).alias("x")).collect()
    for v, x in got:
        want = struct.unpack(form, bytes(v[:width]))[0] if len(v) >= width else None
        assert repr(x) == repr(want), (v, x, want)


def test_short_keys(spark):
    dims = [("a", "int"), ("b", "string", 3), ("c", "string")]
    df = spark.createDataFrame([(b"\0\0\0\x05abcrest",), (b"\0\0\0\x05ab",), (b"\0\0",), (b"\0\0\0\x05abc",), (None,)], "rowkey binary")
    assert rows(split_key(df, dims)) == sorted([(5, "abc", "rest"), (5, None, ""), (None, None, ""), (5, "abc", ""), (None, None, None)], key=repr)


# --- digest tree -------------------------------------------------------------

def copies(spark, n=4000):
    i = F.col("id")
    left = spark.range(n).select(
        F.when(i % 97 != 5, i).alias("a"), (i % 7).cast("string").alias("b"), F.when(i % 3 != 0, i / 7).alias("x"), F.array(i).alias("y"),
        F.create_map(F.lit("k"), i).alias("m"), i.cast("timestamp").alias("t"),
    ).dropDuplicates(["a", "b"])
    right = left.filter("a is null or a <> 17").withColumn("x", F.when(F.col("a") == 100, F.lit(None)).otherwise(F.col("x")))
    right = right.withColumn("y", F.when(F.col("a") == 200, F.array(F.lit(1), F.lit(2))).otherwise(F.col("y"))).withColumn("z", F.when(F.col("a") == 300, 1))
    return left, right.unionByName(left.limit(1).withColumn("a", F.lit(-1)), allowMissingColumns=True)


@pytest.mark.parametrize("ranges", [1, 16, 5000])
def test_digest_tree_finds_the_same(spark, ranges):
    left, right = copies(spark)
    want = rows(diff(left, right, ["a", "b"]))
    assert want and rows(diff_by_digest(left, right, ["a", "b"], ranges=ranges)) == want
    assert diff_by_digest(left, left, ["a", "b"], ranges=ranges).count() == 0
    nulls = spark.createDataFrame([(1, None, "v"), (2, "v", None)], "k int, p string, q string")
    moved = spark.createDataFrame([(1, "v", None), (2, "v", None)], "k int, p string, q string")
    assert rows(diff_by_digest(nulls, moved, ["k"], ranges=ranges)) == rows(diff(nulls, moved, ["k"]))


def shuffled(df):
    """Bytes that a frame's stages shuffle, from the metrics of the plan that ran."""
    df.collect()

    def bytes_of(node):
        total, name = 0, node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return bytes_of(node.executedPlan())
        if "QueryStage" in name:
            return bytes_of(node.plan())
        metrics = node.metrics()
        if metrics.contains("shuffleBytesWritten"):
            total += metrics.apply("shuffleBytesWritten").value()
        children = node.children()
        return total + sum(bytes_of(children.apply(i)) for i in range(children.size()))

    return bytes_of(df._jdf.queryExecution().executedPlan())


def test_what_is_shuffled_follows_the_differences(spark, tmp_path):
    i = F.col("id")
    spark.range(60_000).select(i, F.sha2(i.cast("string"), 512).alias("text")).write.parquet(str(tmp_path / "a"))
    left = spark.read.parquet(str(tmp_path / "a"))
    right = left.withColumn("text", F.when(i == 5, "other").otherwise(F.col("text")))
    assert rows(diff_by_digest(left, right, ["id"], ranges=64).select("id")) == [(5,)]
    assert shuffled(diff_by_digest(left, right, ["id"], ranges=64)) * 20 < shuffled(diff(left, right, ["id"]))

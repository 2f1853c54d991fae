"""Key and range lookups, order, predicates, and table comparison."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from veil.operators import predicates as P
from veil.operators.compare import diff
from veil.operators.lookup import (
    difference, first_per_key, in_key_order, lookup, preview, range_lookup, together,
)


@pytest.fixture(params=["broadcast", "shuffle"])
def join_kind(spark, request):
    if request.param == "shuffle":
        spark.conf.set("veil.broadcast.maxRows", "0")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("veil.broadcast.maxRows")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def numbers(spark):
    return spark.range(100).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_lookup_by_list_and_by_table(spark, numbers, join_kind):
    keys = spark.createDataFrame([(3,), (7,), (7,), (500,), (None,)], "k bigint")
    assert ids(lookup(numbers, keys, "k")) == ids(lookup(numbers, [3, 7, 7, 500], "k")) == [3, 7]


def test_lookup_by_composite_key(spark, join_kind):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a")], "k int, q string")
    keys = spark.createDataFrame([("a", 2), ("b", 1)], "q string, k int")
    assert rows(lookup(df, keys, ["k", "q"])) == [(1, "b"), (2, "a")]


def test_ranges_are_half_open_and_rows_come_once(spark, numbers, join_kind):
    pairs = [(5, 9), (7, 12), (20, 25), (40, 40), (60, 50)]
    want = list(range(5, 12)) + list(range(20, 25))
    table = spark.createDataFrame(pairs, "lo bigint, hi bigint")
    assert ids(range_lookup(numbers, table, "k")) == want
    assert ids(range_lookup(numbers, pairs, "k")) == want


def test_open_ranges(spark, numbers, join_kind):
    table = spark.createDataFrame([(None, 3), (97, None), (50, 51)], "lo bigint, hi bigint")
    assert ids(range_lookup(numbers, table, "k")) == [0, 1, 2, 50, 97, 98, 99]
    assert ids(range_lookup(numbers, [(None, 3), (97, None)], "k")) == [0, 1, 2, 97, 98, 99]
    everything = spark.createDataFrame([(None, None)], "lo bigint, hi bigint")
    assert range_lookup(numbers, everything, "k").count() == 100
    assert range_lookup(numbers, everything.filter("false"), "k").count() == 0
    assert range_lookup(numbers, [], "k").count() == 0


@pytest.mark.parametrize("kind", ["bigint", "double", "string", "date", "timestamp"])
def test_ranges_equal_brute_force(spark, kind):
    rnd = random.Random(3)
    # uneven: many tiny ranges and one that spans most of the axis
    pairs = [(x := rnd.randrange(0, 10_000), x + rnd.randrange(0, 5)) for _ in range(300)] + [(20_000, 90_000)]
    keys = [rnd.randrange(0, 100_000) for _ in range(3000)] + [20_000] * 1500 + [-5, 100_001]
    texts = {
        "bigint": "cast(x as bigint)", "double": "cast(x as double) / 7", "string": "lpad(cast(x + 10 as string), 8, '0')",
        "date": "date_add(date'1970-01-01', x)", "timestamp": "timestamp_seconds(cast(x as bigint) * 1000)",
    }
    as_kind = lambda df, c: df.withColumn(c, F.expr(texts[kind].replace("x", c)) if kind != "date"
                                          else F.date_add(F.lit("1970-01-01").cast("date"), F.col(c)))
    df = as_kind(spark.createDataFrame([(k, k) for k in keys], "id int, key int"), "key")
    table = spark.createDataFrame(pairs, "lo int, hi int")
    table = as_kind(as_kind(table, "lo"), "hi")
    want = sorted(k for k in keys if any(lo <= k < hi for lo, hi in pairs))
    assert ids(range_lookup(df, table, "key")) == want


def test_first_per_key_needs_an_order(spark):
    df = spark.createDataFrame([("a", 2), ("a", 1), ("b", 5)], "k string, v int")
    assert rows(first_per_key(df, "k", "v")) == [("a", 1), ("b", 5)]
    assert rows(first_per_key(df, "k", F.desc("v"))) == [("a", 2), ("b", 5)]
    with pytest.raises(ValueError):
        first_per_key(df, "k")


def test_key_order_is_by_unsigned_bytes(spark):
    df = spark.createDataFrame([(bytearray(b),) for b in (b"\x80", b"\x7f", b"", b"\xff\x00", b"\x7f\x00")], "k binary")
    assert [bytes(r[0]) for r in in_key_order(df, "k").collect()] == [b"", b"\x7f", b"\x7f\x00", b"\x80", b"\xff\x00"]


def test_preview_together_difference(spark, numbers):
    assert [r["k"] for r in preview(numbers, 3, "v").collect()] == [0, 1, 2]
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, k int")
    assert rows(together(a, b)) == [(1, "x"), (2, "y")]
    assert rows(difference(together(a, a), b.select("k", "v"))) == [(1, "x")]


# --- predicates -------------------------------------------------------------

@pytest.fixture
def texts(spark):
    return spark.createDataFrame([("1", "a.c"), ("2", "a.cx"), ("3", "abc"), ("4", "ABC"), ("5", None)], "k string, c string")


def keys_of(df):
    return "".join(sorted(r["k"] for r in df.collect()))


def test_ends_with_is_literal_and_anchored(texts):
    assert keys_of(texts.filter(P.ends_with("c", "a.c"))) == "1"


def test_contains_respects_case(texts):
    assert keys_of(texts.filter(P.contains("c", "b"))) == "3"
    assert keys_of(texts.filter(P.contains("c", "b", ci=True))) == "34"
    assert keys_of(texts.filter(P.not_contains("c", "b"))) == "124"


def test_in_on_a_value_column_filters(texts):
    assert keys_of(texts.filter(P.in_list("c", ["abc", "zzz"]))) == "3"
    assert keys_of(texts.filter(P.not_in_list("c", ["abc"]))) == "124"
    assert keys_of(texts.filter(P.in_but_not_in("c", ["abc", "ABC"], ["ABC"]))) == "3"
    assert keys_of(texts.filter(P.in_but_not_in("c", ["abc"], ["abc"]))) == ""


def test_or_of_key_and_value(texts):
    assert keys_of(texts.filter((F.col("k") == "1") | (F.col("c") == "abc"))) == "13"


def test_or_of_pairs_does_not_mix(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "y")], "k string, c string")
    k, c = F.col("k"), F.col("c")
    assert rows(df.filter(((k == "a") & (c == "x")) | ((k == "b") & (c == "y")))) == [("a", "x"), ("b", "y")]


def test_numbers_compare_by_value(spark):
    inf = float("inf")
    df = spark.createDataFrame([(v,) for v in (-inf, -1.0, 0.0, 1.0, inf, float("nan"))], "v double")
    assert df.filter("v < 0").count() == 2
    assert df.filter("v > 0").count() == 3
    small = spark.sql("SELECT cast(v AS tinyint) AS v FROM VALUES (-128), (0), (127) t(v)")
    assert rows(small.filter("v < 1")) == [(-128,), (0,)]


def test_field_list(texts):
    assert P.select_fields(texts, "c,, k ,").columns == ["c", "k"]


# --- comparison -------------------------------------------------------------

def test_diff_kinds(spark):
    left = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0), (None, "n", 0.0)], "k int, s string, d double")
    right = spark.createDataFrame([(1, "a", 1.0), (2, "B", None), (4, "d", None), (None, "n", 0.5)], "k int, s string, d double")
    assert rows(diff(left, right, ["k"])) == sorted([
        (2, "s", "b", "B", "changed"), (3, "s", "c", None, "only_left"), (3, "d", "3.0", None, "only_left"),
        (4, "s", None, "d", "only_right"), (4, "d", None, None, "only_right"), (None, "d", "0.0", "0.5", "changed"),
    ], key=repr)


def test_diff_of_equal_copies_is_empty(spark, numbers):
    assert diff(numbers, numbers, ["k"]).count() == 0


def test_repeated_keys_are_reported_not_paired(spark):
    hot = spark.range(3000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    other = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    assert rows(diff(hot, other, ["k"])) == [(1, None, "3000", "2000", "duplicate")]


def test_long_lists_and_their_complement(spark):
    df = spark.range(5000).withColumnRenamed("id", "k").union(spark.sql("select cast(null as bigint)"))
    many = list(range(0, 6000, 2))
    assert lookup(df, many, "k").count() == 2500 and lookup(df, many, "k", negate=True).count() == 2500
    assert lookup(df, [1, 2], "k", negate=True).count() == 4998
    assert lookup(df, [*many, None], "k", negate=True).count() == 0
    assert df.filter(P.not_in_list("k", many)).count() == 2500
    assert df.filter(P.in_but_not_in("k", [1, 2], [2, None])).count() == 0
    assert range_lookup(df, [(i, i + 1) for i in range(0, 4000, 2)], "k").count() == 2000


def test_diff_sees_microseconds_and_columns_of_one_side(spark):
    left = spark.sql("select 1 k, timestamp'2024-01-01 00:00:00.000001' t, 5 a")
    right = spark.sql("select 1 k, timestamp'2024-01-01 00:00:00.000999' t, 6 b")
    assert {r["column"] for r in diff(left, right, ["k"]).collect()} == {"t", "a", "b"}


@pytest.mark.parametrize("parts", [2, 512])
def test_ranges_of_text_with_a_common_prefix(spark, parts, monkeypatch, join_kind):
    from veil.operators import lookup as L

    monkeypatch.setattr(L, "PARTS", parts)
    name = lambda c: F.concat(F.lit("https://the-same-host.example.org/"), F.lpad(c.cast("string"), 6, "0"))
    df = spark.range(6000).select("id", name(F.col("id")).alias("key"))
    narrow = spark.range(0, 3000, 3).select(name(F.col("id")).alias("lo"), name(F.col("id") + 1).alias("hi"))
    wide = spark.createDataFrame([(3500, 5000), (100, 200), (4000, 4100), (5500, 5400)], "a int, b int").select(name(F.col("a")).alias("lo"), name(F.col("b")).alias("hi"))
    open_end = spark.createDataFrame([(5990,)], "a int").select(name(F.col("a")).alias("lo"), F.lit(None).cast("string").alias("hi"))
    got = ids(range_lookup(df, narrow.unionByName(wide).unionByName(open_end), "key"))
    assert got == sorted({*range(0, 3000, 3), *range(100, 200), *range(3500, 5000), *range(5990, 6000)})


def test_a_wide_range_makes_no_part_large(spark, numbers):
    """Parts are cut at the starts of ranges, so one wide range among narrow ones changes nothing."""
    from veil.operators.cuts import depth_cuts, not_above

    starts = spark.range(10_000).select(F.lit(0).alias("g"), F.when(F.col("id") < 9_000, F.col("id")).otherwise(F.col("id") * 1_000_000).alias("t"))
    cuts = depth_cuts(starts, ["g"], "t", 100)
    per_part = starts.join(cuts, "g").groupBy(not_above(F.col("cuts"), F.col("steps"), F.col("t")).alias("part")).count()
    sizes = [r["count"] for r in per_part.collect()]
    assert 80 <= len(sizes) <= 120 and max(sizes) <= 200


def test_every_column_breaks_ties(spark):
    schema = "k int, m map<string,int>, s struct<a:int,b:array<int>>, l array<string>, n map<string,map<string,int>>"
    data = [(1, {"b": 1, "a": 2}, (1, [2]), ["x"], None), (1, {"a": 2}, (1, [2]), ["x"], None), (1, None, (1, [1]), ["y"], {"q": {"r": 1}}), (1, None, (1, [1]), ["y"], {"q": {"r": 0}})]
    results = set()
    for turn in range(4):
        frame = spark.createDataFrame(data[turn:] + data[:turn], schema).repartition(3)
        results.add(repr([r.asDict(True) for r in in_key_order(frame, "k").collect()]))
    assert len(results) == 1

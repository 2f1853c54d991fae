"""Versioned cells: the evaluation order and the edge cases of versions, maps and flattening."""

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tests.conftest import rows
from veil.operators import cells as C
from veil.spec import CellSpec, cell_spec

SPEC = {
    "key": [("k", "string")],
    "columns": {
        "a": {"cf": "f", "col": "a", "type": "int"},
        "b": {"cf": "f", "col": "b", "type": "string"},
        "g": {"cf": "h", "col": "g", "type": "string"},
    },
}
MAPS = {
    "key": [("k", "string")],
    "columns": {
        "a": {"cf": "f", "col": "a", "type": "int"},
        "b": {"cf": "f", "col": "b", "type": "string"},
        "rest": {"cf": "f", "col": "", "type": "map<string,string>"},
    },
}


def make(spark, data):
    return spark.createDataFrame(data, "k string, cf string, qualifier string, ts bigint, value string")


@pytest.fixture
def versions(spark):
    return make(spark, [
        ("x", "f", "a", 1, "10"), ("x", "f", "a", 2, "20"), ("x", "f", "b", 2, "two"), ("x", "f", "a", 5, "50"),
    ])


def test_latest_and_missing(spark, versions):
    more = versions.unionByName(make(spark, [("y", "f", "b", 1, "only")]))
    assert rows(C.to_rows(more, SPEC, ["k", "a", "b"])) == [("x", 50, "two"), ("y", None, "only")]


def test_missing_value_fails_every_comparison(spark, versions):
    more = versions.unionByName(make(spark, [("y", "f", "b", 1, "only")]))
    typed = C.to_rows(more, SPEC, ["k", "a", "b"])
    for p in (F.col("a") == 50, F.col("a") != 1, ~(F.col("a") < 3), F.col("a") > 1):
        assert [r[0] for r in rows(typed.filter(p))] == ["x"]


def test_time_range_is_half_open(versions):
    assert rows(C.to_rows(versions, SPEC, ["k", "a"], min_ts=1, max_ts=5)) == [("x", 20)]
    assert rows(C.to_rows(versions, SPEC, ["k", "a"], timestamp=1)) == [("x", 10)]


def test_newest_versions_after_the_time_filter(versions):
    kept = C.last_versions(C.between(versions, 1, 5), ["k"], 1)
    assert sorted(r["ts"] for r in kept.collect()) == [2, 2]
    newest = C.last_versions(versions.filter("qualifier = 'a'"), ["k"], 2)
    assert sorted(r["ts"] for r in newest.collect()) == [2, 5]


@pytest.mark.parametrize("n", [1, 2, 3, 5000])
def test_newest_n_equals_brute_force(spark, n):
    cells = spark.range(4000).select(
        # one cell holds most of the rows
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        F.lit("f").alias("cf"), F.lit("a").alias("qualifier"),
        (F.col("id") * 7919 % 1009).alias("ts"), F.col("id").cast("string").alias("value"),
    )
    got = rows(C.last_versions(cells.repartition(6), ["k"], n))
    groups = {}
    for r in sorted(map(tuple, cells.collect()), key=lambda r: (r[3], r[4])):
        groups.setdefault(r[0], {})[r[3]] = r  # the greatest value of a timestamp is its version
    want = [x for g in groups.values() for x in sorted(g.values(), key=lambda r: r[3], reverse=True)[:n]]
    assert got == sorted(want, key=repr)


def test_ties_do_not_depend_on_row_order(spark):
    data = [("x", "f", "a", 1, str(v)) for v in (3, 9, 5)]
    for order in (data, data[::-1]):
        cells = make(spark, order)
        assert rows(C.to_rows(cells, SPEC, ["a"])) == [(9,)]
        assert rows(C.last_versions(cells, ["k"], 2)) == [("x", "f", "a", 1, "9")]  # one timestamp, one version
        assert rows(C.compact(cells, ["k"])) == [("x", "f", "a", 1, "9")]


def test_tie_by_write_number(spark):
    cells = make(spark, [("x", "f", "a", 1, "9"), ("x", "f", "a", 1, "3")]).withColumn(
        "seq", F.when(F.col("value") == "3", 2).otherwise(1)
    )
    assert rows(C.to_rows(cells, SPEC, ["a"], tie=["seq"])) == [(3,)]
    assert [r["value"] for r in C.last_versions(cells, ["k"], 1, ["seq"]).collect()] == ["3"]
    assert rows(C.to_rows(cells, SPEC, ["a"], merge_to_latest=False, tie=["seq"])) == [(3,)]


def test_flatten_gives_a_row_per_timestamp(versions):
    flat = C.flatten_versions(versions, SPEC, ["k", "a", "b"], max_versions=10, keep_ts=True)
    assert rows(flat) == [("x", 10, None, 1), ("x", 20, "two", 2), ("x", 50, None, 5)]


def test_flatten_default_drops_times_and_equal_rows(spark):
    cells = make(spark, [("x", "f", "a", t, "1") for t in (1, 2, 3)])
    assert rows(C.flatten_versions(cells, SPEC, ["k", "a"], max_versions=10)) == [("x", 1)]


def test_flatten_sees_one_version_by_default(versions):
    assert rows(C.flatten_versions(versions, SPEC, ["a", "b"], keep_ts=True)) == [(50, None, 5), (None, "two", 2)]


def test_flatten_count_matches_rows_also_for_keys_only(versions):
    flat = C.to_rows(versions, SPEC, ["k"], merge_to_latest=False, keep_ts=True, max_versions=10)
    assert flat.count() == len(rows(flat)) == 3


def test_scope_decides_which_keys_appear(spark):
    cells = make(spark, [("x", "f", "a", 1, "1"), ("y", "f", "b", 1, "s"), ("z", "h", "g", 1, "s")])
    keys = lambda scope: [r[0] for r in rows(C.to_rows(cells, SPEC, ["k", "a"], scope=scope))]
    assert keys("column") == ["x"]
    assert keys("family") == ["x", "y"]
    assert keys("none") == ["x", "y", "z"]
    assert [r[0] for r in rows(C.to_rows(cells, SPEC, ["k"]))] == ["x", "y", "z"]


def test_requested_order_and_exact_schema(versions):
    out = C.to_rows(versions, SPEC, ["b", "k", "a"])
    assert out.columns == ["b", "k", "a"]
    assert out.schema["a"].dataType.simpleString() == "int"


def test_malformed_text_is_null(spark):
    assert rows(C.to_rows(make(spark, [("x", "f", "a", 1, "no number")]), SPEC, ["k", "a"])) == [("x", None)]


def test_dynamic_map_excludes_declared_whatever_the_projection(spark):
    cells = make(spark, [("r", "f", q, 1, v) for q, v in (("a", "1"), ("b", "2"), ("x", "3"), ("y", "4"))])
    for columns in (["k", "rest"], ["k", "a", "b", "rest"], ["k", "a", "rest"]):
        (row,) = C.to_rows(cells, MAPS, columns, scope="family").collect()
        assert row["rest"] == {"x": "3", "y": "4"}


def test_dynamic_map_empty_or_null(spark):
    cells = make(spark, [("r", "f", "a", 1, "1"), ("s", "other", "q", 1, "1")])
    got = {r["k"]: r["rest"] for r in C.to_rows(cells, MAPS, ["k", "rest"], scope="none").collect()}
    assert got == {"r": {}, "s": None}


def test_dynamic_map_needs_a_wide_scope(spark, versions):
    with pytest.raises(ValueError):
        C.to_rows(versions, MAPS, ["rest"])


def test_wide_keys_are_spread_without_loss(spark):
    wide = [("w", "f", f"q{i}", 1, str(i)) for i in range(500)] + [("w", "f", "a", 1, "7")]
    cells = make(spark, wide + [("n", "f", "x", 1, "1"), ("n", "f", "b", 1, "s")])
    out = C.to_rows(cells, MAPS, scope="family", split_maps_over=100).collect()
    parts = [r for r in out if r["k"] == "w"]
    assert len(parts) == 5 and sum(len(r["rest"]) for r in parts) == 500
    assert {k: v for r in parts for k, v in r["rest"].items()} == {f"q{i}": str(i) for i in range(500)}
    assert [r["a"] for r in parts if r["map_part"] == 0] == [7]
    (narrow,) = [r for r in out if r["k"] == "n"]
    assert (narrow["rest"], narrow["b"], narrow["map_part"]) == ({"x": "1"}, "s", 0)


def test_series_and_history_maps(spark, versions):
    spec = {"key": [("k", "string")], "columns": {
        "a": {"cf": "f", "col": "a", "type": "map<bigint,int>"},
        "all": {"cf": "f", "col": "", "type": "map<string,map<bigint,string>>"},
    }}
    (row,) = C.to_rows(versions, spec, scope="family", max_versions=2).collect()
    assert row["a"] == {5: 50, 2: 20}
    assert row["all"] == {"b": {2: "two"}}
    (row,) = C.to_rows(versions, spec, ["a"], max_versions=1).collect()
    assert row["a"] == {5: 50}
    assert rows(C.series(versions, spec, "a", max_versions=None)) == [("x", 1, 10), ("x", 2, 20), ("x", 5, 50)]


def test_unbounded_series_map_is_refused(versions):
    spec = {"key": [("k", "string")], "columns": {"a": {"cf": "f", "col": "a", "type": "map<bigint,int>"}}}
    with pytest.raises(ValueError, match="max_versions"):
        C.to_rows(versions, spec, max_versions=None)


def test_repeated_timestamp_in_a_series(spark):
    spec = {"key": [("k", "string")], "columns": {"a": {"cf": "f", "col": "a", "type": "map<bigint,int>"}}}
    cells = make(spark, [("x", "f", "a", 1, "3"), ("x", "f", "a", 1, "9")])
    assert C.to_rows(cells, spec, max_versions=5).collect()[0]["a"] == {1: 9}


def test_pattern_columns(spark):
    spec = {"key": [("k", "string")], "columns": {
        "p": {"cf": "f", "regex": "phone_(.*)", "type": "map<string,string>"}}}
    cells = make(spark, [("x", "f", "phone_home", 1, "1"), ("x", "f", "phone_work", 1, "2"), ("x", "f", "fax", 1, "3")])
    assert C.to_rows(cells, spec, scope="family").collect()[0]["p"] == {"home": "1", "work": "2"}


def test_pattern_with_repeated_capture(spark):
    spec = {"key": [("k", "string")], "columns": {
        "p": {"cf": "f", "regex": "(.).*", "type": "map<string,string>"}}}
    cells = make(spark, [("x", "f", q, 1, q.upper()) for q in ("ab", "ac", "aa", "b")])
    assert C.to_rows(cells, spec, scope="family").collect()[0]["p"] == {"a": "AC", "b": "B"}


@pytest.mark.parametrize("bad", [
    {"timestamp": 1, "min_ts": 0}, {"timestamp": 1, "min_ts": 0, "max_ts": 2}, {"min_ts": 1}, {"max_ts": 1},
])
def test_time_options_are_exclusive(versions, bad):
    with pytest.raises(ValueError):
        C.to_rows(versions, SPEC, **bad)


def test_own_decoder(versions):
    out = C.to_rows(versions, SPEC, ["k", "a"], decoders={"a": lambda c: F.concat(F.lit("<"), c, F.lit(">"))})
    assert rows(out) == [("x", "<50>")]


def test_spec_checks():
    with pytest.raises(ValueError):
        cell_spec({"key": [], "columns": {}})
    assert isinstance(cell_spec(CellSpec((), ())), CellSpec)


def test_spec_schema(spark):
    spec = cell_spec(MAPS)
    assert spec.schema.simpleString() == "struct<k:string,a:int,b:string,rest:map<string,string>>"
    assert spec.families == ["f"] and spec.declared("f") == ["a", "b"]
    with pytest.raises(ValueError):
        cell_spec({"key": [("k", "string")], "columns": {"d": {"cf": "f", "col": "", "type": "int"}}})


# --- writing ----------------------------------------------------------------

ALL_TYPES = {
    "key": [("k", "string"), ("n", "bigint")],
    "columns": {
        name: {"cf": "f", "col": name, "type": kind}
        for name, kind in {
            "bo": "boolean", "by": "tinyint", "sh": "smallint", "it": "int", "bi": "bigint", "fl": "float",
            "do": "double", "st": "string", "bn": "binary", "de": "decimal(12,3)", "ti": "timestamp",
            "re": "struct<a:int,b:string>", "ar": "array<int>",
        }.items()
    },
}


def test_round_trip_of_all_types(spark):
    df = spark.sql("""
      SELECT 'x' AS k, 1L AS n, true AS bo, -128Y AS by, 7S AS sh, -5 AS it, 1234567890123L AS bi, float(0.1) AS fl,
             1e-300D AS do, 'text, "quoted"' AS st, X'00FF10' AS bn, cast(1.500 AS decimal(12,3)) AS de,
             timestamp'2024-01-02 03:04:05.678' AS ti, named_struct('a', 1, 'b', 'z') AS re, array(1, 2) AS ar
      UNION ALL
      SELECT 'y', 2L, false, 0Y, null, null, null, float('inf'), -0.5D, '', null, null, null, null, array()""")
    back = C.to_rows(C.to_cells(df, ALL_TYPES, ts=9), ALL_TYPES)
    assert back.columns == df.columns
    assert rows(back) == rows(df)


def test_null_makes_no_cell_and_keeps_the_old_value(spark):
    old = C.to_cells(spark.createDataFrame([("x", 1, "s", "t")], "k string, a int, b string, g string"), SPEC, ts=1)
    new = C.to_cells(spark.createDataFrame([("x", None, "n", None)], "k string, a int, b string, g string"), SPEC, ts=2)
    assert new.count() == 1
    assert rows(C.to_rows(old.unionByName(new), SPEC)) == [("x", 1, "n", "t")]


def test_null_maps_and_map_values_make_no_cells(spark):
    spec = {"key": [("k", "string")], "columns": {
        "s": {"cf": "f", "col": "s", "type": "map<bigint,int>"},
        "d": {"cf": "f", "col": "", "type": "map<string,string>"},
        "h": {"cf": "h", "col": "", "type": "map<string,map<bigint,int>>"},
    }}
    df = spark.createDataFrame(
        [("x", {1: 5, 2: None}, {"q": "v", "r": None}, {"m": {3: 4, 4: None}, "n": None}), ("y", None, None, None)],
        "k string, s map<bigint,int>, d map<string,string>, h map<string,map<bigint,int>>",
    )
    assert rows(C.to_cells(df, spec, ts=7)) == [
        ("x", "f", "q", 7, "v"), ("x", "f", "s", 1, "5"), ("x", "h", "m", 3, "4"),
    ]


def test_one_clock_value_per_write(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("k"), F.col("id").cast("int").alias("a"))
    assert C.to_cells(df, SPEC).select("ts").distinct().count() == 1


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(
    st.tuples(st.text("abc", min_size=1, max_size=2), st.sampled_from(["a", "b", "x"]), st.integers(1, 5),
              st.integers(0, 99)), min_size=1, max_size=25, unique_by=lambda t: t[:3]))
def test_views_match_a_plain_model(spark, data):
    cells = make(spark, [(k, "f", q, t, str(v)) for k, q, t, v in data])
    model = {}
    for k, q, t, v in data:
        model.setdefault(k, {}).setdefault(q, {})[t] = v
    newest = lambda vs: vs[max(vs)] if vs else None
    merged = {r["k"]: (r["a"], r["b"]) for r in C.to_rows(cells, SPEC, ["k", "a", "b"], scope="none").collect()}
    assert merged == {
        k: (newest(m.get("a")), None if newest(m.get("b")) is None else str(newest(m["b"]))) for k, m in model.items()
    }
    flat = {(r["k"], r["ts"]): r["a"] for r in
            C.flatten_versions(cells, SPEC, ["k", "a"], max_versions=99, keep_ts=True).collect()}
    assert flat == {(k, t): v for k, m in model.items() for t, v in m.get("a", {}).items()}


# --- structure --------------------------------------------------------------

def test_discover_schema(spark):
    cells = make(spark, [
        ("x", "f", "flag", 1, "true"), ("x", "f", "flag", 2, "false"), ("x", "f", "n", 1, "-12"), ("y", "f", "n", 1, "7"),
        ("x", "f", "d", 1, "1e5"), ("y", "f", "d", 1, "3"), ("x", "h", "t", 1, "12a"),
    ])
    assert rows(C.discover_schema(cells, ["k"])) == [
        ("f", "d", 2, 2, "double"), ("f", "flag", 2, 1, "boolean"), ("f", "n", 2, 2, "bigint"), ("h", "t", 1, 1, "string"),
    ]
    assert rows(C.families(cells)) == [("f",), ("h",)]
    assert C.count_rows(cells, SPEC).collect()[0]["rows"] == 2


def test_repeated_timestamps_are_one_version(spark):
    cells = spark.createDataFrame(
        [("k", "f", "q", t, v) for t, v in ((3, "a"), (3, "b"), (2, "c"), (1, "d"), (0, "e"))],
        "k string, cf string, qualifier string, ts bigint, value string",
    )
    want = [(3, "b"), (2, "c"), (1, "d")]
    got = C.last_versions(cells, ["k"], 3)
    assert sorted((r["ts"], r["value"]) for r in got.collect()) == sorted(want)
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2")
    try:
        got = C.last_versions(cells, ["k"], 3)
        assert sorted((r["ts"], r["value"]) for r in got.collect()) == sorted(want)
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")


def test_keys_come_in_the_types_of_the_spec(spark):
    cells = spark.createDataFrame([("7", "f", "a", 1, "x")], "k string, cf string, qualifier string, ts bigint, value string")
    spec = {"key": [("k", "bigint")], "columns": {"a": {"cf": "f", "col": "a", "type": "string"}}}
    assert C.to_rows(cells, spec).schema.simpleString() == "struct<k:bigint,a:string>"
    assert C.to_rows(cells, spec, merge_to_latest=False).schema["k"].dataType.simpleString() == "bigint"


def test_a_hot_cell_is_ranked_in_slices_where_partitions_are_many(spark, monkeypatch):
    cells = spark.range(5000).select(F.lit("k").alias("k"), F.lit("f").alias("cf"), F.lit("q").alias("qualifier"), F.col("id").alias("ts"), F.col("id").cast("string").alias("value")).repartition(7)
    plain = rows(C.last_versions(cells, ["k"], 3))
    monkeypatch.setattr(C, "ROWS_OF_A_CELL", 10)
    assert C._slices(cells, 3) and rows(C.last_versions(cells, ["k"], 3)) == plain == [("k", "f", "q", t, str(t)) for t in (4997, 4998, 4999)]


def test_types_that_cells_can_be_taken_for(spark):
    values = {"b": ["true", "false", None], "i": ["1", "-5", "+7"], "d": ["1", "2.5", "1e9"], "big": ["1", "99999999999999999999"], "s": ["true", "1"], "t": ["", "1"], "none": [None], "w": [" 1"]}
    data = [(f"k{i}", "f", q, 1, v) for q, vs in values.items() for i, v in enumerate(vs)] + [("k0", "f", "i", 2, "3"), (None, "f", "i", 2, "3")]
    found = C.discover_schema(spark.createDataFrame(data, "k string, cf string, qualifier string, ts bigint, value string"), ["k"])
    assert {r.qualifier: (r.cells, r.rows, r.type) for r in found.collect()} == {
        "b": (3, 3, "boolean"), "i": (5, 3, "bigint"), "d": (3, 3, "double"), "big": (2, 2, "double"), "s": (2, 2, "string"), "t": (2, 2, "string"),
        "none": (1, 1, "string"), "w": (1, 1, "string")}

"""Raw keys, raw cells, nested values and normalisation."""

import struct

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F, types as T

from tests.conftest import rows
from veil.functions.codec import from_bytes, to_bytes
from veil.functions.keys import build_key, first_dimension, key_block, split_key
from veil.functions.values import nested_text, nested_value, normalise, ntz_millis
from veil.operators import cells as C

FORMS = {"tinyint": ">b", "smallint": ">h", "int": ">i", "bigint": ">q", "float": ">f", "double": ">d"}
LAWS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def check_bytes(spark, kind, values):
    data = [(v, struct.pack(FORMS[kind], v)) for v in values]
    df = spark.createDataFrame(data, f"v {kind}, b binary")
    typed = df.schema["v"].dataType
    out = df.select("b", to_bytes(F.col("v"), typed).alias("e"), from_bytes(F.col("b"), typed).alias("d")).collect()
    for r in out:
        assert bytes(r["e"]) == bytes(r["b"])
        assert struct.pack(FORMS[kind], r["d"]) == bytes(r["b"])


@pytest.mark.parametrize("kind,bits", [("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64)])
def test_integers(spark, kind, bits):
    half = 1 << (bits - 1)
    check_bytes(spark, kind, [-half, -half + 1, -1, 0, 1, half - 1])


def test_floats_at_the_edges(spark):
    inf = float("inf")
    check_bytes(spark, "double", [0.0, -0.0, inf, -inf, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308]
                + [2.0**e for e in range(-1074, 1024)])
    check_bytes(spark, "float", [0.0, -0.0, inf, -inf] + [2.0**e for e in range(-149, 128)])


@LAWS
@given(st.lists(st.floats(allow_nan=False), min_size=1, max_size=200),
       st.lists(st.floats(allow_nan=False, width=32), min_size=1, max_size=200))
def test_any_float(spark, wide, narrow):
    check_bytes(spark, "double", wide)
    check_bytes(spark, "float", narrow)


def test_nan_and_null(spark):
    df = spark.sql("SELECT double('nan') AS d, cast(null AS double) AS n, cast(null AS boolean) AS b, true AS t, false AS f")
    r = df.select(
        from_bytes(to_bytes(F.col("d"), T.DoubleType()), T.DoubleType()).alias("d"),
        to_bytes(F.col("n"), T.DoubleType()).alias("n"), to_bytes(F.col("b"), T.BooleanType()).alias("b"),
        F.hex(to_bytes(F.col("t"), T.BooleanType())).alias("t"), F.hex(to_bytes(F.col("f"), T.BooleanType())).alias("f"),
    ).first()
    assert r["d"] != r["d"] and r["n"] is None and r["b"] is None and (r["t"], r["f"]) == ("FF", "00")


DIMS = [("a", "int"), ("f", "boolean"), ("d", "double"), ("c", "string", 3), ("s", "string")]


def test_composite_key_round_trip(spark):
    df = spark.createDataFrame(
        [(-5, True, -1.5, "abc", "déjà", 1), (2**31 - 1, False, 1e300, "x y", "", 2)],
        "a int, f boolean, d double, c string, s string, v int",
    )
    keyed = build_key(df, DIMS)
    assert keyed.columns == ["rowkey", "v"]
    assert bytes(keyed.filter("v = 1").first()["rowkey"]) == (
        struct.pack(">i", -5) + b"\xff" + struct.pack(">d", -1.5) + b"abc" + "déjà".encode()
    )
    assert rows(split_key(keyed, DIMS)) == rows(df)


def test_only_the_last_dimension_may_vary(spark):
    df = spark.createDataFrame([("a", 1)], "s string, n int")
    with pytest.raises(ValueError):
        build_key(df, [("s", "string"), ("n", "int")])


def test_wrong_length_is_an_error(spark):
    df = spark.createDataFrame([("ab", 1)], "s string, n int")
    with pytest.raises(PySparkException, match="not 3 bytes"):
        build_key(df, [("s", "string", 3), ("n", "int")]).collect()


def test_key_block(spark):
    df = spark.createDataFrame([(bytearray(b),) for b in (b"ab", b"abc", b"ac", b"a\xff", b"\xff", b"\xff\xff1")], "k binary")
    take = lambda p: sorted(bytes(r[0]) for r in df.filter(key_block(F.col("k"), p)).collect())
    assert take(b"ab") == [b"ab", b"abc"]
    assert take(b"a\xff") == [b"a\xff"]
    assert take(b"\xff") == [b"\xff", b"\xff\xff1"]


@pytest.mark.parametrize("kind,bits", [("tinyint", 8), ("int", 32), ("bigint", 64)])
def test_first_dimension_equals_typed_comparison(spark, kind, bits):
    half = 1 << (bits - 1)
    edges = sorted({-half, -half + 1, -100, -2, -1, 0, 1, 2, 100, half - 2, half - 1})
    df = spark.createDataFrame([(v, s) for v in edges for s in ("", "x", "\u00ff\u00ff")], f"n {kind}, s string")
    raw = build_key(df, [("n", kind), ("s", "string")])
    tests = [(op, v) for op in ("=", "<", ">", "<=", ">=") for v in edges]
    flags = [first_dimension(F.col("rowkey"), kind, op, v).alias(f"t{i}") for i, (op, v) in enumerate(tests)]
    out = split_key(raw.select("rowkey", *flags), [("n", kind), ("s", "string")]).collect()
    compare = {"=": int.__eq__, "<": int.__lt__, ">": int.__gt__, "<=": int.__le__, ">=": int.__ge__}
    assert len(out) == 3 * len(edges)
    for r in out:
        for i, (op, v) in enumerate(tests):
            assert bool(r[f"t{i}"]) == compare[op](r["n"], v), (op, v, r["n"])


RAW_SPEC = {
    "key": [("id", "bigint"), ("name", "string")],
    "columns": {
        "d": {"cf": "f", "col": "d", "type": "double"}, "i": {"cf": "f", "col": "i", "type": "int"},
        "s": {"cf": "f", "col": "s", "type": "string"}, "b": {"cf": "g", "col": "b", "type": "boolean"},
    },
}


def test_raw_cells_round_trip_and_direct_view(spark):
    df = spark.createDataFrame([(1, "x", 0.1, -7, "é", True), (-2, "", float("inf"), None, None, False)],
                               "id bigint, name string, d double, i int, s string, b boolean")
    cells = C.to_cells(df, RAW_SPEC, ts=3)
    raw = C.encode_cells(cells, RAW_SPEC)
    assert raw.schema.simpleString() == "struct<rowkey:binary,cf:string,qualifier:string,ts:bigint,value:binary>"
    assert rows(C.to_rows(C.decode_cells(raw, RAW_SPEC), RAW_SPEC)) == rows(df)
    # binary values are decoded by the typed view itself
    typed = C.to_rows(split_key(raw, RAW_SPEC["key"]), RAW_SPEC)
    assert rows(typed) == rows(df)


def test_nested_values(spark):
    df = spark.createDataFrame([(1, '{"k": 69, "t": ["a"]}'), (2, "broken"), (3, None)], "id int, props string")
    typed = nested_value(df, "props", "struct<k:int,t:array<string>>")
    assert typed.filter("id = 1").first()["props"].asDict() == {"k": 69, "t": ["a"]}
    assert rows(nested_text(typed, "props"))[0] == (1, '{"k":69,"t":["a"]}')


def test_normalise(spark):
    df = spark.sql("""SELECT 1Y AS a, 2 AS b, float(0.5) AS c, 1.50BD AS d, timestamp'1970-01-01 00:00:01.9999' AS e,
                      timestamp'1969-12-31 23:59:59.9999' AS g, 'x' AS h, array(1, 2) AS i,
                      named_struct('p', 1Y, 'q', 2.0BD) AS j, map('k', 1S) AS l, timestamp_ntz'1970-01-02 00:00:00' AS m""")
    out = normalise(df)
    assert out.schema.simpleString() == (
        "struct<a:bigint,b:bigint,c:double,d:string,e:bigint,g:bigint,h:string,i:array<bigint>,"
        "j:struct<p:bigint,q:string>,l:map<string,bigint>,m:bigint>"
    )
    r = out.first()
    assert (r["a"], r["c"], r["d"], r["e"], r["g"], r["m"]) == (1, 0.5, "1.50", 1999, -1, 86_400_000)


def test_zone_less_time_ignores_the_session_zone(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-03-31 02:30:00.1239' AS t")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for z in ("UTC", "Europe/Paris", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", z)
            assert df.select(ntz_millis(F.col("t"))).first()[0] == 1_711_852_200_123
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)

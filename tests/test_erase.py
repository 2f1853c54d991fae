"""Masking, deleting and auditing requested keys."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from veil.functions.requests import parse_records, parse_requests, request_counts
from veil.operators import cells as C
from veil.operators.erase import MASKS, audit, erase, mask, mask_cells, match_requests, unmatched

IBAN, STREET = MASKS["iban"], MASKS["street"]


def people(spark, data):
    return spark.createDataFrame(data, "bp string, iban string, street string, age int")


def asked(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "bp string")


@pytest.fixture(params=["broadcast", "shuffle"])
def join_kind(spark, request):
    """Every test runs with small requests and with requests taken as too large to broadcast."""
    if request.param == "shuffle":
        spark.conf.set("veil.broadcast.maxRows", "0")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield request.param
    spark.conf.unset("veil.broadcast.maxRows")
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def target(spark):
    return people(spark, [("7", "i7", "s7", 1), ("5", "i5", "s5", 2), ("5", "j5", "t5", 3), ("9", None, "s9", 4)])


def test_fixed_masks():
    assert IBAN == "FRXX 2002 XXXX 2606 XXXX YYYY 606"
    assert STREET == "XX RUE DE PARIS 750XX PARIS"


def test_all_rows_of_a_key_are_kept_and_masked(spark, target, join_kind):
    assert rows(mask(target, asked(spark, "5", "5"), "bp")) == [
        ("5", IBAN, STREET, 2), ("5", IBAN, STREET, 3), ("7", "i7", "s7", 1), ("9", None, "s9", 4),
    ]


def test_masking_twice_is_masking_once(spark, target):
    once = mask(target, asked(spark, "5", "9"), "bp")
    assert rows(mask(once, asked(spark, "5", "9"), "bp")) == rows(once)


def test_keys_are_text(spark, target, join_kind):
    for key in ("007", "7.0", "7 x", "abc", "7 OR 1=1"):
        assert rows(mask(target, asked(spark, key), "bp")) == rows(target)
    assert rows(mask(target, asked(spark, " 7 "), "bp").filter("bp = '7'")) == [("7", IBAN, STREET, 1)]


def test_numeric_key_column(spark):
    target = spark.createDataFrame([(1, "i"), (2, "j")], "bp bigint, iban string")
    out = mask(target, asked(spark, "2"), "bp", {"iban": "X"})
    assert rows(out) == [(1, "i"), (2, "X")] and out.schema == target.schema


def test_blank_and_null_requests_match_nothing(spark, join_kind):
    target = people(spark, [("", "i", "s", 1), (None, "i", "s", 2)])
    assert rows(mask(target, asked(spark, "", None, "  "), "bp")) == rows(target)
    assert rows(erase(target, asked(spark, "", None), "bp")) == rows(target)


def test_one_row_per_key_touches_requested_keys_only(spark, target, join_kind):
    more = target.unionByName(people(spark, [("7", "k7", "u7", 8)]))
    out = mask(more, asked(spark, "5"), "bp", {"iban": IBAN}, one_row_per_key=True, order=["age"])
    assert rows(out) == [("5", IBAN, "s5", 2), ("7", "i7", "s7", 1), ("7", "k7", "u7", 8), ("9", None, "s9", 4)]


def test_unknown_key_creates_a_row_only_on_demand(spark, target, join_kind):
    requests = asked(spark, "5", "404")
    assert mask(target, requests, "bp").filter("bp = '404'").count() == 0
    out = mask(target, requests, "bp", upsert_unmatched=True)
    assert rows(out.filter("bp = '404'")) == [("404", IBAN, STREET, None)] and out.count() == 5
    assert rows(unmatched(target, requests, "bp")) == [("404",)]


def test_match_requests(spark, target, join_kind):
    out = match_requests(target, asked(spark, "5", "404", "5"), "bp").select("bp", "matched", "age")
    assert rows(out) == [("404", False, None), ("5", True, 2), ("5", True, 3)]


def test_erase(spark, target, join_kind):
    assert rows(erase(target, asked(spark, "5", "404"), "bp")) == [("7", "i7", "s7", 1), ("9", None, "s9", 4)]


def test_audit_counts_but_never_shows_values(spark, target, join_kind):
    out = audit(target, asked(spark, "5", "9", "404"), "bp")
    assert out.columns == ["bp", "rows_found", "iban_found", "street_found", "age_found"]
    assert rows(out) == [("404", 0, 0, 0, 0), ("5", 2, 2, 2, 2), ("9", 1, 0, 1, 1)]


def test_wrong_columns_are_refused(spark, target):
    with pytest.raises(ValueError):
        mask(target, asked(spark, "5"), "bp", {"phone": "x"})
    with pytest.raises(ValueError):
        mask(target, asked(spark, "5"), "bp", {"bp": "x"})


def test_hot_key_equals_plain_rule(spark, join_kind):
    target = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("bp"),
        F.col("id").cast("string").alias("iban"),
    ).repartition(5)
    requests = asked(spark, "hot", "k1", "k2", "none")
    got = {r["iban"] for r in mask(target, requests, "bp", {"iban": "X"}).collect() if r["iban"] != "X"}
    assert got == {r["iban"] for r in target.collect() if r["bp"] not in ("hot", "k1", "k2")}
    assert mask(target, requests, "bp", {"iban": "X"}).count() == 6000


# --- cells ------------------------------------------------------------------

SPEC = {"key": [("bp", "string")], "columns": {
    n: {"cf": "demographics", "col": n, "type": "string"} for n in ("iban", "street", "level")}}


@pytest.fixture
def cells(spark):
    old = spark.createDataFrame([("1", "i1", "s1", "gold"), ("2", "i2", "s2", "blue")],
                                "bp string, iban string, street string, level string")
    return C.to_cells(old, SPEC, ts=1).unionByName(C.to_cells(old.filter("bp = '1'").replace("i1", "i1b"), SPEC, ts=2))


def test_mask_cells_leaves_history(spark, cells, join_kind):
    out = mask_cells(cells, asked(spark, "1"), "bp", ts=5)
    assert rows(C.to_rows(out, SPEC, ["bp", "iban", "street", "level"])) == [
        ("1", IBAN, STREET, "gold"), ("2", "i2", "s2", "blue"),
    ]
    history = C.last_versions(out, ["bp"], 9).filter("bp = '1' and qualifier = 'iban'")
    assert sorted(r["value"] for r in history.collect()) == [IBAN, "i1", "i1b"]


def test_purge_leaves_nothing_to_read_back(spark, cells, join_kind):
    out = mask_cells(cells, asked(spark, "1"), "bp", ts=5, purge_history=True)
    assert {r["value"] for r in out.filter("bp = '1' and qualifier <> 'level'").collect()} == {IBAN, STREET}
    assert rows(out.filter("bp = '2'")) == rows(cells.filter("bp = '2'"))
    assert out.filter("bp = '1' and qualifier = 'level'").count() == 2


def test_mask_cells_with_family_pairs_and_unknown_key(spark, cells):
    out = mask_cells(cells, asked(spark, "new"), "bp", ts=5, masks={("other", "phone"): "X"})
    assert rows(out.filter("bp = 'new'")) == [("new", "other", "phone", 5, "X")]


# --- request text -----------------------------------------------------------

def test_request_lines(spark):
    lines = spark.createDataFrame([("1,a",), ("",), (",",), (" 2 ",), ("3",)], "value string")
    assert rows(parse_requests(lines)) == [("1",), ("2",), ("3",)]
    assert rows(request_counts(lines)) == [(5, 2)]


def test_request_records(spark):
    lines = spark.createDataFrame([("r, gold , 5,p,c",), ("r2,blue",)], "value string")
    assert rows(parse_records(lines)) == [("r", "gold", "5", "p", "c"), ("r2", "blue", None, None, None)]

"""Physical plans: what is pushed down, what is shuffled, and what is broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from veil.functions.keys import build_key, first_dimension
from veil.operators import cells as C
from veil.operators.compare import diff
from veil.operators.erase import erase, mask
from veil.operators.intervals import interval_union
from veil.operators.lookup import first_per_key, range_lookup
from veil.plans import fixtures as X
from veil.plans.queries import QUERIES
from veil.sources import tables as S


WRITING = {
    "a2_partition_scan", "a3_request_stream", "a4_csv_snapshot", "a5_upsert_sink", "a7_create_ranges",
    "a8_rewrite_partitions", "e7_apply_to_table", "e9_stream", "e9_cell_stream",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df):
    return len(re.findall(r"\bExchange (?:hash|range|Single)", plan(df)))


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "cells")
    S.create_cells(X.event_cells(spark, sf_dir), path, 4)
    return S.read_cells(spark, path)


def test_projection_and_time_reach_the_scan(stored):
    text = plan(C.to_rows(stored, X.EVENT_SPEC, ["rowkey", "view"], min_ts=5, max_ts=9).filter("rowkey = 3"))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    for part in ("EqualTo(cf,e)", "EqualTo(qualifier,view)", "GreaterThanOrEqual(ts,5)", "LessThan(ts,9)", "EqualTo(rowkey,3)"):
        assert part in pushed


def test_value_predicates_stay_above_the_aggregation(stored):
    text = plan(C.to_rows(stored, X.EVENT_SPEC, ["rowkey", "view"]).filter("view > 10"))
    assert text.index("Filter") < text.index("Aggregate")


def test_latest_view_is_one_shuffle_and_counts_read_keys_only(stored):
    assert exchanges(C.to_rows(stored, X.EVENT_SPEC)) == 1
    assert re.search(r"ReadSchema: struct<rowkey:bigint>", plan(C.count_rows(stored, X.EVENT_SPEC)))


def test_text_cells_are_dealt_out_before_they_are_aggregated(spark, sf_dir):
    # One row group may unfold to any number of cells; no task sorts or keeps them all before the shuffle.
    cells = C.to_cells(X.clients(spark, sf_dir).coalesce(1), X.CLIENT_SPEC, ts=1)
    for df in (C.to_rows(cells, X.CLIENT_SPEC), C.to_rows(cells, X.CLIENT_SPEC, tie=("cf",)), C.discover_schema(cells, ["bp"])):
        text = plan(df)
        assert text.rindex("Aggregate(") < text.index("REBALANCE_PARTITIONS_BY_COL") < text.index("Generate")


def test_dealing_out_text_cells_sorts_nothing_however_many_partitions(spark):
    # Beyond the bypass threshold a task that unfolds a row group keeps and sorts all its cells to shuffle them.
    people = spark.range(0, 3_000, 1, 1).selectExpr("cast(id as string) bp", "if(id % 3 = 0, null, cast(id as string)) iban", "cast(id % 7 as string) level")
    cells = C.to_cells(people, X.CLIENT_SPEC, ts=1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for asked, dealt in ((5000, 200), (5, 5)):
            spark.conf.set("spark.sql.shuffle.partitions", asked)
            for df in (C.to_rows(cells, X.CLIENT_SPEC), C.to_rows(cells, X.CLIENT_SPEC, tie=("cf",)), C.discover_schema(cells, ["bp"])):
                assert re.findall(r"hashpartitioning\(_gather\S*, (\d+)\), REBALANCE_PARTITIONS_BY_COL", plan(df)) == [str(dealt)]
        spark.conf.set("spark.sql.shuffle.partitions", 201)
        out = C.to_rows(cells, X.CLIENT_SPEC, ["bp", "iban", "level"]).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(tuple(r) for r in out) == sorted((str(i), None if i % 3 == 0 else str(i), str(i % 7)) for i in range(3_000))


def test_text_cells_are_dealt_out_without_adaptive_execution(spark):
    # A rebalance hint is dropped then; the task that unfolds a row group would sort all its cells.
    people = spark.range(0, 3_000, 1, 1).selectExpr("cast(id as string) bp", "if(id % 3 = 0, null, cast(id as string)) iban", "cast(id % 7 as string) level")
    cells = C.to_cells(people, X.CLIENT_SPEC, ts=1)
    hot = spark.range(0, 20_000, 1, 1).selectExpr("if(id % 4 = 0, cast(id as string), 'hot') k", "'f' cf", "'a' qualifier", "id ts", "cast(id as string) value")
    spec = {"key": [("k", "string")], "columns": {"a": {"cf": "f", "col": "a", "type": "string"}}}
    wide = spark.range(0, 2_000, 1, 1).selectExpr("'k' k", "'f' cf", "cast(id as string) qualifier", "cast(1 as bigint) ts", "cast(id as string) value")
    wide_spec = {"key": [("k", "string")], "columns": {"all": {"cf": "f", "col": "", "type": "map<string,string>"}}}
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "201"}
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        for df in (C.to_rows(cells, X.CLIENT_SPEC), C.to_rows(cells, X.CLIENT_SPEC, tie=("cf",)), C.discover_schema(cells, ["bp"])):
            text = plan(df)
            assert re.findall(r"hashpartitioning\(_gather\S*, (\d+)\)", text) == ["200"]
            assert text.rindex("Aggregate(") < text.index("hashpartitioning(_gather") < text.index("Generate")
        one = plan(C.to_rows(cells, X.CLIENT_SPEC).filter("bp = '7'"))
        assert one.index("hashpartitioning(_gather") < one.index("= 7)")
        out = C.to_rows(cells, X.CLIENT_SPEC, ["bp", "iban", "level"]).collect()
        spread = C._gathered(hot, ["k"]).filter("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
        dealt = re.search(r"xxhash64.* AS _gather", plan(C.to_rows(wide, wide_spec, scope="none"))).group()
        parted = C._gathered(wide, ["k"], [C.TS, C.CF, C.QUALIFIER]).select(F.spark_partition_id().alias("p")).distinct().count()
        whole = C.to_rows(wide, wide_spec, scope="family").collect()
        newest = C.to_rows(hot, spec).collect()
        found = C.discover_schema(hot, ["k"]).collect()
        untimed = C.discover_schema(hot.drop("ts"), ["k"]).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(tuple(r) for r in out) == sorted((str(i), None if i % 3 == 0 else str(i), str(i % 7)) for i in range(3_000))
    assert "qualifier" in dealt and 8 <= spread <= C.SPREAD and 8 <= parted <= C.SPREAD
    assert [(r["k"], r["all"]) for r in whole] == [("k", {str(i): str(i) for i in range(2_000)})]
    assert len(newest) == 5001 and {r["k"]: r["a"] for r in newest} == {"hot": "19999"} | {str(i): str(i) for i in range(0, 20_000, 4)}
    assert [tuple(r) for r in found] == [tuple(r) for r in untimed] == [("f", "a", 20_000, 5001, "bigint")]


def test_a_hot_key_spread_over_partitions_is_one_row(spark):
    hot = spark.range(0, 20_000, 1, 16).selectExpr("if(id % 4 = 0, cast(id as string), 'hot') k", "'f' cf", "'a' qualifier", "id ts", "cast(id as string) value")
    spec = {"key": [("k", "string")], "columns": {"a": {"cf": "f", "col": "a", "type": "string"}}}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        out = C.to_rows(hot, spec).collect()
        found = C.discover_schema(hot, ["k"]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(out) == 5001 and {r["k"]: r["a"] for r in out} == {"hot": "19999"} | {str(i): str(i) for i in range(0, 20_000, 4)}
    assert [tuple(r) for r in found] == [("f", "a", 20_000, 5001, "bigint")]


def test_unique_cells_use_hash_aggregation(stored):
    text = plan(C.to_rows(stored, X.EVENT_SPEC, tie=()))
    assert "HashAggregate" in text and "SortAggregate" not in text and "Sort [" not in text


def test_newest_versions_are_pruned_before_the_shuffle(stored):
    for df in (C.last_versions(stored, ["rowkey"], 3), first_per_key(stored, "rowkey", "ts")):
        text = plan(df)
        assert text.index("Exchange") < text.rindex("WindowGroupLimit") and exchanges(df) == 1


def test_small_requests_never_shuffle_the_target(spark, sf_dir):
    accounts, requests = X.accounts(spark, sf_dir), X.requests(spark, sf_dir)
    for df in (mask(accounts, requests, "bp"), erase(accounts, requests, "bp")):
        text = plan(df)
        target = text[text.index("BroadcastHashJoin"):text.index("BroadcastExchange")]
        assert "Exchange hashpartitioning" not in target and "SortMergeJoin" not in text


def test_large_requests_are_not_broadcast(spark, sf_dir):
    spark.conf.set("veil.broadcast.maxRows", "1")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(mask(X.accounts(spark, sf_dir), X.requests(spark, sf_dir), "bp"))
        assert "Broadcast" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.unset("veil.broadcast.maxRows")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_comparison_and_interval_union_are_one_shuffle(spark, sf_dir):
    assert exchanges(diff(*X.customer_copies(spark, sf_dir), ["c_custkey"])) == 1
    assert exchanges(interval_union(X.event_days(spark, sf_dir), ["rowkey"])) == 1


def test_range_lookup_is_an_equality_join_with_outer_bounds_pushed(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders")
    ranges = orders.filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_custkey").alias("lo"), (F.col("o_custkey") + 1).alias("hi"))
    text = plan(range_lookup(orders, ranges, "o_custkey"))
    assert "NestedLoop" not in text and "Cartesian" not in text
    assert "GreaterThanOrEqual(o_custkey," in text and "LessThan(o_custkey," in text


def test_first_dimension_reaches_the_scan(spark, sf_dir, tmp_path):
    path = str(tmp_path / "raw")
    dims = [("user_id", "bigint"), ("event_type", "string")]
    events = X.table(spark, sf_dir, "events").select("user_id", "event_type", "value")
    build_key(events, dims).write.parquet(path)
    text = plan(spark.read.parquet(path).filter(first_dimension(F.col("rowkey"), "bigint", "=", 7)))
    assert "GreaterThanOrEqual(rowkey," in text and "LessThan(rowkey," in text


def test_no_query_uses_cross_joins_or_python_workers(spark, sf_dir):
    # queries that write are read back from files: their plan shows the reading side only
    for name, query in QUERIES.items():
        if name in WRITING:
            continue
        text = plan(query(spark, sf_dir))
        for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "MapInArrow"):
            assert node not in text, (name, node)

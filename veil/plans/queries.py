"""One named query per operator, on the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from veil.functions.coders import Coder, check_round_trips
from veil.functions.codec import from_bytes
from veil.functions.keys import build_key, first_dimension, split_key
from veil.functions.requests import parse_requests, request_key, request_record
from veil.functions.values import nested_text, nested_value, normalise
from veil.operators import cells as C
from veil.operators import predicates as P
from veil.operators.compare import diff, diff_by_digest
from veil.operators.erase import audit, erase, mask, mask_cells, match_requests
from veil.operators.intervals import interval_intersect, interval_union
from veil.operators.lookup import difference, first_per_key, in_key_order, lookup, preview, range_lookup, together
from veil.plans import fixtures as X
from veil.runtime import work_dir
from veil.sources import partitions as PT, request_log as L, tables as S, writes as W
from veil.streaming.erasure import request_stream, run_cell_stream, run_log_stream, run_stream
from veil.streaming.lifecycle import read_lives, run_lifecycle_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# One week and one day inside the event table, in epoch milliseconds.
WEEK = (1_704_672_000_000, 1_705_276_800_000)
SHIP_DAY = 842_572_800_000

SERIES_SPEC = {
    "key": [("rowkey", "bigint")],
    "columns": {"purchase": {"cf": "e", "col": "purchase", "type": "map<bigint,double>"}},
}
DYNAMIC_SPEC = {
    "key": [("rowkey", "bigint")],
    "columns": {
        "view": {"cf": "e", "col": "view", "type": "double"},
        "other": {"cf": "e", "col": "", "type": "map<string,double>"},
    },
}
HISTORY_SPEC = {
    "key": [("rowkey", "bigint")],
    "columns": {"all": {"cf": "e", "col": "", "type": "map<string,map<bigint,double>>"}},
}
PATTERN_SPEC = {
    "key": [("rowkey", "bigint")],
    "columns": {"initial": {"cf": "e", "regex": "([a-z]).*", "type": "map<string,double>"}},
}
COMPOSITE = [("user_id", "bigint"), ("event_type", "string")]


T_OF = {8: T.LongType(), 4: T.IntegerType(), 2: T.ShortType()}


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def _clients_as_cells(spark, sf_dir, ts: int = 1):
    return C.to_cells(X.clients(spark, sf_dir), X.CLIENT_SPEC, ts=ts)


def _client_rows(spark, sf_dir, columns=None):
    return C.to_rows(_clients_as_cells(spark, sf_dir), X.CLIENT_SPEC, columns)


def _event_rows(spark, sf_dir, columns=None, **options):
    return C.to_rows(X.event_cells(spark, sf_dir), X.EVENT_SPEC, columns, **options)


def _sparse_rows(spark, sf_dir, columns=None, **options):
    """All events but the errors of every third user, so that some rows lack a cell."""
    cells = X.event_cells(spark, sf_dir).filter("qualifier <> 'error' or rowkey % 3 <> 0")
    return C.to_rows(cells, X.EVENT_SPEC, columns, **options)


# --- scans, sources, sinks --------------------------------------------------

@query
def a1_typed_scan(spark, sf_dir):
    return _event_rows(spark, sf_dir)


@query
def a2_partition_scan(spark, sf_dir):
    path = work_dir(spark, "accounts")
    X.accounts(spark, sf_dir).hint("rebalance", "level").write.partitionBy("level").parquet(path)
    return S.read_table(spark, path, level="1-URGENT")


@query
def a3_request_stream(spark, sf_dir):
    base = work_dir(spark, "requests")
    X.request_lines(spark, sf_dir).write.text(f"{base}/in")
    stream = parse_requests(request_stream(spark, f"{base}/in"))
    run = (
        stream.writeStream.format("parquet").option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/progress").trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return spark.read.parquet(f"{base}/out")


@query
def a4_csv_snapshot(spark, sf_dir):
    path = work_dir(spark, "snapshot")
    masked = mask(X.clients(spark, sf_dir), X.requests(spark, sf_dir), "bp")
    S.export_csv(masked, path)
    return S.read_csv(spark, path, masked.schema)


@query
def a5_upsert_sink(spark, sf_dir):
    path = work_dir(spark, "cells")
    S.append_cells(_clients_as_cells(spark, sf_dir, ts=1), path)
    moved = X.clients(spark, sf_dir).filter(F.col("gender") == "F").select("bp", F.lit("MOVED").alias("street"))
    S.append_cells(C.to_cells(moved, X.CLIENT_SPEC, ts=2), path)
    return C.to_rows(S.read_cells(spark, path), X.CLIENT_SPEC)


@query
def a5_same_ts(spark, sf_dir):
    """Two writes of one timestamp: the later one counts, though its values are the smaller ones."""
    path = work_dir(spark, "writes")
    W.append_write(_clients_as_cells(spark, sf_dir, ts=1), path)
    moved = X.clients(spark, sf_dir).filter(F.col("gender") == "F").select("bp", F.lit("- MOVED").alias("street"))
    W.append_write(C.to_cells(moved, X.CLIENT_SPEC, ts=1), path)
    return C.to_rows(W.read_writes(spark, path), X.CLIENT_SPEC, tie=(W.WRITE,))


@query
def a6_one_timestamp(spark, sf_dir):
    return _clients_as_cells(spark, sf_dir, ts=123)


@query
def a7_create_ranges(spark, sf_dir):
    path = work_dir(spark, "ranges")
    S.create_cells(X.event_cells(spark, sf_dir), path, 8)
    return S.read_cells(spark, path)


@query
def a7_compact_writes(spark, sf_dir):
    """Events in five appends, one of them repeated with other values, merged into key ranges."""
    path = work_dir(spark, "writes")
    cells = X.event_cells(spark, sf_dir)
    for i in range(5):
        W.append_write(cells.filter(F.pmod("rowkey", F.lit(5)) == i).withColumn("value", F.col("value") + i % 2), path)
    W.append_write(cells.filter(F.pmod("rowkey", F.lit(5)) == 3), path)
    W.compact_writes(spark, path, ["rowkey"], 4, last=3)
    W.compact_writes(spark, path, ["rowkey"], 8)
    W.vacuum(spark, path)
    return C.last_versions(W.read_writes(spark, path).drop(W.WRITE), ["rowkey"])


@query
def a8_rewrite_partitions(spark, sf_dir):
    path = work_dir(spark, "accounts")
    accounts = X.accounts(spark, sf_dir)
    accounts.hint("rebalance", "level").write.partitionBy("level").parquet(path)
    urgent = accounts.filter(F.col("level") == "1-URGENT").withColumn("street", F.lit("MOVED"))
    S.rewrite_partitions(urgent, path, ["level"])
    return S.read_table(spark, path)


@query
def a9_preview(spark, sf_dir):
    return preview(X.accounts(spark, sf_dir), 10, "bp")


@query
def a10_columns(spark, sf_dir):
    return S.describe_columns(X.clients(spark, sf_dir))


@query
def a11_discover_schema(spark, sf_dir):
    return C.discover_schema(_clients_as_cells(spark, sf_dir), ["bp"])


# --- projections and predicates ---------------------------------------------

@query
def p1_projection(spark, sf_dir):
    return _event_rows(spark, sf_dir, ["purchase", "rowkey", "view"])


@query
def p2_scope(spark, sf_dir):
    return together(*[
        _sparse_rows(spark, sf_dir, ["rowkey", "error"], scope=scope).withColumn("scope", F.lit(scope))
        for scope in ("column", "family", "none")
    ])


@query
def p3_equals(spark, sf_dir):
    rows = _client_rows(spark, sf_dir)
    return together(
        rows.filter(F.col("bp") == "7").withColumn("test", F.lit("key")),
        rows.filter(F.col("level") == "BUILDING").withColumn("test", F.lit("value")),
    )


@query
def p4_not_equals(spark, sf_dir):
    return _client_rows(spark, sf_dir).filter(F.col("level") != "BUILDING")


@query
def p5_less(spark, sf_dir):
    return _event_rows(spark, sf_dir).filter((F.col("view") < 60) & (F.col("click") <= 80) & ~(F.col("error") >= 100))


@query
def p6_greater(spark, sf_dir):
    return _event_rows(spark, sf_dir).filter((F.col("view") > 10) & (F.col("click") >= 5) & ~(F.col("error") <= 5))


@query
def p7_and(spark, sf_dir):
    return _client_rows(spark, sf_dir).filter((F.col("gender") == "F") & (F.col("age") > 40))


@query
def p8_or(spark, sf_dir):
    return _client_rows(spark, sf_dir).filter((F.col("bp") == "7") | (F.col("level") == "FURNITURE"))


@query
def p9_not(spark, sf_dir):
    rows = _client_rows(spark, sf_dir)
    female, old, building = F.col("gender") == "F", F.col("age") > 40, F.col("level") == "BUILDING"
    return rows.filter(~(female & old) & ~(building | (F.col("pdl") < 5)))


@query
def p10_in(spark, sf_dir):
    return _client_rows(spark, sf_dir).filter(P.in_list("level", ["BUILDING", "FURNITURE"]))


@query
def p11_not_in(spark, sf_dir):
    return _client_rows(spark, sf_dir).filter(P.not_in_list("level", ["BUILDING", "FURNITURE"]))


@query
def p12_in_and_not_in(spark, sf_dir):
    keep = P.in_but_not_in("level", ["BUILDING", "FURNITURE", "MACHINERY"], ["FURNITURE", "HOUSEHOLD"])
    return _client_rows(spark, sf_dir).filter(keep)


@query
def p13_starts_with(spark, sf_dir):
    rows = _client_rows(spark, sf_dir)
    return rows.filter(P.starts_with("bp", "1") & P.starts_with("level", "B"))


@query
def p14_ends_with(spark, sf_dir):
    return _client_rows(spark, sf_dir).filter(P.ends_with("custid", "7"))


@query
def p15_contains(spark, sf_dir):
    rows = _client_rows(spark, sf_dir)
    return rows.filter(P.contains("iban", "12") | P.contains("level", "hold", ci=True))


@query
def p16_not_contains(spark, sf_dir):
    return _client_rows(spark, sf_dir).filter(P.not_contains("iban", "1"))


@query
def p17_first_dimension(spark, sf_dir):
    raw = build_key(X.table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value"), COMPOSITE)
    key = F.col("rowkey")
    asked = [first_dimension(key, "bigint", op, v) for op, v in (("=", 7), ("<", 3), (">", 12))]
    return split_key(raw.filter(asked[0] | asked[1] | asked[2]), COMPOSITE)


@query
def p18_field_list(spark, sf_dir):
    return P.select_fields(X.clients(spark, sf_dir), "custid,gender,,age,level,")


@query
def p19_other_predicates(spark, sf_dir):
    rows = _sparse_rows(spark, sf_dir)
    return rows.filter(F.col("error").isNull() | F.col("view").eqNullSafe(F.col("click")))


# --- joins and lookups ------------------------------------------------------

@query
def j1_lookup(spark, sf_dir):
    asked = X.table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("rowkey"))
    return lookup(X.event_cells(spark, sf_dir), asked, "rowkey")


@query
def j2_range_lookup(spark, sf_dir):
    ranges = X.table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(
        (F.col("c_custkey") - 1).alias("lo"), (F.col("c_custkey") + 2).alias("hi")
    )
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return range_lookup(orders, ranges, "o_custkey")


@query
def j2_wide_range(spark, sf_dir):
    """Narrow ranges of text keys that share a long prefix, and one that covers a third of the axis."""
    name = F.concat(F.lit("customer-of-the-house-"), F.lpad(F.col("c_custkey").cast("string"), 9, "0"))
    key = F.concat(F.lit("customer-of-the-house-"), F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    customers = X.table(spark, sf_dir, "customer")
    narrow = customers.filter("c_acctbal < 0").select(name.alias("lo"), F.concat(name, F.lit("~")).alias("hi"))
    wide = customers.agg(F.max("c_custkey").alias("n")).select(
        F.concat(F.lit("customer-of-the-house-"), F.lpad(F.floor(F.col("n") / 3).cast("string"), 9, "0")).alias("lo"),
        F.concat(F.lit("customer-of-the-house-"), F.lpad(F.floor(F.col("n") * 2 / 3).cast("string"), 9, "0")).alias("hi"),
    )
    orders = X.table(spark, sf_dir, "orders").select("o_orderkey", key.alias("client"))
    return range_lookup(orders, narrow.unionByName(wide), "client")


@query
def j3_match_requests(spark, sf_dir):
    return match_requests(X.accounts(spark, sf_dir), X.requests_with_unknown(spark, sf_dir), "bp")


@query
def j4_diff(spark, sf_dir):
    return diff(*X.customer_copies(spark, sf_dir), ["c_custkey"])


@query
def j4_diff_by_digest(spark, sf_dir):
    return diff_by_digest(*X.customer_copies(spark, sf_dir), ["c_custkey"], ranges=64)


# --- aggregation and distinct -----------------------------------------------

@query
def g1_count_rows(spark, sf_dir):
    return C.count_rows(X.line_cells(spark, sf_dir), X.EVENT_SPEC)


@query
def g2_distinct_flatten(spark, sf_dir):
    return C.flatten_versions(X.event_cells(spark, sf_dir), X.EVENT_SPEC, ["rowkey", "view", "click"], max_versions=5)


@query
def g3_families(spark, sf_dir):
    return C.families(X.line_cells(spark, sf_dir))


@query
def g4_latest_value(spark, sf_dir):
    return C.last_versions(X.line_cells(spark, sf_dir), ["rowkey"])


# --- versions and time ------------------------------------------------------

@query
def v1_at(spark, sf_dir):
    return C.at(X.line_cells(spark, sf_dir), SHIP_DAY)


@query
def v2_between(spark, sf_dir):
    return C.between(X.event_cells(spark, sf_dir), *WEEK)


@query
def v3_last_versions(spark, sf_dir):
    return C.last_versions(X.event_cells(spark, sf_dir), ["rowkey"], 3)


@query
def v4_merge_latest(spark, sf_dir):
    return _event_rows(spark, sf_dir, max_versions=3)


@query
def v5_flatten(spark, sf_dir):
    return _event_rows(spark, sf_dir, max_versions=3, merge_to_latest=False, keep_ts=True)


@query
def v6_series(spark, sf_dir):
    rows = C.to_rows(X.event_cells(spark, sf_dir), SERIES_SPEC, max_versions=3)
    return rows.select("rowkey", F.explode("purchase").alias("ts", "value"))


@query
def v7_dynamic(spark, sf_dir):
    rows = C.to_rows(X.event_cells(spark, sf_dir), DYNAMIC_SPEC, scope="family", split_maps_over=100_000)
    return rows.select("rowkey", "view", F.explode("other").alias("name", "value"))


@query
def v8_dynamic_history(spark, sf_dir):
    rows = C.to_rows(X.event_cells(spark, sf_dir), HISTORY_SPEC, scope="family", max_versions=3)
    named = rows.select("rowkey", F.explode("all").alias("name", "versions"))
    return named.select("rowkey", "name", F.explode("versions").alias("ts", "value"))


@query
def v8_map_parts(spark, sf_dir):
    rows = C.map_parts(X.event_cells(spark, sf_dir), HISTORY_SPEC, "all", entries=1000, max_versions=3)
    named = rows.select("rowkey", F.explode("all").alias("name", "versions"))
    return named.select("rowkey", "name", F.explode("versions").alias("ts", "value"))


@query
def v9_write_parts(spark, sf_dir):
    rows = C.map_parts(X.event_cells(spark, sf_dir), HISTORY_SPEC, "all", entries=1000, max_versions=2)
    return C.to_cells(rows, HISTORY_SPEC, ts=0, stored="double")


@query
def v9_write_maps(spark, sf_dir):
    rows = C.to_rows(X.event_cells(spark, sf_dir), HISTORY_SPEC, scope="family", max_versions=2)
    return C.to_cells(rows, HISTORY_SPEC, ts=0, stored="double")


@query
def v11_pattern_parts(spark, sf_dir):
    rows = C.map_parts(X.event_cells(spark, sf_dir), PATTERN_SPEC, "initial", entries=1000)
    return rows.select("rowkey", F.explode("initial").alias("name", "value"))


@query
def v10_time_options(spark, sf_dir):
    cells = X.line_cells(spark, sf_dir)
    options = {
        "all": {}, "one": {"timestamp": SHIP_DAY}, "range": {"min_ts": SHIP_DAY, "max_ts": SHIP_DAY + 30 * X.DAY},
    }
    return together(*[
        C.in_time(cells, **o).agg(F.count(F.lit(1)).alias("cells")).withColumn("option", F.lit(name))
        for name, o in options.items()
    ])


@query
def v11_pattern(spark, sf_dir):
    rows = C.to_rows(X.event_cells(spark, sf_dir), PATTERN_SPEC, scope="family")
    return rows.select("rowkey", F.explode("initial").alias("name", "value"))


# --- order and limits -------------------------------------------------------

@query
def o1_key_order(spark, sf_dir):
    return in_key_order(X.event_cells(spark, sf_dir), "rowkey")


@query
def o2_first_per_key(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    first = first_per_key(orders, "o_custkey", "o_orderdate", "o_orderkey")
    return first.select("o_custkey", "o_orderkey", "o_totalprice")


@query
def o3_top_versions(spark, sf_dir):
    return C.last_versions(X.line_cells(spark, sf_dir), ["rowkey"], 2)


# --- sets -------------------------------------------------------------------

@query
def u1_together(spark, sf_dir):
    cells = X.event_cells(spark, sf_dir)
    return together(range_lookup(cells, [(3, 8), (10, 12)], "rowkey"), lookup(cells, [1, 13], "rowkey"))


@query
def u2_difference(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders")
    urgent, low = (
        orders.filter(F.col("o_orderpriority") == p).select(F.col("o_custkey").alias("custkey"))
        for p in ("1-URGENT", "5-LOW")
    )
    return difference(urgent, low)


@query
def i1_interval_intersect(spark, sf_dir):
    return interval_intersect(X.event_days(spark, sf_dir, "view"), X.event_days(spark, sf_dir, "click"), ["rowkey"])


@query
def i2_interval_union(spark, sf_dir):
    return interval_union(X.event_days(spark, sf_dir), ["rowkey"])


# --- keys and values --------------------------------------------------------

@query
def k1_build_key(spark, sf_dir):
    events = X.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return build_key(events, COMPOSITE).withColumn("rowkey", F.hex("rowkey"))


@query
def k2_split_key(spark, sf_dir):
    events = X.table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return split_key(build_key(events, COMPOSITE), COMPOSITE)


@query
def k3_decode_cells(spark, sf_dir):
    raw = C.encode_cells(X.event_cells(spark, sf_dir), X.EVENT_SPEC)
    return C.decode_cells(raw, X.EVENT_SPEC).withColumn("value", F.col("value").cast("double"))


@query
def k3_bad_lengths(spark, sf_dir):
    """Event numbers stored in 8, 4 and 2 bytes, read as bigint, int and smallint: short values are null, long ones cut."""
    digits = F.lpad(F.hex(F.col("event_id")), 16, "0")
    raw = X.table(spark, sf_dir, "events").select("event_id", *[
        F.unhex(F.substring(digits, 17 - 2 * n, 2 * n)).alias(f"b{n}") for n in (8, 4, 2)
    ])
    return raw.select("event_id", *[
        from_bytes(F.col(f"b{n}"), T_OF[w]).cast("bigint").alias(f"from_{n}_as_{w}") for n in (8, 4, 2) for w in (8, 4, 2)
    ])


@query
def k4_encode_cells(spark, sf_dir):
    raw = C.encode_cells(_clients_as_cells(spark, sf_dir), X.CLIENT_SPEC)
    return raw.select(F.hex("rowkey").alias("rowkey"), "cf", "qualifier", "ts", F.hex("value").alias("value"))


@query
def k5_nested_value(spark, sf_dir):
    events = X.table(spark, sf_dir, "events").select("event_id", "props")
    typed = nested_value(events, "props", "struct<k:int>").withColumn("k", F.col("props.k"))
    return nested_text(typed, "props")


@query
def k6_normalise(spark, sf_dir):
    orders = X.table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("int").alias("o_custkey"), F.col("o_orderdate").alias("ordered_ms"),
        F.col("o_totalprice").cast("decimal(15,2)").alias("price_text"),
    )
    return normalise(orders)


@query
def k7_parse_requests(spark, sf_dir):
    lines = X.table(spark, sf_dir, "customer").select(
        F.concat_ws(",", F.concat(F.lit(" K"), F.col("c_custkey"), F.lit(" ")), "c_mktsegment", "c_custkey",
                    "c_nationkey", "c_name").alias("value")
    )
    value = F.col("value")
    return lines.select(request_record(value).alias("r"), request_key(value).alias("key")).select("r.*", "key")


@query
def k8_own_decoder(spark, sf_dir):
    cents = {"view": lambda c: F.round(c * 100).cast("bigint")}
    return _event_rows(spark, sf_dir, ["rowkey", "view"], decoders=cents)


@query
def k8_coder_round_trip(spark, sf_dir):
    """Views stored as whole cents with a unit, by a coder of the column; read back through cells and raw cells."""
    coders = {"view": Coder(
        lambda v: F.concat(F.round(v * 100).cast("bigint").cast("string"), F.lit(" c")),
        lambda s: F.replace(s.cast("string"), F.lit(" c")).try_cast("bigint") / 100,
    )}
    rows = _event_rows(spark, sf_dir, ["rowkey", "view"]).withColumn("view", F.round("view", 2))
    check_round_trips(rows, coders)
    cells = C.to_cells(rows, X.EVENT_SPEC, ts=1, coders=coders)
    again = C.to_rows(cells, X.EVENT_SPEC, ["rowkey", "view"], decoders=coders)
    typed = C.to_cells(rows, X.EVENT_SPEC, ts=1)
    raw = C.decode_cells(C.encode_cells(typed, X.EVENT_SPEC, coders=coders), X.EVENT_SPEC, coders=coders)
    raw = raw.select("rowkey", F.col("value").cast("double").alias("raw_view"))
    return again.join(cells.select("rowkey", F.col("value").alias("stored")), "rowkey").join(raw, "rowkey")


# --- erasure ----------------------------------------------------------------

@query
def e1_mask(spark, sf_dir):
    return mask(X.clients(spark, sf_dir), X.requests(spark, sf_dir), "bp")


@query
def e2_replace(spark, sf_dir):
    masks = {"iban": "FRXX 2002 XXXX 2606 XXXX YYYY 606"}
    return mask(
        X.accounts(spark, sf_dir), X.requests(spark, sf_dir), "bp", masks, one_row_per_key=True, order=["account"]
    )


@query
def e3_upsert(spark, sf_dir):
    return mask(X.accounts(spark, sf_dir), X.requests_with_unknown(spark, sf_dir), "bp", upsert_unmatched=True)


@query
def e4_mask_cells(spark, sf_dir):
    return mask_cells(_clients_as_cells(spark, sf_dir), X.requests_with_unknown(spark, sf_dir), "bp", ts=2)


@query
def e5_purge(spark, sf_dir):
    cells = _clients_as_cells(spark, sf_dir)
    return mask_cells(cells, X.requests_with_unknown(spark, sf_dir), "bp", ts=2, purge_history=True)


@query
def e6_erase(spark, sf_dir):
    return erase(X.accounts(spark, sf_dir), X.requests(spark, sf_dir), "bp")


@query
def e7_apply_to_table(spark, sf_dir):
    path = work_dir(spark, "clients")
    S.write_bucketed(X.clients(spark, sf_dir), path, "bp", 16)
    S.apply_to_table(spark, path, X.requests(spark, sf_dir), "bp", 16)
    return S.read_table(spark, path).drop(S.BUCKET)


@query
def e7_catalog_partitions(spark, sf_dir):
    """Accounts with two partition columns of their own, as a catalog table: masked, then some deleted."""
    name = f"accounts_{work_dir(spark, 'x').rpartition('-')[2]}"
    accounts = X.accounts(spark, sf_dir).withColumn("part", (F.col("account").cast("bigint") % 3).cast("int"))
    _spread = accounts.hint("rebalance", "level", "part")
    _spread.write.partitionBy("level", "part").format("parquet").saveAsTable(name)
    asked = X.requests_with_unknown(spark, sf_dir)
    PT.erase_in_partitions(spark, name, asked, "bp", token="first")
    PT.erase_in_partitions(spark, name, asked, "bp", "delete", token="first")  # the same batch again: nothing happens
    PT.erase_in_partitions(spark, name, asked.filter(F.col("bp").endswith("7")), "bp", "delete", token="second")
    return S.read_table(spark, name).select("bp", "account", "level", "iban", "street", "part")


@query
def e8_audit(spark, sf_dir):
    return audit(X.accounts(spark, sf_dir), X.requests_with_unknown(spark, sf_dir), "bp", ["iban", "street"])


@query
def e9_stream(spark, sf_dir):
    base = work_dir(spark, "stream")
    S.write_bucketed(X.clients(spark, sf_dir), f"{base}/clients", "bp", 16)
    X.request_lines(spark, sf_dir).write.text(f"{base}/in")
    run_stream(spark, f"{base}/in", f"{base}/clients", f"{base}/checkpoint", "bp", 16, once=True).awaitTermination()
    return S.read_table(spark, f"{base}/clients").drop(S.BUCKET)


@query
def e9_cell_stream(spark, sf_dir):
    base = work_dir(spark, "cell-stream")
    S.append_cells(_clients_as_cells(spark, sf_dir), f"{base}/cells")
    X.request_lines(spark, sf_dir).write.text(f"{base}/in")
    run_cell_stream(spark, f"{base}/in", f"{base}/cells", f"{base}/checkpoint", "bp", once=True).awaitTermination()
    return C.to_rows(S.read_cells(spark, f"{base}/cells"), X.CLIENT_SPEC)


@query
def e9_log_stream(spark, sf_dir):
    """Requests in a log hold for readers of the view at once; no file of the table is rewritten."""
    base = work_dir(spark, "log-stream")
    S.write_bucketed(X.clients(spark, sf_dir), f"{base}/clients", "bp", 16)
    X.request_lines(spark, sf_dir).write.text(f"{base}/in")
    run_log_stream(spark, f"{base}/in", f"{base}/clients", f"{base}/log", f"{base}/checkpoint", "bp", once=True).awaitTermination()
    return L.logged_view(spark, f"{base}/clients", f"{base}/log", "bp").drop(S.BUCKET)


@query
def e9_log_compaction(spark, sf_dir):
    """Three batches of different kinds in a log, worked into the files together."""
    base = work_dir(spark, "log")
    S.write_bucketed(X.accounts(spark, sf_dir), f"{base}/accounts", "bp", 16)
    asked = X.requests_with_unknown(spark, sf_dir)
    L.log_batch(spark, asked, 0, f"{base}/log", "bp", "mask")
    L.log_batch(spark, asked.filter(F.col("bp").endswith("7")), 1, f"{base}/log", "bp", "delete")
    L.log_batch(spark, asked.filter(F.col("bp").endswith("77")), 2, f"{base}/log", "bp", "upsert")
    L.compact_log(spark, f"{base}/accounts", f"{base}/log", "bp", order=["account"])
    return S.read_table(spark, f"{base}/accounts").drop(S.BUCKET)


@query
def e9_upsert_stream(spark, sf_dir):
    base = work_dir(spark, "upsert-stream")
    S.write_bucketed(X.accounts(spark, sf_dir), f"{base}/accounts", "bp", 16)
    X.requests_with_unknown(spark, sf_dir).write.text(f"{base}/in")
    run_stream(spark, f"{base}/in", f"{base}/accounts", f"{base}/checkpoint", "bp", kind="upsert", once=True).awaitTermination()
    return S.read_table(spark, f"{base}/accounts").drop(S.BUCKET)


@query
def e8_lifecycle(spark, sf_dir):
    """Requests in two files, the second repeats the first: what became of them, by batch."""
    base = work_dir(spark, "lifecycle")
    S.write_bucketed(X.accounts(spark, sf_dir), f"{base}/accounts", "bp", 16)
    for _ in range(2):
        X.request_lines(spark, sf_dir).unionByName(X.requests_with_unknown(spark, sf_dir).select(F.col("bp").alias("value"))).coalesce(1).write.mode("append").text(f"{base}/in")
        run_lifecycle_stream(spark, f"{base}/in", f"{base}/accounts", f"{base}/checkpoint", "bp", once=True).awaitTermination()
    return read_lives(spark, f"{base}/checkpoint/lives")

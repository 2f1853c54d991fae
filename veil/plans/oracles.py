"""The same results as :mod:`veil.plans.queries`, in SQL for an independent engine."""

from __future__ import annotations

from veil.operators.erase import MASKS
from veil.plans.queries import SHIP_DAY, WEEK

IBAN, STREET = MASKS["iban"], MASKS["street"]
DAY = 86_400_000

CLIENTS = """clients AS (
  SELECT CAST(c_custkey AS VARCHAR) AS bp, c_name AS custid, c_mktsegment AS level, CAST(c_nationkey AS INTEGER) AS pdl,
         CAST(20 + c_custkey % 60 AS INTEGER) AS age, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         'FR' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS iban, CAST(c_custkey AS VARCHAR) || ' RUE' AS street
  FROM customer)"""
ACCOUNTS = """accounts AS (
  SELECT CAST(o_custkey AS VARCHAR) AS bp, CAST(o_orderkey AS VARCHAR) AS account, o_orderpriority AS level,
         'FR' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS iban, CAST(o_orderkey AS VARCHAR) || ' RUE' AS street
  FROM orders)"""
REQUESTS = "requests AS (SELECT CAST(c_custkey AS VARCHAR) AS bp FROM customer WHERE c_acctbal < 0)"
UNKNOWN = """asked AS (
  SELECT CAST(c_custkey AS VARCHAR) AS bp FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT 'X' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal < 0)"""
EVENT_CELLS = """cells AS (
  SELECT user_id AS rowkey, 'e' AS cf, event_type AS qualifier, epoch_us(ts) // 1000 AS ts, value FROM events)"""
SPARSE = "(qualifier <> 'error' OR rowkey % 3 <> 0)"
LINE_CELLS = """cells AS (
  SELECT l_orderkey AS rowkey, l_returnflag AS cf, l_linestatus AS qualifier, epoch_us(l_shipdate) // 1000 AS ts,
         l_extendedprice AS value FROM lineitem)"""
RANKED = """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rowkey, cf, qualifier ORDER BY ts DESC) AS rn
  FROM (SELECT rowkey, cf, qualifier, ts, max(value) AS value FROM cells GROUP BY rowkey, cf, qualifier, ts))"""

CLIENT_COLUMNS = ["custid", "level", "pdl", "age", "gender", "iban", "street"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


def _cells_of(source: str, ts: int, columns=CLIENT_COLUMNS) -> str:
    return " UNION ALL ".join(
        f"SELECT bp, 'demographics' AS cf, '{c}' AS qualifier, CAST({ts} AS BIGINT) AS ts, "
        f"CAST({c} AS VARCHAR) AS value FROM {source}"
        for c in columns
    )


def _pivot(columns, source: str = "ranked", where: str = "rn = 1", key: str = "rowkey") -> str:
    values = ", ".join(f"max(value) FILTER (WHERE qualifier = '{c}') AS {c}" for c in columns)
    return f"SELECT {key}, {values} FROM {source} WHERE {where} GROUP BY {key}"


def _events(columns=EVENT_TYPES, time: str = "true") -> str:
    wanted = ", ".join(f"'{c}'" for c in columns)
    return f"""WITH {EVENT_CELLS}, ranked AS (
      SELECT *, row_number() OVER (PARTITION BY rowkey, qualifier ORDER BY ts DESC, value DESC) AS rn
      FROM cells WHERE qualifier IN ({wanted}) AND {time}), rows_ AS ({_pivot(columns)})"""


def _clients(where: str) -> str:
    return f"WITH {CLIENTS} SELECT * FROM clients WHERE {where}"


def _in(window) -> str:
    return f"ts >= {window[0]} AND ts < {window[1]}"


def _islands(name: str, source: str) -> str:
    """Merged intervals per rowkey of a relation (rowkey, lo, hi)."""
    return f"""{name}_m AS (
      SELECT rowkey, lo, hi, max(hi) OVER (PARTITION BY rowkey ORDER BY lo, hi
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {source}),
    {name}_n AS (
      SELECT rowkey, lo, hi, sum(CASE WHEN reach IS NULL OR lo > reach THEN 1 ELSE 0 END)
             OVER (PARTITION BY rowkey ORDER BY lo, hi ROWS UNBOUNDED PRECEDING) AS piece FROM {name}_m),
    {name} AS (SELECT rowkey, min(lo) AS lo, max(hi) AS hi FROM {name}_n GROUP BY rowkey, piece)"""


def _days(name: str, where: str) -> str:
    return f"{name} AS (SELECT rowkey, ts AS lo, ts + {DAY} AS hi FROM cells WHERE {where})"


MASKED_CLIENTS = f"""WITH {CLIENTS}, {REQUESTS}
  SELECT bp, custid, level, pdl, age, gender,
         CASE WHEN bp IN (SELECT bp FROM requests) THEN '{IBAN}' ELSE iban END AS iban,
         CASE WHEN bp IN (SELECT bp FROM requests) THEN '{STREET}' ELSE street END AS street
  FROM clients"""

_FLAT_COLUMNS = ["view", "click"]

ORACLES: dict[str, str] = {
    "a1_typed_scan": f"{_events()} SELECT * FROM rows_",
    "a2_partition_scan": f"WITH {ACCOUNTS} SELECT * FROM accounts WHERE level = '1-URGENT'",
    "a3_request_stream": f"WITH {REQUESTS} SELECT bp FROM requests",
    "a4_csv_snapshot": MASKED_CLIENTS,
    "a5_upsert_sink": f"""WITH {CLIENTS}
      SELECT bp, custid, level, pdl, age, gender, iban, CASE WHEN gender = 'F' THEN 'MOVED' ELSE street END AS street
      FROM clients""",
    "a6_one_timestamp": f"WITH {CLIENTS} {_cells_of('clients', 123)}",
    "a7_create_ranges": f"WITH {EVENT_CELLS} SELECT * FROM cells",
    "a8_rewrite_partitions": f"""WITH {ACCOUNTS}
      SELECT bp, account, level, iban, CASE WHEN level = '1-URGENT' THEN 'MOVED' ELSE street END AS street
      FROM accounts""",
    "a9_preview": f"WITH {ACCOUNTS} SELECT * FROM accounts ORDER BY bp, account, level, iban, street LIMIT 10",
    "a10_columns": f"WITH {CLIENTS} " + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{'int' if c in ('pdl', 'age') else 'string'}' AS type, count({c}) AS filled
        FROM clients""" for c in ["bp", *CLIENT_COLUMNS]
    ),
    "a11_discover_schema": f"""WITH {CLIENTS}, cells AS ({_cells_of('clients', 1)})
      SELECT cf, qualifier, count(*) AS cells, count(DISTINCT bp) AS rows,
             CASE WHEN bool_and(regexp_matches(value, '^[+-]?[0-9]+$')) THEN 'bigint' ELSE 'string' END AS type
      FROM cells GROUP BY cf, qualifier""",
    "p1_projection": f"{_events(['purchase', 'view'])} SELECT * FROM rows_",
    "p2_scope": f"""WITH {EVENT_CELLS}, late AS (SELECT * FROM cells WHERE {SPARSE}), errors AS (
        SELECT rowkey, max(value) FILTER (WHERE rn = 1 AND qualifier = 'error') AS error,
               count(*) FILTER (WHERE qualifier = 'error') AS n
        FROM (SELECT *, row_number() OVER (PARTITION BY rowkey, qualifier ORDER BY ts DESC, value DESC) AS rn FROM late)
        GROUP BY rowkey)
      SELECT rowkey, error, 'column' AS scope FROM errors WHERE n > 0
      UNION ALL SELECT rowkey, error, 'family' FROM errors UNION ALL SELECT rowkey, error, 'none' FROM errors""",
    "p3_equals": f"""WITH {CLIENTS} SELECT *, 'key' AS test FROM clients WHERE bp = '7'
      UNION ALL SELECT *, 'value' AS test FROM clients WHERE level = 'BUILDING'""",
    "p4_not_equals": _clients("level <> 'BUILDING'"),
    "p5_less": f"{_events()} SELECT * FROM rows_ WHERE view < 60 AND click <= 80 AND NOT error >= 100",
    "p6_greater": f"{_events()} SELECT * FROM rows_ WHERE view > 10 AND click >= 5 AND NOT error <= 5",
    "p7_and": _clients("gender = 'F' AND age > 40"),
    "p8_or": _clients("bp = '7' OR level = 'FURNITURE'"),
    "p9_not": _clients("NOT (gender = 'F' AND age > 40) AND NOT (level = 'BUILDING' OR pdl < 5)"),
    "p10_in": _clients("level IN ('BUILDING', 'FURNITURE')"),
    "p11_not_in": _clients("level NOT IN ('BUILDING', 'FURNITURE')"),
    "p12_in_and_not_in": _clients(
        "level IN ('BUILDING', 'FURNITURE', 'MACHINERY') AND level NOT IN ('FURNITURE', 'HOUSEHOLD')"
    ),
    "p13_starts_with": _clients("bp LIKE '1%' AND level LIKE 'B%'"),
    "p14_ends_with": _clients("custid LIKE '%7'"),
    "p15_contains": _clients("iban LIKE '%12%' OR lower(level) LIKE '%hold%'"),
    "p16_not_contains": _clients("iban NOT LIKE '%1%'"),
    "p17_first_dimension": """SELECT user_id, event_type, event_id, value FROM events
      WHERE user_id = 7 OR user_id < 3 OR user_id > 12""",
    "p18_field_list": f"WITH {CLIENTS} SELECT custid, gender, age, level FROM clients",
    "p19_other_predicates": f"""{_events(time=SPARSE)}
      SELECT * FROM rows_ WHERE error IS NULL OR view IS NOT DISTINCT FROM click""",
    "j1_lookup": f"""WITH {EVENT_CELLS} SELECT * FROM cells
      WHERE rowkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "j2_range_lookup": """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
      WHERE o_custkey IN (SELECT unnest([c_custkey - 1, c_custkey, c_custkey + 1]) FROM customer WHERE c_acctbal < 0)""",
    "j3_match_requests": f"""WITH {ACCOUNTS}, {UNKNOWN}
      SELECT asked.bp, accounts.bp IS NOT NULL AS matched, account, level, iban, street
      FROM asked LEFT JOIN accounts ON asked.bp = accounts.bp""",
    "j4_diff": """WITH l AS (SELECT * FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'),
      r AS (SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN -c_acctbal ELSE c_acctbal END AS c_acctbal,
                   c_mktsegment FROM customer WHERE c_mktsegment <> 'MACHINERY'),
      lc AS (SELECT c_custkey, 'c_name' AS "column", c_name AS v FROM l
             UNION ALL SELECT c_custkey, 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM l
             UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM l),
      rc AS (SELECT c_custkey, 'c_name' AS "column", c_name AS v FROM r
             UNION ALL SELECT c_custkey, 'c_acctbal', CAST(c_acctbal AS VARCHAR) FROM r
             UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM r)
      SELECT coalesce(lc.c_custkey, rc.c_custkey) AS c_custkey, coalesce(lc."column", rc."column") AS "column",
             lc.v AS "left", rc.v AS "right",
             CASE WHEN rc.c_custkey IS NULL THEN 'only_left' WHEN lc.c_custkey IS NULL THEN 'only_right'
                  ELSE 'changed' END AS kind
      FROM lc FULL JOIN rc ON lc.c_custkey = rc.c_custkey AND lc."column" = rc."column"
      WHERE lc.v IS DISTINCT FROM rc.v""",
    "g1_count_rows": "SELECT count(DISTINCT l_orderkey) AS rows FROM lineitem",
    "g2_distinct_flatten": f"""WITH {EVENT_CELLS}, {RANKED} SELECT DISTINCT * FROM (
        SELECT rowkey, max(value) FILTER (WHERE qualifier = 'view') AS view,
               max(value) FILTER (WHERE qualifier = 'click') AS click
        FROM ranked WHERE rn <= 5 AND qualifier IN ('view', 'click') GROUP BY rowkey, ts)""",
    "g3_families": "SELECT DISTINCT l_returnflag AS cf FROM lineitem",
    "g4_latest_value": f"WITH {LINE_CELLS}, {RANKED} SELECT rowkey, cf, qualifier, ts, value FROM ranked WHERE rn = 1",
    "v1_at": f"WITH {LINE_CELLS} SELECT * FROM cells WHERE ts = {SHIP_DAY}",
    "v2_between": f"WITH {EVENT_CELLS} SELECT * FROM cells WHERE {_in(WEEK)}",
    "v3_last_versions": f"WITH {EVENT_CELLS}, {RANKED} SELECT rowkey, cf, qualifier, ts, value FROM ranked WHERE rn <= 3",
    "v4_merge_latest": f"{_events()} SELECT * FROM rows_",
    "v5_flatten": f"WITH {EVENT_CELLS}, {RANKED} " + _pivot(EVENT_TYPES, where="rn <= 3", key="rowkey, ts"),
    "v6_series": f"""WITH {EVENT_CELLS}, {RANKED}
      SELECT rowkey, ts, value FROM ranked WHERE rn <= 3 AND qualifier = 'purchase'""",
    "v7_dynamic": f"""WITH {EVENT_CELLS}, {RANKED}, latest AS (SELECT * FROM ranked WHERE rn = 1)
      SELECT o.rowkey, v.value AS view, o.qualifier AS name, o.value
      FROM latest o LEFT JOIN latest v ON v.rowkey = o.rowkey AND v.qualifier = 'view' WHERE o.qualifier <> 'view'""",
    "v8_dynamic_history": f"""WITH {EVENT_CELLS}, {RANKED}
      SELECT rowkey, qualifier AS name, ts, value FROM ranked WHERE rn <= 3""",
    "v9_write_maps": f"WITH {EVENT_CELLS}, {RANKED} SELECT rowkey, cf, qualifier, ts, value FROM ranked WHERE rn <= 2",
    "v10_time_options": f"""WITH {LINE_CELLS} SELECT count(*) AS cells, 'all' AS "option" FROM cells
      UNION ALL SELECT count(*), 'one' FROM cells WHERE ts = {SHIP_DAY}
      UNION ALL SELECT count(*), 'range' FROM cells WHERE ts >= {SHIP_DAY} AND ts < {SHIP_DAY + 30 * DAY}""",
    "v11_pattern": f"""WITH {EVENT_CELLS}, {RANKED}
      SELECT rowkey, substr(qualifier, 1, 1) AS name, value FROM ranked WHERE rn = 1""",
    "o1_key_order": f"WITH {EVENT_CELLS} SELECT * FROM cells ORDER BY rowkey",
    "o2_first_per_key": """SELECT o_custkey, o_orderkey, o_totalprice FROM (
      SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
      WHERE rn = 1""",
    "o3_top_versions": f"WITH {LINE_CELLS}, {RANKED} SELECT rowkey, cf, qualifier, ts, value FROM ranked WHERE rn <= 2",
    "u1_together": f"""WITH {EVENT_CELLS} SELECT * FROM cells
      WHERE (rowkey >= 3 AND rowkey < 8) OR (rowkey >= 10 AND rowkey < 12) OR rowkey IN (1, 13)""",
    "u2_difference": """SELECT o_custkey AS custkey FROM orders WHERE o_orderpriority = '1-URGENT'
      EXCEPT SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW'""",
    "i1_interval_intersect": f"""WITH {EVENT_CELLS}, {_days('dv', "qualifier = 'view'")},
      {_days('dc', "qualifier = 'click'")}, {_islands('v', 'dv')}, {_islands('c', 'dc')}
      SELECT v.rowkey, greatest(v.lo, c.lo) AS lo, least(v.hi, c.hi) AS hi
      FROM v JOIN c ON v.rowkey = c.rowkey AND v.lo < c.hi AND c.lo < v.hi""",
    "i2_interval_union": f"WITH {EVENT_CELLS}, {_days('d', 'true')}, {_islands('u', 'd')} SELECT * FROM u",
    "k1_build_key": """SELECT event_id, printf('%016X', user_id) || hex(event_type) AS rowkey FROM events""",
    "k2_split_key": "SELECT event_id, user_id, event_type FROM events",
    "k3_decode_cells": f"WITH {EVENT_CELLS} SELECT * FROM cells",
    "k4_encode_cells": f"""WITH {CLIENTS}, cells AS ({_cells_of('clients', 1)})
      SELECT hex(bp) AS rowkey, cf, qualifier, ts, CASE WHEN qualifier IN ('pdl', 'age')
             THEN printf('%08X', CAST(CASE WHEN qualifier IN ('pdl', 'age') THEN value ELSE '0' END AS INTEGER))
             ELSE hex(value) END AS value FROM cells""",
    "k5_nested_value": """SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS k,
      '{"k":' || (props->>'$.k') || '}' AS props FROM events""",
    "k6_normalise": """SELECT o_orderkey, o_custkey, epoch_us(o_orderdate) // 1000 AS ordered_ms,
      CAST(CAST(o_totalprice AS DECIMAL(15, 2)) AS VARCHAR) AS price_text FROM orders""",
    "k7_parse_requests": """SELECT 'K' || CAST(c_custkey AS VARCHAR) AS rowkey, c_mktsegment AS level,
      CAST(c_custkey AS VARCHAR) AS bp, CAST(c_nationkey AS VARCHAR) AS pdl, c_name AS custid,
      'K' || CAST(c_custkey AS VARCHAR) AS key FROM customer""",
    "k8_own_decoder": f"{_events(['view'])} SELECT rowkey, CAST(round(view * 100) AS BIGINT) AS view FROM rows_",
    "e1_mask": MASKED_CLIENTS,
    "e2_replace": f"""WITH {ACCOUNTS}, {REQUESTS}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY bp ORDER BY account) AS rn FROM accounts)
      SELECT bp, account, level, CASE WHEN bp IN (SELECT bp FROM requests) THEN '{IBAN}' ELSE iban END AS iban, street
      FROM ranked WHERE rn = 1 OR bp NOT IN (SELECT bp FROM requests)""",
    "e3_upsert": f"""WITH {ACCOUNTS}, {REQUESTS}
      SELECT bp, account, level, CASE WHEN bp IN (SELECT bp FROM requests) THEN '{IBAN}' ELSE iban END AS iban,
             CASE WHEN bp IN (SELECT bp FROM requests) THEN '{STREET}' ELSE street END AS street FROM accounts
      UNION ALL SELECT 'X' || bp, NULL, NULL, '{IBAN}', '{STREET}' FROM requests
      UNION ALL SELECT bp, NULL, NULL, '{IBAN}', '{STREET}' FROM requests WHERE bp NOT IN (SELECT bp FROM accounts)""",
    "e4_mask_cells": f"""WITH {CLIENTS}, {UNKNOWN} {_cells_of('clients', 1)}
      UNION ALL SELECT bp, 'demographics', 'iban', 2, '{IBAN}' FROM asked
      UNION ALL SELECT bp, 'demographics', 'street', 2, '{STREET}' FROM asked""",
    "e5_purge": f"""WITH {CLIENTS}, {UNKNOWN}, old AS ({_cells_of('clients', 1)})
      SELECT * FROM old WHERE NOT (qualifier IN ('iban', 'street') AND bp IN (SELECT bp FROM asked))
      UNION ALL SELECT bp, 'demographics', 'iban', 2, '{IBAN}' FROM asked
      UNION ALL SELECT bp, 'demographics', 'street', 2, '{STREET}' FROM asked""",
    "e6_erase": f"WITH {ACCOUNTS}, {REQUESTS} SELECT * FROM accounts WHERE bp NOT IN (SELECT bp FROM requests)",
    "e7_apply_to_table": MASKED_CLIENTS,
    "e8_audit": f"""WITH {ACCOUNTS}, {UNKNOWN} SELECT asked.bp, count(accounts.bp) AS rows_found,
        count(iban) AS iban_found, count(street) AS street_found
      FROM asked LEFT JOIN accounts ON asked.bp = accounts.bp GROUP BY asked.bp""",
    "e9_stream": MASKED_CLIENTS,
    "e9_cell_stream": MASKED_CLIENTS,
    "a5_same_ts": f"""WITH {CLIENTS}
      SELECT bp, custid, level, pdl, age, gender, iban, CASE WHEN gender = 'F' THEN '- MOVED' ELSE street END AS street
      FROM clients""",
    "a7_compact_writes": f"""WITH {EVENT_CELLS}, last AS (
        SELECT rowkey, cf, qualifier, ts, max(value) + CASE WHEN rowkey % 5 = 1 THEN 1 ELSE 0 END AS value FROM cells
        GROUP BY rowkey, cf, qualifier, ts)
      SELECT rowkey, cf, qualifier, ts, value FROM (SELECT *, row_number() OVER (PARTITION BY rowkey, cf, qualifier ORDER BY ts DESC) AS rn FROM last)
      WHERE rn = 1""",
    "j2_wide_range": """WITH c AS (SELECT 'customer-of-the-house-' || lpad(CAST(c_custkey AS VARCHAR), 9, '0') AS lo FROM customer WHERE c_acctbal < 0),
      n AS (SELECT max(c_custkey) AS n FROM customer)
      SELECT o_orderkey, 'customer-of-the-house-' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS client FROM orders, n
      WHERE (o_custkey >= n // 3 AND o_custkey < n * 2 // 3) OR o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""",
    "k3_bad_lengths": """SELECT event_id, event_id AS from_8_as_8, event_id >> 32 AS from_8_as_4, event_id >> 48 AS from_8_as_2,
      CAST(NULL AS BIGINT) AS from_4_as_8, event_id AS from_4_as_4, event_id >> 16 AS from_4_as_2,
      CAST(NULL AS BIGINT) AS from_2_as_8, CAST(NULL AS BIGINT) AS from_2_as_4,
      CASE WHEN event_id % 65536 >= 32768 THEN event_id % 65536 - 65536 ELSE event_id % 65536 END AS from_2_as_2 FROM events""",
    "k8_coder_round_trip": f"""{_events(['view'])} SELECT rowkey, round(view, 2) AS view,
      CAST(CAST(round(view * 100) AS BIGINT) AS VARCHAR) || ' c' AS stored, round(view, 2) AS raw_view FROM rows_ WHERE view IS NOT NULL""",
    "e7_catalog_partitions": f"""WITH {ACCOUNTS}, {REQUESTS}
      SELECT bp, account, level, CASE WHEN bp IN (SELECT bp FROM requests) THEN '{IBAN}' ELSE iban END AS iban,
             CASE WHEN bp IN (SELECT bp FROM requests) THEN '{STREET}' ELSE street END AS street, CAST(CAST(account AS BIGINT) % 3 AS INTEGER) AS part
      FROM accounts WHERE NOT (bp IN (SELECT bp FROM requests) AND bp LIKE '%7')""",
    "e9_log_stream": MASKED_CLIENTS,
    "e9_log_compaction": f"""WITH {ACCOUNTS}, {REQUESTS}, {UNKNOWN}
      SELECT bp, account, level, CASE WHEN bp IN (SELECT bp FROM requests) THEN '{IBAN}' ELSE iban END AS iban,
             CASE WHEN bp IN (SELECT bp FROM requests) THEN '{STREET}' ELSE street END AS street
      FROM accounts WHERE NOT (bp IN (SELECT bp FROM requests) AND bp LIKE '%7')
      UNION ALL SELECT bp, NULL, NULL, '{IBAN}', '{STREET}' FROM asked WHERE bp LIKE '%77'""",
    "e8_lifecycle": f"""WITH {ACCOUNTS}, {REQUESTS}, {UNKNOWN}, n AS (
        SELECT (SELECT count(*) FROM customer) + (SELECT count(*) FROM asked) AS lines, (SELECT count(*) FROM customer WHERE NOT coalesce(c_acctbal < 0, false)) AS blank,
          (SELECT count(*) FROM asked) AS new, (SELECT count(*) FROM asked WHERE bp IN (SELECT bp FROM accounts)) AS applied)
      SELECT CAST(0 AS BIGINT) AS batch, lines, blank, new, lines - blank - new AS repeated, applied, new - applied AS unmatched FROM n
      UNION ALL SELECT 1, lines, blank, 0, lines - blank, 0, 0 FROM n""",
}
ORACLES |= {
    "j4_diff_by_digest": ORACLES["j4_diff"], "v8_map_parts": ORACLES["v8_dynamic_history"], "v9_write_parts": ORACLES["v9_write_maps"],
    "v11_pattern_parts": ORACLES["v11_pattern"], "e9_upsert_stream": ORACLES["e3_upsert"],
}

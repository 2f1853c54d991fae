"""Inputs of the named queries, derived from the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from veil.functions.values import ntz_millis

DAY = 86_400_000

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]

EVENT_SPEC = {
    "key": [("rowkey", "bigint")],
    "columns": {t: {"cf": "e", "col": t, "type": "double"} for t in EVENT_TYPES},
}

CLIENT_FIELDS = {
    "custid": "string", "level": "string", "pdl": "int", "age": "int", "gender": "string", "iban": "string",
    "street": "string",
}

CLIENT_SPEC = {
    "key": [("bp", "string")],
    "columns": {n: {"cf": "demographics", "col": n, "type": t} for n, t in CLIENT_FIELDS.items()},
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, in the form of a client table."""
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        key.cast("string").alias("bp"),
        F.col("c_name").alias("custid"),
        F.col("c_mktsegment").alias("level"),
        F.col("c_nationkey").alias("pdl"),
        (F.lit(20) + key % 60).cast("int").alias("age"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("gender"),
        F.concat(F.lit("FR"), F.lpad(key.cast("string"), 10, "0")).alias("iban"),
        F.concat(key.cast("string"), F.lit(" RUE")).alias("street"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rows per client key: one per order."""
    order = F.col("o_orderkey")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("bp"),
        order.cast("string").alias("account"),
        F.col("o_orderpriority").alias("level"),
        F.concat(F.lit("FR"), F.lpad(order.cast("string"), 10, "0")).alias("iban"),
        F.concat(order.cast("string"), F.lit(" RUE")).alias("street"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clients who ask to be forgotten: those with a negative balance."""
    return table(spark, sf_dir, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").cast("string").alias("bp"))


def requests_with_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, and for each of them one key nobody has."""
    known = requests(spark, sf_dir)
    return known.unionByName(known.select(F.concat(F.lit("X"), F.col("bp")).alias("bp")))


def request_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request text: a line per customer, left blank for those who do not ask."""
    line = F.concat(F.lit(" "), F.col("c_custkey").cast("string"), F.lit(" ,"), F.col("c_name"))
    return table(spark, sf_dir, "customer").select(
        F.when(F.col("c_acctbal") < 0, line).otherwise("").alias("value")
    )


def event_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as versioned cells: a row per user, a qualifier per event type."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("rowkey"),
        F.lit("e").alias("cf"),
        F.col("event_type").alias("qualifier"),
        ntz_millis(F.col("ts")).alias("ts"),
        F.col("value"),
    )


def line_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as cells: three families, and cells that share a timestamp."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("rowkey"),
        F.col("l_returnflag").alias("cf"),
        F.col("l_linestatus").alias("qualifier"),
        ntz_millis(F.col("l_shipdate")).alias("ts"),
        F.col("l_extendedprice").alias("value"),
    )


def event_days(spark: SparkSession, sf_dir: str, qualifier: str | None = None) -> DataFrame:
    """The 24 hours after each event as half-open intervals per user."""
    cells = event_cells(spark, sf_dir)
    if qualifier is not None:
        cells = cells.filter(F.col("qualifier") == qualifier)
    return cells.select("rowkey", F.col("ts").alias("lo"), (F.col("ts") + DAY).alias("hi"))


def customer_copies(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two copies of the customer table that went apart: rows lost on both sides, balances changed."""
    full = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    balance = F.col("c_acctbal")
    left = full.filter("c_mktsegment <> 'AUTOMOBILE'")
    right = full.filter("c_mktsegment <> 'MACHINERY'").withColumn(
        "c_acctbal", F.when(balance < 0, -balance).otherwise(balance)
    )
    return left, right

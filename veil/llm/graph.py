"""Connected components of a link table, by contraction in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veil.llm.common import stored, tidy


@tidy
def components(links: DataFrame, one: str = "id1", other: str = "id2") -> DataFrame:
    """(id, component) for every linked id; component is the smallest id reachable.

    In each round every vertex joins the neighbour (or itself) that comes first in
    a fresh pseudo-random order, and the graph shrinks to the chosen ones: stars and
    hubs vanish in one round, chains lose a constant share, so the rounds grow with
    the logarithm of the longest path. The choice is a minimum with map-side
    combine, so a hub costs no more than other vertices. Each round ends in the
    shared folder. Links with a null end and self links count for nothing.
    """
    edges = stored(
        links.select(F.col(one).alias("u"), F.col(other).alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(),
        "edges",
    )
    labels, turn = None, 0
    while not edges.isEmpty():
        order = lambda c: F.xxhash64(F.lit(turn), F.col(c))  # noqa: B023, E731
        ends = edges.select("u", "v").union(edges.select("v", "u"))
        chosen = stored(
            ends.groupBy("u").agg(F.min(F.struct(order("v").alias("h"), "v")).alias("best"))
            .select("u", F.when(F.col("best.h") < order("u"), F.col("best.v")).otherwise(F.col("u")).alias("to")),
            "chosen",
        )
        if labels is None:
            labels = chosen.select(F.col("u").alias("id"), F.col("to").alias("at"))
        else:
            labels = stored(
                labels.join(chosen.withColumnRenamed("u", "at"), "at", "left")
                .select("id", F.coalesce("to", "at").alias("at")), "labels",
            )
        edges = stored(
            edges.join(chosen, "u").select(F.col("to").alias("a"), F.col("v").alias("u"))
            .join(chosen, "u").select("a", F.col("to").alias("b")).where("a <> b")
            .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(),
            "edges",
        )
        turn += 1
    if labels is None:
        return links.select(F.col(one).alias("id"), F.col(one).alias("component")).limit(0)
    least = labels.groupBy("at").agg(F.min("id").alias("component"))
    return labels.join(least, "at").select("id", "component")

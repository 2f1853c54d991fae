"""URL filters: rules first, then trust and distrust spread over the host graph."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from veil.llm.common import stored, tidy
from veil.runtime import measured

DAMPING = 0.85
ROUNDS = 10
#: A host without a rule for its page is blocked when its distrust exceeds this share of its trust.
DISTRUST_OVER_TRUST = 1.0


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty if there is none."""
    rest = F.substring_index(F.substring_index(F.substring_index(_after(url), "/", 1), "?", 1), "#", 1)
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty if there is no host."""
    bare = F.substring_index(F.substring_index(_after(url), "?", 1), "#", 1)
    return F.coalesce(F.substr(bare, F.length(F.substring_index(bare, "/", 1)) + 1), F.lit(""))


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits, as a struct (length, rule, verdict), or null. ``rules`` is a list in the program."""
    fits = [
        F.when(
            ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path),
            F.struct(F.lit(len(r.name)).alias("length"), F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")),
        )
        for r in rules
    ]
    return F.array_max(F.array(*fits))


def host_edges(pages: DataFrame) -> DataFrame:
    """(src, dst, n): absolute links of the html between hosts, and a link each way between a host and the domain it is part of.

    Domains are nodes whether they have pages or not, up to the top one, so hosts of one domain meet there. Relative
    links stay on their host and tell nothing of others. One row for each pair, summed before and after the shuffle.
    """
    target = F.explode(F.regexp_extract_all("html", F.lit("(?i)href\\s*+=\\s*+[\"']?+((?:https?:)?+//[^\"'\\s>]++)"), 1))
    linked = pages.where(F.col("html").contains("//")).select(F.col("host").alias("src"), target.alias("to"))
    absolute = F.when(F.col("to").startswith("//"), F.concat(F.lit("http:"), "to")).otherwise(F.col("to"))
    links = linked.select("src", host_of(absolute).alias("dst")).where("src <> '' and dst <> '' and src <> dst")
    links = links.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))
    hosts = pages.select("host").where("host <> ''").distinct()
    # A host's labels give the chain of its domains; those of several hosts fall together.
    labels = F.filter(F.split("host", "\\."), lambda x: x != "")
    chain = F.transform(F.sequence(F.lit(1), F.size("labels")), lambda i: F.array_join(F.slice("labels", i, F.size("labels")), "."))
    chains = hosts.select("host", labels.alias("labels")).where(F.size("labels") > 0).select("host", chain.alias("chain"))
    chains = chains.select(F.concat(F.array("host"), F.filter("chain", lambda x: x != F.col("host"))).alias("chain"))
    steps = F.transform(F.slice("chain", 1, F.size("chain") - 1), lambda x, i: F.struct(x.alias("src"), F.element_at("chain", i + 2).alias("dst")))
    inner = chains.where(F.size("chain") > 1).select(F.explode(steps).alias("s")).select("s.*").distinct()
    inner = inner.select("src", "dst", F.lit(1).cast("bigint").alias("n"))
    both = inner.union(inner.select("dst", "src", "n"))
    return links.union(both).groupBy("src", "dst").agg(F.sum("n").alias("n"))


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS, damping: float = DAMPING) -> DataFrame:
    """(kind, host, score): personalised PageRank of ``seeds`` (kind, host, share) over ``edges`` (kind, src, dst, n).

    Both kinds run in the same joins. A host without links out loses its score, as no other
    host is to gain by it. Each round ends in the shared folder.
    """
    out = edges.groupBy("kind", "src").agg(F.sum("n").alias("out"))
    steps = stored(edges.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("n") / F.col("out")).alias("part")), "steps")
    scores = seeds.select("kind", "host", F.col("share").alias("score"))
    if steps.isEmpty():
        return scores
    for _ in range(rounds):
        moved = scores.join(steps, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (F.lit(damping) * F.col("score") * F.col("part")).alias("score"))
        kept = seeds.select("kind", "host", (F.lit(1 - damping) * F.col("share")).alias("score"))
        scores = stored(moved.union(kept).groupBy("kind", "host").agg(F.sum("score").alias("score")), "scores")
    return scores


@tidy
def filter_urls(pages: DataFrame, rules: Sequence[Rule], rounds: int = ROUNDS) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust), one row for each row of ``pages`` (page_id, url, html).

    The longest rule that fits decides. Without one the host decides: trust flows along links
    from hosts with allowed pages, distrust against the links from hosts with blocked pages
    (who links to a bad host is suspect), each seed host with its share of those pages. A host with more distrust
    than trust is blocked, all else allowed. Null urls and urls without ``://`` have an empty
    host, fit no rule and are allowed. Null html has no links; repeated rows are pages each.
    """
    url = F.col("url").cast("string")
    rows = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), F.col("html").cast("string").alias("html"))
    rows = rows.withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules))
    named = rows.where("fit is not null and host <> ''").groupBy(
        F.when(F.col("fit.verdict") == "allow", "trust").otherwise("distrust").alias("kind"), "host"
    ).agg(F.count(F.lit(1)).alias("n"))
    total = named.groupBy("kind").agg(F.sum("n").alias("all"))  # two rows
    seeds = stored(named.join(F.broadcast(total), "kind").select("kind", "host", (F.col("n") / F.col("all")).alias("share")), "seeds")
    links = stored(host_edges(rows), "host-edges")
    edges = links.select(F.lit("trust").alias("kind"), "src", "dst", "n").union(
        links.select(F.lit("distrust"), F.col("dst"), F.col("src"), F.col("n"))
    )
    scores = propagate(edges, seeds, rounds)
    of = lambda kind: F.coalesce(F.max(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
    hosts = stored(scores.groupBy("host").agg(of("trust"), of("distrust")), "hosts")
    bad = F.coalesce(F.col("distrust"), F.lit(0.0)) > F.lit(DISTRUST_OVER_TRUST) * F.coalesce(F.col("trust"), F.lit(0.0))
    return rows.drop("html").join(measured(hosts), "host", "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.when(bad, "block").otherwise("allow")).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )

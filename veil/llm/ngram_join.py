"""N-gram Jaccard join: a grouped prefix join of documents on word shingles.

Documents with the same set are one class. Classes with the same prefix and size
are one group, and only groups meet: an inverted list of prefix shingles proposes
group pairs, length and position filter them, the members of the pairs that pass are
expanded and compared exactly on their texts.

Groups of near copies would propose all their pairs. So each list first compares its
members with two pivots only; what these links connect needs no further link among
itself, and the full comparison is left to members of different components. No link
that joins two components is lost, and a group of n copies costs about n pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veil.llm import setjoin as J
from veil.llm import textscan as S
from veil.llm.common import stored, tidy
from veil.llm.graph import components
from veil.runtime import measured

FEATURES = "doc_id bigint, n bigint, sig0 bigint, sig1 bigint, pre0 bigint, pre1 bigint, bit0 bigint, bit1 bigint, prefix array<bigint>"


def _document_shingles(column: pa.Array, k: int, lower: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for at, to, data, offsets in S.slices(column):
        hashes, starts = S.word_hashes(data, offsets, lower)
        rows = np.searchsorted(offsets, starts, "right") - 1
        yield at, to, *S.segment_shingles(hashes, rows, k)


def document_features(docs: DataFrame, k: int, percent: int, lower: bool) -> DataFrame:
    """``FEATURES`` of (doc_id, text): one row for each document, n = 0 without words."""
    weights = J.corpus_weights(
        docs, "text", lambda column: (x for _, _, x, _ in _document_shingles(column, k, lower))
    )

    def features(batches):
        for batch in batches:
            for at, to, shingles, rows in _document_shingles(batch.column(1), k, lower):
                f = J.prefix_features(*S.distinct(S.ranked(shingles, weights.value), rows), percent)
                count, columns = to - at, []
                for name in ("n", "sig0", "sig1", "pre0", "pre1", "bit0", "bit1"):
                    column = np.zeros(count, np.int64)
                    if len(f["segment"]):
                        column[f["segment"]] = f[name]
                    columns.append(pa.array(column))
                length = np.zeros(count, np.int64)
                values = pa.array([], pa.int64())
                if len(f["segment"]):
                    length[f["segment"]] = f["prefix"].value_lengths().to_numpy()
                    values = f["prefix"].values
                offsets = pa.array(np.append(0, np.cumsum(length)).astype(np.int32))
                yield pa.record_batch(
                    [batch.column(0).slice(at, count), *columns, pa.ListArray.from_arrays(offsets, values)],
                    ["doc_id", "n", "sig0", "sig1", "pre0", "pre1", "bit0", "bit1", "prefix"],
                )

    return docs.select("doc_id", "text").mapInArrow(features, FEATURES)


def _links(pairs: DataFrame, classes: DataFrame, heads: DataFrame, docs: DataFrame, k: int, percent: int, lower: bool) -> DataFrame:
    """The pairs (id1, id2) of classes that link: bound on their prefixes, then exact comparison of the texts.

    If the prefix of x ends no later in the order than that of y, a shingle of it that y holds is
    in the prefix of y. So the sets share at most what the prefixes share, and the rest of x.
    """
    pairs = stored(pairs, "pairs")
    ids = pairs.select(F.explode(F.array("id1", "id2")).alias("cls")).distinct()
    ends = classes.select("cls", "gid").join(measured(ids), "cls").join(heads, "gid")
    ends = ends.select("cls", "n", "prefix", (F.element_at("prefix", -1).bitwiseXOR(F.lit(-(1 << 63)))).alias("last"))
    ends = stored(ends, "prefixes")
    for i in (1, 2):
        pairs = pairs.join(ends.select(*(F.col(c).alias(f"id{i}" if c == "cls" else f"{c}{i}") for c in ends.columns)), f"id{i}")
    rest = F.when(F.col("last1") <= F.col("last2"), F.col("n1") - F.size("prefix1")).otherwise(F.col("n2") - F.size("prefix2"))
    met = F.size(F.array_intersect("prefix1", "prefix2"))
    near = pairs.where(met + rest >= J.overlap_needed(F.col("n1"), F.col("n2"), percent)).select("id1", "id2").distinct()
    near = stored(near, "candidates")
    wanted = near.select(F.explode(F.array("id1", "id2")).alias("id"))
    texts = J.needed_texts(docs.select(F.col("doc_id").alias("id"), "text"), wanted, "id")
    return stored(J.verify(near, texts, ["id"], k, percent, lower), "links")


@tidy
def ngram_jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, lower: bool = True,
) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id), one row for each row of ``docs``.

    Two documents link when the Jaccard similarity of their sets of distinct k-word
    shingles is at least ``percent`` / 100. ``class_id`` is the smallest id with the same
    set, ``component_id`` the smallest id reachable by links. With fewer than k words the
    whole sequence is one shingle. Without words (empty or null text) a document has no
    shingles, links with nothing and is its own component. A row with a null id links
    with nothing and has null ids. Rows that repeat an id share its links. Other columns
    of ``docs`` are not looked at. An empty table gives an empty result.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    feats = stored(document_features(docs, k, percent, lower), "features")
    sets = ["n", "sig0", "sig1", "pre0", "pre1", *J.BITS]
    alike = feats.where("n > 0 and doc_id is not null").groupBy(*sets).agg(F.min("doc_id").alias("cls"))
    alike = stored(alike, "classes")
    group = ["n", "pre0", "pre1"]
    groups = alike.groupBy(*group).agg(F.min("cls").alias("gid"), F.count(F.lit(1)).alias("members"))
    classes = stored(alike.join(groups, group), "grouped")

    # Inverted lists of the groups' prefixes, without those of a single group. They hold keys
    # alone; sizes and places are looked up for the lists that are left.
    of = classes.where("cls = gid").select("gid", *group).distinct()
    heads = feats.select(F.col("doc_id").alias("gid"), *group, *J.BITS, "prefix").join(of, ["gid", *group], "left_semi")
    heads = stored(heads.drop("pre0", "pre1"), "heads")
    postings = heads.select("gid", F.explode("prefix").alias("token"))
    lists = (
        postings.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min("gid").alias("p1"), F.max("gid").alias("p2"))
        .where("p1 < p2").drop("c")
    )
    shared = postings.join(lists, "token").join(heads, "gid")
    shared = stored(shared.withColumn("pos", F.array_position("prefix", F.col("token")) - 1).drop("prefix"), "lists")

    pivots = shared.where("gid = p1 or gid = p2").select(
        F.col("token").alias("at"), F.col("gid").alias("pivot"), *(F.col(c).alias(f"{c}_p") for c in ("n", "pos", *J.BITS))
    )
    star = shared.join(
        pivots,
        (F.col("token") == F.col("at")) & (F.col("gid") != F.col("pivot"))
        & J.positional(F.col("n"), F.col("pos"), F.col("n_p"), F.col("pos_p"), percent)
        & J.may_match(F.col("n"), F.col("n_p"), [F.col(c) for c in J.BITS], [F.col(f"{c}_p") for c in J.BITS], percent),
    ).select("gid", "pivot")
    star = star.union(classes.where("cls <> gid").select("cls", "gid"))
    star = star.toDF("a", "b").select(F.least("a", "b").alias("id1"), F.greatest("a", "b").alias("id2")).distinct()
    links = _links(star, classes, heads, docs, k, percent, lower)
    labels = components(links, "id1", "id2")

    # Whatever these links left apart is compared in full.
    named = stored(
        classes.join(labels, F.col("cls") == F.col("id"), "left").drop("id")
        .withColumn("component", F.coalesce("component", "cls")), "labelled",
    )
    one = F.col("members") == 1
    spans = named.groupBy("gid").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        *(F.min(F.when(one, F.col(c))).alias(c) for c in J.BITS),
    )
    open_lists = shared.select("token", "pos", "gid", "n").join(spans, "gid")
    mixed = (
        open_lists.groupBy("token").agg(F.min("low").alias("least"), F.max("high").alias("most"))
        .where("least < most").select("token")
    )
    rest = stored(open_lists.join(mixed, "token"), "open")
    a, b = rest.alias("a"), rest.alias("b")
    col = lambda side: lambda c: F.col(f"{side}.{c}")
    x, y = col("a"), col("b")
    apart = (x("low") != x("high")) | (y("low") != y("high")) | (x("low") != y("low"))
    group_pairs = (
        a.join(
            b,
            (x("token") == y("token")) & (x("gid") < y("gid")) & apart
            & J.positional(x("n"), x("pos"), y("n"), y("pos"), percent)
            & F.coalesce(J.may_match(x("n"), y("n"), [x(c) for c in J.BITS], [y(c) for c in J.BITS], percent), F.lit(True)),
        )
        .select(x("gid").alias("g1"), y("gid").alias("g2")).distinct()
    )
    inside = spans.where("low < high").select(F.col("gid").alias("g1"), F.col("gid").alias("g2"))
    member = lambda i: named.select(
        F.col("gid").alias(f"g{i}"), F.col("cls").alias(f"m{i}"), F.col("component").alias(f"c{i}"), F.col("n").alias(f"n{i}"),
        *(F.col(bit).alias(f"{bit}_{i}") for bit in J.BITS),
    )
    expanded = _expand(group_pairs.union(inside), member, percent)
    more = _links(expanded, classes, heads, docs, k, percent, lower)
    if not more.isEmpty():
        labels = components(links.union(more), "id1", "id2")

    final = classes.join(labels, F.col("cls") == F.col("id"), "left").select(
        *sets, "cls", F.coalesce("component", "cls").alias("component_id")
    )
    keyed = feats.select("doc_id", *sets)
    return keyed.join(final, sets, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("cls", "doc_id")).alias("class_id"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    )


def _expand(group_pairs: DataFrame, member, percent: int) -> DataFrame:
    """Members of paired groups that lie in different components and may match."""
    bits = [[F.col(f"{c}_{i}") for c in J.BITS] for i in (1, 2)]
    both = group_pairs.join(member(1), "g1").join(member(2), "g2").where(
        (F.col("c1") != F.col("c2")) & J.may_match(F.col("n1"), F.col("n2"), *bits, percent)
    )
    return both.select(F.least("m1", "m2").alias("id1"), F.greatest("m1", "m2").alias("id2")).where("id1 < id2").distinct()


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the documents that are not the first (smallest id) of their component; null ids stay."""
    found = ngram_jaccard_join(docs, k=k, percent=percent)
    gone = stored(found.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    return docs.join(measured(gone), "doc_id", "left_anti").select(docs.columns)

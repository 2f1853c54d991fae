"""Benchmark decontamination: item-sized windows, SimHash, multi-index Hamming blocks, exact check.

A window is as many words of a document as an item has. Only windows aligned with an
item at a shared shingle are looked at, because without one the similarity is 0. Each
gets a 64-bit SimHash of its weighted shingles. Fingerprints are cut into eight blocks
of eight bits; a fingerprint within 23 bits has a block within 2 bits (8 * 3 > 23), so
joining equal blocks, with the items' blocks varied in up to two bits, finds all of
them. What is found is compared exactly.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from veil.llm.common import stored, tidy, words
from veil.runtime import measured

BLOCKS = 8
BLOCK_BITS = 8
#: Largest Hamming distance that is guaranteed to be found: each block may differ in 2 bits.
RADIUS = 23
#: Places are first tested against this many buckets of the items' shingles, so at most this many numbers are in the plan.
BUCKETS = 1 << 16


def normal_words(text: Column) -> Column:
    """Hashes of the lower-case words without punctuation; what is neither letter nor digit parts nothing and counts for nothing."""
    bare = F.regexp_replace(F.lower(text), "[^\\p{L}\\p{N}\\x20\\x09-\\x0D]+", "")
    return F.transform(words(bare), lambda w: F.xxhash64(w))


def _shingle(ws: Column, i: Column, k: int) -> Column:
    """Hash of the k words from place i on."""
    return F.xxhash64(*(F.get(ws, i + j) for j in range(k)))


def _shingle_hashes(ws: Column, k: int) -> Column:
    """Hash of each run of k words, by position; fewer words: of the whole run."""
    out = F.when(F.size(ws) >= k, F.transform(F.sequence(F.lit(0), F.size(ws) - k), lambda i: _shingle(ws, i, k)))
    for n in range(1, k):
        out = out.when(F.size(ws) == n, F.array(_shingle(ws, F.lit(0), n)))
    return out.otherwise(F.array().cast("array<bigint>"))


def _items(benchmark: DataFrame, k: int) -> DataFrame:
    """(item_id, n_words, pos, shingle, weight): the items' shingles, weighed by how few items hold them."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), normal_words(F.col("text").cast("string")).alias("w"))
    shingles = items.where(F.size("w") > 0).select(
        "item_id", F.size("w").alias("n_words"), F.posexplode(_shingle_hashes(F.col("w"), k)).alias("pos", "shingle")
    )
    held = shingles.groupBy("shingle").agg(F.countDistinct("item_id").alias("in_items"))
    return shingles.join(held, "shingle").withColumn("weight", _weight(F.col("in_items")))


def _weight(in_items: Column) -> Column:
    """1 for a shingle of one item or none, less for those of many."""
    return F.lit(1.0) / (F.lit(1.0) + F.log2(F.greatest(in_items, F.lit(1))))


def _fingerprint(rows: DataFrame, keys: list[str]) -> DataFrame:
    """SimHash of (keys, shingle, weight, times): for each bit, the sign of the weights with it less those without."""
    total = [
        F.sum(F.when(F.getbit("shingle", F.lit(b)) == 1, F.col("weight") * F.col("times")).otherwise(-F.col("weight") * F.col("times"))).alias(f"b{b}")
        for b in range(64)
    ]
    bit = [F.when(F.col(f"b{b}") > 0, F.lit(1 << b if b < 63 else -(1 << 63))).otherwise(F.lit(0)).cast("bigint") for b in range(64)]
    value = bit[0]
    for x in bit[1:]:
        value = value.bitwiseOR(x)
    return rows.groupBy(*keys).agg(*total).select(*keys, value.alias("print"))


def _block(value: Column, i: int) -> Column:
    return F.shiftrightunsigned(value, i * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))


def near_prints(windows: DataFrame, items: DataFrame) -> DataFrame:
    """Pairs of ``windows`` (…, n_words, print) and ``items`` (item_id, n_words, print) within RADIUS.

    Complete: see the module. Windows only meet items of their own number of words.
    """
    flips = [0, *(1 << i for i in range(BLOCK_BITS)), *(1 << i | 1 << j for i, j in combinations(range(BLOCK_BITS), 2))]
    item_blocks = items.select(
        "item_id", "n_words", F.col("print").alias("item_print"),
        F.posexplode(F.array(*(_block(F.col("print"), i) for i in range(BLOCKS)))).alias("block", "value"),
    ).withColumn("value", F.explode(F.transform(F.array(*map(F.lit, flips)), lambda f: F.col("value").bitwiseXOR(f.cast("bigint")))))
    window_blocks = windows.withColumn("parts", F.array(*(_block(F.col("print"), i) for i in range(BLOCKS)))).select(
        *windows.columns, F.posexplode("parts").alias("block", "value")
    )
    return (
        window_blocks.join(measured(item_blocks), ["n_words", "block", "value"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select(*windows.columns, "item_id").distinct()
    )


@tidy
def decontaminate(docs: DataFrame, benchmark: DataFrame, k: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, item_id, start, similarity): the best window of each item found in each document.

    ``start`` counts words from 0. Shingles are k words, lower-cased and without
    punctuation; the similarity is the weighted Jaccard similarity of multisets, sum of the
    smaller over sum of the larger weights, and at least ``similarity``. Texts and items
    without words match nothing; an item of fewer than k words is one shingle; null ids take no part;
    repeated items give a row each; rows that repeat a doc_id count as one document.
    """
    shingles = stored(_items(benchmark, k), "items")
    sizes = [r[0] for r in shingles.select(F.least("n_words", F.lit(k))).distinct().collect()]  # at most k numbers
    known = measured(shingles.select("shingle").distinct())
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), normal_words(F.col("text").cast("string")).alias("w"))
    # A filter on what is made of the words would be pushed below them and take them apart once more
    # for every place; so short texts have null places instead.
    texts = texts.where("doc_id is not null")

    # Where a shingle of an item stands, and the windows this proposes.
    hits = None
    bucket = lambda h: h.bitwiseAND(F.lit(BUCKETS - 1))
    for size in sizes:
        mine = shingles.where(F.least("n_words", F.lit(k)) == size)
        used = [r[0] for r in mine.select(bucket(F.col("shingle"))).distinct().collect()]
        places = F.filter(F.sequence(F.lit(0), F.size("w") - size), lambda i: bucket(_shingle(F.col("w"), i, size)).isin(used))  # noqa: B023
        places = F.when(F.size("w") >= size, places)
        found = texts.select("doc_id", "w", F.size("w").alias("text_words"), places.alias("places"))
        found = found.select(
            "doc_id", "text_words",
            F.explode(F.transform("places", lambda i: F.struct(i.alias("at"), _shingle(F.col("w"), i, size).alias("shingle")))).alias("p"),  # noqa: B023
        ).select("doc_id", "text_words", "p.*").join(known, "shingle", "left_semi")
        found = found.withColumn("least", F.lit(size))
        hits = found if hits is None else hits.union(found)
    if hits is None:
        return docs.sparkSession.createDataFrame([], "doc_id bigint, item_id bigint, start int, similarity double")
    hits = stored(hits, "hits")
    anchors = measured(shingles.select("shingle", "pos", "n_words", F.least("n_words", F.lit(k)).alias("least")).distinct())
    windows = (
        hits.join(anchors, ["shingle", "least"])
        .select("doc_id", "text_words", "n_words", "least", F.greatest(F.lit(0), F.least(F.col("at") - F.col("pos"), F.col("text_words") - F.col("n_words"))).alias("start"))
        .distinct()
    )

    # Their shingles: those of items are in the hits; all others only add to the union.
    span = F.least("n_words", F.col("text_words") - F.col("start")) - F.col("least") + 1
    windows = windows.withColumn("n_shingles", span).where("n_shingles > 0")
    keys = ["doc_id", "n_words", "start"]
    by_doc = windows.groupBy("doc_id").agg(F.collect_set(F.struct("start", "n_words", "least", "n_shingles")).alias("windows"))
    # Only these documents' texts are taken apart again.
    held = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(measured(by_doc), "doc_id")
    held = held.select("doc_id", "windows", normal_words(F.col("text").cast("string")).alias("w"))
    # Each window takes its own words along; the size keeps the words from being made anew for every one.
    cut = lambda v: F.struct(v["n_words"].alias("n_words"), v["start"].alias("start"), F.slice("w", v["start"] + 1, v["n_words"]).alias("v"))
    inside = held.select("doc_id", F.explode(F.when(F.size("w") > 0, F.transform("windows", cut))).alias("c")).select("doc_id", "c.*")
    inside = inside.select("doc_id", "n_words", "start", F.explode(_shingle_hashes(F.col("v"), k)).alias("shingle"))
    times = inside.groupBy(*keys, "shingle").agg(F.count(F.lit(1)).alias("times"))
    weights = measured(shingles.select("shingle", "weight").distinct())
    contents = stored(
        times.join(weights, "shingle", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0))), "windows"
    )
    bags = shingles.groupBy("item_id", "n_words", "shingle", "weight").agg(F.count(F.lit(1)).alias("times"))
    pairs = stored(near_prints(_fingerprint(contents, keys), _fingerprint(bags, ["item_id", "n_words"])), "near")

    # Exact similarity of what is within the radius.
    total = lambda rows, by, name: rows.groupBy(*by).agg(F.sum(F.col("weight") * F.col("times")).alias(name))
    items = bags.select("item_id", "shingle", F.col("times").alias("item_times"))
    meet = (
        pairs.join(contents, keys).join(measured(items), ["item_id", "shingle"])
        .groupBy(*keys, "item_id").agg(F.sum(F.col("weight") * F.least("times", "item_times")).alias("meet"))
        .join(total(contents, keys, "mine"), keys)
        .join(measured(total(bags, ["item_id"], "theirs")), "item_id")
    )
    scored = meet.withColumn("similarity", F.col("meet") / (F.col("mine") + F.col("theirs") - F.col("meet")))
    best = (
        scored.where(F.col("similarity") >= F.lit(similarity - 1e-9)).groupBy("doc_id", "item_id")
        .agg(F.max(F.struct("similarity", (-F.col("start")).alias("start"))).alias("b"))
    )
    return best.select("doc_id", "item_id", (-F.col("b.start")).alias("start"), F.col("b.similarity").alias("similarity"))


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = 5, similarity: float = 0.8) -> DataFrame:
    """(doc_id, contaminated, n_items, item_id, similarity), a row for each row of ``docs``; the item is the most similar one."""
    found = decontaminate(docs, benchmark, k, similarity)
    per_doc = found.groupBy(F.col("doc_id").alias("_id")).agg(
        F.count(F.lit(1)).alias("n_items"), F.max(F.struct("similarity", (-F.col("item_id")).alias("i"))).alias("b")
    )
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    return ids.join(per_doc, ids["doc_id"] == per_doc["_id"], "left").select(
        "doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).cast("bigint").alias("n_items"),
        (-F.col("b.i")).alias("item_id"), F.col("b.similarity").alias("similarity"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; null ids stay."""
    gone = decontaminate(docs, benchmark).select("doc_id").distinct()
    return docs.join(measured(gone), "doc_id", "left_anti").select(docs.columns)

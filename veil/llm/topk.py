"""Exact top-k inner products by a three-phase uniform threshold.

The components of a vector fall into ``LISTS`` lists; a pair's score is the sum of its
lists' scores. Queries go out in batches of bounded size, and every task works on its own
part of the vectors:

1. Each task gathers, for each query and list, the entries of the k highest list scores. The
   k-th highest whole score among all of them is a cutoff that no result can be below.
2. The cutoffs are broadcast. A pair can only reach one if some list gives it at least an equal
   share of it, so each task collects the entries that do.
3. The scores still missing of a collected entry are resolved exactly (its lists lie in one row, so
   this happens where it was collected), and those at or above the cutoff are ranked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from veil.llm.common import scratch_dir, tidy

#: Lists that the components are dealt to.
LISTS = 2
#: Queries of one batch; its vectors and cutoffs are what the driver holds and broadcasts.
BATCH_ROWS = 4096
#: Bytes of one batch of query vectors, at 8 bytes a component; longer vectors make smaller batches.
BATCH_BYTES = 32 * 1024 * 1024
#: Rows and queries of one block of scores.
BLOCK = 1024

SCALE = 1024
LEAST, MOST = -(2**63), 2**63 - 1
_LAST = np.iinfo(np.int64).max


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector) of the rows that take part: no null vector, no null or non-finite component."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), vector.alias("vector")).where(sound)


def scaled(column: pa.Array, width: int) -> np.ndarray:
    """floor(1024 * x) of a column of vectors as rows of whole doubles, zeros behind the shorter ones; longer ones are cut.

    A query's width is enough for it: components beyond it meet zeros.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    flat = np.floor(SCALE * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    if len(lengths) and (lengths == lengths[0]).all():
        rows = flat.reshape(len(lengths), lengths[0])[:, :width]
        return np.pad(rows, ((0, 0), (0, width - rows.shape[1])))
    rows, at = np.zeros((len(lengths), width)), np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    inside = place < width
    rows[at[inside], place[inside]] = flat[inside]
    return rows


def exact(queries: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both sides in a type in which products and their sums are exact: doubles below 2 ** 53, else whole numbers without bound."""
    most = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, queries.shape[1])
    if most < 2**53:
        return queries, rows
    whole = np.frompyfunc(int, 1, 1)
    return whole(queries).astype(object), whole(rows).astype(object)


def cuts(width: int, lists: int) -> list[slice]:
    edges = [round(i * width / lists) for i in range(lists + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False)]


def blocks(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, which ids are null, scaled rows) of at most ``BLOCK`` vectors each."""
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK):
            part = batch.slice(at, BLOCK)
            ids = part.column("vec_id")
            yield ids.fill_null(_LAST).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), scaled(part.column("vector"), width)


def highest(values: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest values of each row."""
    if k >= values.shape[1]:
        return np.broadcast_to(np.arange(values.shape[1]), values.shape)
    if values.dtype == object:
        return np.argsort(-values, axis=1)[:, :k]
    return np.argpartition(-values, k - 1, axis=1)[:, :k]


def as_longs(scores: np.ndarray) -> np.ndarray:
    """Scores as longs; those beyond their range become its ends."""
    if scores.dtype == object:
        return np.array([min(MOST, max(LEAST, int(x))) for x in scores], dtype=np.int64)
    return scores.astype(np.int64)


def gather(batches: Iterator[pa.RecordBatch], ids: np.ndarray, queries: np.ndarray, k: int, lists: int) -> Iterator[pa.RecordBatch]:
    """(query, score): for each query the k highest whole scores among the entries that lead the task's lists."""
    parts = cuts(queries.shape[1], lists)
    starts = range(0, len(ids), BLOCK)
    leads: dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
    seen = 0
    for vec_ids, none, rows in blocks(batches, queries.shape[1]):
        for at in starts:
            left, right = exact(queries[at:at + BLOCK], rows)
            by_list = [left[:, p] @ right[:, p].T for p in parts]
            whole = sum(by_list)
            own = (ids[at:at + BLOCK, None] == vec_ids[None, :]) & ~none[None, :]
            for i, listed in enumerate(by_list):
                values = np.where(own, -np.inf, listed)
                top = highest(values, k)
                new = (np.take_along_axis(values, top, 1), top + seen, np.take_along_axis(whole, top, 1))
                if (at, i) in leads:
                    new = tuple(np.concatenate(x, axis=1) for x in zip(leads[at, i], new, strict=True))
                    top = highest(new[0], k)
                    new = tuple(np.take_along_axis(x, top, 1) for x in new)
                leads[at, i] = new
        seen += len(vec_ids)
    query, score = [], []
    for at in starts if seen else ():
        values, rows, whole = (np.concatenate([leads[at, i][x] for i in range(lists)], axis=1) for x in range(3))
        for q in range(len(values)):
            entries = {row: s for v, row, s in zip(values[q], rows[q], whole[q], strict=True) if v != -np.inf}
            best = as_longs(np.array(sorted(entries.values(), reverse=True)[:k]))
            query += [at + q] * len(best)
            score += best.tolist()
    if query:
        yield pa.RecordBatch.from_arrays([pa.array(query, pa.int32()), pa.array(score, pa.int64())], names=["query", "score"])


def leading(found: list[tuple], k: int) -> tuple:
    """The k best entries (query, score, id, null) of each query, by score, then id, null last."""
    query, score, ids, none = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((ids, none, ~score, query))  # ~x falls as x grows, without overflow
    query, score, ids, none = query[order], score[order], ids[order], none[order]
    first = np.searchsorted(query, query)
    keep = np.arange(len(query)) - first < k
    return query[keep], score[keep], ids[keep], none[keep]


def collect(batches: Iterator[pa.RecordBatch], ids: np.ndarray, queries: np.ndarray, cutoffs: np.ndarray, k: int, lists: int) -> Iterator[pa.RecordBatch]:
    """(query_id, query, vec_id, score) of the task's k best entries of each query that reach its cutoff."""
    parts = cuts(queries.shape[1], lists)
    found: list[tuple] = []
    waiting = 0
    for vec_ids, none, rows in blocks(batches, queries.shape[1]):
        for at in range(0, len(ids), BLOCK):
            left, right = exact(queries[at:at + BLOCK], rows)
            cutoff = cutoffs[at:at + BLOCK]
            # The k-th best score is this high, so with less than its share from every list a pair stays below.
            share = np.array([-np.inf if c == LEAST else -(-int(c) // lists) for c in cutoff], dtype=left.dtype)
            known, missing = 0, np.zeros((len(left), len(right)), dtype=np.int64)
            for i, p in enumerate(parts):
                listed = left[:, p] @ right[:, p].T
                enough = listed >= share[:, None]
                known = known + np.where(enough, listed, 0)
                missing |= np.where(enough, 0, 1 << i)
            sufficient = (missing != (1 << lists) - 1) & ~((ids[at:at + BLOCK, None] == vec_ids[None, :]) & ~none[None, :])
            q, r = np.nonzero(sufficient)
            score, missing = known[q, r], missing[q, r]
            for i, p in enumerate(parts):
                todo = np.nonzero(missing & (1 << i))[0]
                score[todo] += (left[q[todo]][:, p] * right[r[todo]][:, p]).sum(axis=1)
            score = as_longs(score)
            stay = score >= cutoff[q]
            if stay.any():
                found.append((q[stay] + at, score[stay], vec_ids[r[stay]], none[r[stay]]))
                waiting += len(found[-1][0])
                if waiting > 4 * k * len(ids) + 100_000:
                    found = [leading(found, k)]
                    waiting = len(found[0][0])
    if found:
        query, score, vec, none = leading(found, k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[query]), pa.array(query.astype(np.int32)), pa.array(vec, mask=none), pa.array(score)], names=["query_id", "query", "vec_id", "score"]
        )


def search_batch(rows: DataFrame, ids: np.ndarray, queries: np.ndarray, k: int, lists: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of one batch of queries against all rows."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast((ids, queries))
    listed = rows.mapInArrow(lambda batches: gather(batches, *sent.value, k, lists), "query int, score bigint")
    by_score = Window.partitionBy("query").orderBy(F.col("score").desc())
    cutoff = listed.withColumn("n", F.row_number().over(by_score)).where(F.col("n") <= k).groupBy("query").agg(F.min("score").alias("cutoff"), F.count(F.lit(1)).alias("n"))
    # With fewer than k candidates every one of them is a result.
    cutoffs = np.full(len(ids), LEAST, dtype=np.int64)
    for r in cutoff.where(F.col("n") == k).toLocalIterator():
        cutoffs[r["query"]] = r["cutoff"]
    limits = spark.sparkContext.broadcast(cutoffs)
    entries = rows.mapInArrow(lambda batches: collect(batches, *sent.value, limits.value, k, lists), "query_id bigint, query int, vec_id bigint, score bigint")
    ranked = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return entries.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query_batches(queries: DataFrame, rows_of_batch: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, scaled vectors) of ``queries``, batch by batch, from files of at most so many rows."""
    spark = queries.sparkSession
    path = scratch_dir(spark, "topk-queries")
    total, width = queries.agg(F.count(F.lit(1)), F.max(F.size("vector"))).first()
    if not total:
        return
    rows_of_batch = max(1, min(rows_of_batch, BATCH_BYTES // (8 * max(1, width))))
    queries.repartition(-(-total // rows_of_batch)).write.option("maxRecordsPerFile", rows_of_batch).parquet(path)
    for file in sorted(spark.read.schema(queries.schema).parquet(path).inputFiles()):
        batch = spark.read.schema(queries.schema).parquet(file).toArrow()
        if batch.num_rows:
            yield batch.column("vec_id").to_numpy(), scaled(batch.column("vector"), max(1, width))


@tidy
def exact_top_k(
    vectors: DataFrame, every: int, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", lists: int = LISTS, rows_of_batch: int = BATCH_ROWS,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows but those with the
    query's own id. Components count as floor(1024 * x). Ties go to the smaller id, null last; fewer than k
    candidates are all returned. Null vectors and those with null or non-finite components take no
    part. A shorter vector counts as filled up with zeros; an empty one scores 0. Rows that repeat an id are
    queries and candidates of their own, so a repeated query id has a result for each of its rows. Scores outside
    the range of long become its ends. An empty table gives an empty result; other columns are ignored.
    """
    spark: SparkSession = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    path = scratch_dir(spark, "topk")
    result = "query_id bigint, rank int, vec_id bigint, score bigint"
    spark.createDataFrame([], result).write.parquet(path)
    for ids, queries in query_batches(rows.where(F.col("vec_id") % every == 0), rows_of_batch):
        search_batch(rows, ids, queries, k, lists).write.mode("append").parquet(path)
    return spark.read.schema(result).parquet(path)

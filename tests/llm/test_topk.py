"""Exact top-k search against all products."""

import math
import random

import pytest

from veil.llm import topk


def brute(rows, every, k):
    sound = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in sound:
        if q is not None and q % every == 0:
            scores = sorted(((max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b)))), i) for i, b in sound if i != q), key=lambda s: (-s[0], s[1] is None, s[1] or 0))
            out += [(q, n + 1, i, s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out, key=repr)


def run(spark, rows, every, k, kind="float", **more):
    frame = spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], f"vec_id bigint, embedding array<{kind}>, score int, query string, rank int")
    return sorted(map(tuple, topk.exact_top_k(frame, every, k, **more).collect()), key=repr)


def vectors(chance, n, width):
    grid = [x / 8 for x in range(-8, 9)]
    return [(i, [chance.choice(grid) for _ in range(width)]) for i in range(n)]


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_against_all_products(spark, lists):
    chance = random.Random(lists)
    rows = vectors(chance, 300, 7)
    rows += [(1000 + i, rows[0][1]) for i in range(100)]  # equal scores
    rows += [(-10, rows[3][1]), (None, rows[0][1]), (500, None), (510, [1.0, None]), (520, [math.nan] * 7), (530, [math.inf] * 7), (540, []), (550, [1.0]), (560, [0.1] * 9)]
    rows += [rows[20], rows[21], (20, rows[5][1])]  # ids that repeat
    assert run(spark, rows, 10, 10, lists=lists, rows_of_batch=7) == brute(rows, 10, 10)


def test_fewer_than_k_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, None)]
    assert run(spark, rows, 2, 10) == brute(rows, 2, 10)
    assert run(spark, rows[:1], 1, 10) == []
    assert run(spark, [], 1, 10) == []


def test_scores_beyond_doubles(spark):
    chance = random.Random(9)
    rows = [(i, [chance.uniform(-1, 1) * 10 ** chance.randint(0, 6) for _ in range(4)]) for i in range(60)]
    rows += [(100 + i, [1e300, -1e300, 1.0, 0.0]) for i in range(3)]
    assert run(spark, rows, 20, 5, kind="double") == brute(rows, 20, 5)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    chance = random.Random(4)
    rows = vectors(chance, 200, 5)
    parts = [rows[:90], rows[90:]]
    import numpy as np
    import pyarrow as pa

    batches = lambda part: iter([pa.RecordBatch.from_pydict({"vec_id": pa.array([i for i, _ in part], pa.int64()), "vector": pa.array([v for _, v in part], pa.list_(pa.float64()))})])
    ids = np.arange(0, 200, 5)
    queries = topk.scaled(pa.array([rows[i][1] for i in ids], pa.list_(pa.float64())), 5)
    listed = [b.to_pylist() for p in parts for b in topk.gather(batches(p), ids, queries, 3, 2)]
    best = brute(rows, 5, 3)
    for at, q in enumerate(ids):
        scores = sorted((r["score"] for part in listed for r in part if r["query"] == at), reverse=True)
        assert scores[2] <= min(s for i, _, _, s in best if i == q)  # the cutoff is safe

"""Conversation prefix trie against a trie built turn by turn."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from veil.llm import trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, node string, below int"


def brute(table):
    convs = defaultdict(list)
    for c, t, role, text in table:
        if c is not None:
            text = text or ""
            convs[c].append(((t is not None, t or 0, role or "", hashlib.sha256(text.encode()).hexdigest()), (role or "", text)))
    turns = {c: [x for _, x in sorted(rows, key=lambda r: r[0])] for c, rows in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        path = tuple(turns.get(base, [])[:h] + turns[c][h:])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    below = defaultdict(lambda: [0, 0, 0])
    for path in sorted(members, key=len, reverse=True):
        own = below[path]
        own[1] = own[1] if own[0] else 1
        own[2] += (len(members[path]) - 1) * len(path[-1][1].encode()) if path else 0
        if path:
            up = below[path[:-1]]
            up[0], up[1], up[2] = up[0] + 1, up[1] + own[1], up[2] + own[2]
    return sorted((
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), *below[p], hashlib.sha256(",".join(map(str, ends.get(p, []))).encode()).hexdigest())
        for p, m in members.items()
    ), key=repr)


def run(spark, table, **more):
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in table], SCHEMA)
    return sorted(map(tuple, trie.prefix_trie(frame, **more).collect()), key=repr)


def some(chance):
    table = []
    for c in [*range(-12, 60), 1000, 1004]:
        for t in range(chance.randint(1, 12)):
            table.append((c, chance.choice([t, t, t, None]), chance.choice(["user", "assistant", None]), chance.choice(["a", "b", "é", "", None])))
    first = [(t, "user", "x" * 50) for t in range(11)]
    table += [(c, *r) for c in range(2000, 2100) for r in first]  # copies
    table += [(None, 1, "user", "lost"), (1000, 0, "user", "a"), (1000, 0, "user", "a"), (3003, 0, "user", "alone")]
    return table


@pytest.mark.parametrize("parts, limit", [(1, 200_000), (4, 2), (4096, 200_000)])
def test_against_brute_force(spark, parts, limit):
    table = some(random.Random(parts))
    assert run(spark, table, parts=parts, limit=limit) == brute(table)


def test_empty_and_single(spark):
    assert run(spark, []) == []
    assert run(spark, [(5, 0, "user", "x" * 1_000_000)]) == brute([(5, 0, "user", "x" * 1_000_000)])
    turnless = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0)
    assert run(spark, [(turnless, 0, "user", "gone")]) == brute([(turnless, 0, "user", "gone")])


@pytest.mark.parametrize("limit", [1, 3, 1000])
def test_queue_spills(limit):
    chance, queue, want = random.Random(limit), trie.SpillingQueue(limit), defaultdict(lambda: [0, 0, 0])
    out = []
    for _ in range(300):
        depth, sums = chance.randint(0, 4), [chance.randint(0, 9) for _ in range(3)]
        node = bytes([chance.randint(0, 9)]) * 16 if depth else trie.ROOT
        queue.push(depth, node, *sums)
        want[-depth, node] = [a + b for a, b in zip(want[-depth, node], sums)]
    while (key := queue.first()) is not None:
        out.append((key, queue.pop()))
    assert out == sorted(want.items())
    assert (queue.spilled > 0) == (limit < 1000)

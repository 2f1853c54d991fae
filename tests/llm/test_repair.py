"""Conversation structure repair against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from veil.llm import repair as R

SCHEMA = "conv_id bigint, turn bigint, role string, text string, pos int, copy string, symbols string"
LAST = re.compile("[^\x20\x09-\x0D]")


def cheapest(rows):
    """(cost, audit, repaired) of (initial, role, text, fault) by trying edits in order of cost and audit."""
    heap, done = [(0, "", 0, 0, ())], set()
    while heap:
        cost, audit, i, state, out = heapq.heappop(heap)
        if i == len(rows) and state in (0, 3):
            return cost, audit, out
        if (cost, audit, i, state) in done or cost > 3 * len(rows) + 12:
            continue
        done.add((cost, audit, i, state))
        role = "assistant" if state == 2 else "user"
        after = 3 if state == 2 else 2
        heapq.heappush(heap, (cost + 3, audit + "I", i, after, (*out, (role, ""))))
        if i < len(rows):
            initial, own, text, fault = rows[i]
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, state, out))
            if fault not in ("blank", "duplicate"):
                more = 3 if fault == "truncated" else 0
                heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, after, (*out, (role, text))))
                if (state == 0 and initial == "s") or (initial == role[0]):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, 1 if initial == "s" else after, (*out, (own, text))))


def expected(table, damaged=False):
    convs = defaultdict(list)
    for c, t, role, text in table:
        convs[c]
        role, text = " " if role is None else role, " " if text is None else text
        kind = 99 if damaged else zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        key = (t is not None, t or 0, role, text)
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        convs[c] += [(key, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    for c, rows in convs.items():
        rows.sort(key=lambda r: r[0])
        seen, judged, counts = set(), [], defaultdict(int)
        for _, _, role, text in rows:
            shown = LAST.findall(text)
            fault = "blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated"
            seen.add((role, text))
            counts[fault] += 1
            judged.append((role[:1], role, text, fault))
        turns = {t for _, t, _, _ in rows if t is not None}
        cost, audit, out = cheapest(judged)
        text = "\n".join(f"{r}:{x}" for r, x in out)
        yield (
            c, max(turns) - min(turns) + 1 - len(turns) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"],
            sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:])), cost, audit, hashlib.sha256(text.encode()).hexdigest(),
        )


def run(spark, table, damaged=False):
    frame = spark.createDataFrame([(*r, 1, "x", "y") for r in table], SCHEMA)
    return sorted((tuple(r)[:9] for r in R.repair_conversations(frame, damaged).collect()), key=repr)


@pytest.mark.parametrize("bits", [1, 10])
def test_against_search(spark, monkeypatch, bits):
    monkeypatch.setattr(R, "BLOCK_BITS", bits)
    chance = random.Random(bits)
    table = []
    for c in range(-20, 80):
        for t in range(chance.randint(1, 6)):
            role = chance.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            table.append((c, chance.choice([t, t, t, 2 * t, None]), role, chance.choice(["Yes.", "No!", "open", "", " \n", None, "Why? \t", "é", f"{t}."])))
    table += [(None, 1, "user", "Hi."), (None, None, "assistant", "Ho."), (7, 1, "user", "Hi."), (7, 1, "user", "Hi.")]
    for damaged in (False, True):
        assert run(spark, table, damaged) == sorted(expected(table, damaged), key=repr)


def test_no_rows(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert R.repair_conversations(frame).count() == 0
    dropped = next(t for t in range(100) if zlib.crc32(f"1:{t}".encode()) % 20 == 0)
    assert run(spark, [(1, dropped, "user", "Hi.")]) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_long_conversation(spark):
    """20,000 rows and a text of a million characters: blocks are solved apart and joined."""
    table = [(1, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(20_000)]
    table[5] = (1, 5, "assistant", "x" * 1_000_000)
    table[1999] = (1, 1999, "user", "1999.")
    (row,) = run(spark, table, damaged=True)
    audit = list("K" * 20_000)
    audit[1999] = "R"
    assert row[1:8] == (0, 0, 0, 1, 2, 6, "".join(audit))


def test_blocks_join_to_the_whole():
    chance = random.Random(3)
    for _ in range(200):
        symbols = "".join(chr(65 + chance.randrange(16)) for _ in range(chance.randint(1, 12)))
        answers = set()
        for size in (1, 2, 5, 12):
            rest = [(cost, R.digits_of(audit), len(audit)) for cost, audit in R.ENDS]
            for at in range((len(symbols) - 1) // size * size, -1, -size):
                _, rest = R.join_block(*R.block_paths(symbols[at:at + size]), rest)
            answers.add(rest[0])
        assert len(answers) == 1

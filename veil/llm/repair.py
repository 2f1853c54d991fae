"""Conversation structure repair: cheapest edits by big-integer weights over a DAG.

Rows are first put in order by a range sort, so a long conversation spreads over many
partitions. They are cut into blocks of ``BLOCK`` positions, and every block is solved by
itself, for each state it may be entered and left in. The blocks of a conversation are then
put together from the last to the first, as a stream.

A weight is one integer: the cost in its high digits, below them the audit letters, one
octal digit each, left-aligned in a fixed width and filled up with zeros. The least weight
is the cheapest edit and, among equals, the one with the ASCII-least audit. (Two audits of
equal cost over the same rows never are a prefix of each other: the longer one would hold
more inserts and cost more. So blocks can be solved apart.)
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from veil.llm.common import SPACES, stored, tidy

#: Positions of one block.
BLOCK_BITS = 10

#: States: nothing yet, after a system row, after a user row, after an assistant row.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the one role that may be inserted or given in a state, and that role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: States that a kept row of an initial leads to; symbols count initials as s, u, a, other.
KEPT = ({NOTHING: SYSTEM}, {NOTHING: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})
LEGAL = {(0, 1), (1, 2), (2, 1)}
#: Faults of a row, by number.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)

KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3
LETTERS = " DIKR"
DIGIT = 3
CODE = {c: i for i, c in enumerate(LETTERS)}
#: Cost and letters after the last row, by state.
ENDS = ((0, ""), (2 * INSERT, "II"), (INSERT, "I"), (0, ""))


# Weights

def ahead(weight: int, cost: int, letter: str, width: int) -> int:
    """The weight with an edit put in front of it."""
    bits = DIGIT * width
    return ((weight >> bits) + cost << bits) | CODE[letter] << bits - DIGIT | (weight & (1 << bits) - 1) >> DIGIT


def weigh(cost: int, digits: int, length: int, width: int) -> int:
    return cost << DIGIT * width | digits << DIGIT * (width - length)


def digits_of(audit: str) -> int:
    value = 0
    for c in audit:
        value = value << DIGIT | CODE[c]
    return value


def read(weight: int, width: int) -> tuple[int, str]:
    """(cost, audit) of a weight."""
    bits, letters = DIGIT * width, []
    for at in range(bits - DIGIT, -1, -DIGIT):
        digit = weight >> at & 7
        if not digit:
            break
        letters.append(LETTERS[digit])
    return weight >> bits, "".join(letters)


def solve(symbols: str, leave: int) -> list[int | None]:
    """The least weight from each state before the rows to the state ``leave`` behind them.

    A symbol is a row's initial (0 to 3) times 4 plus its fault, as a character from 'A' on. In front of
    a row stand two inserts at most: a third one would come back to a state that had been reached for less.
    """
    width = 3 * len(symbols)
    least: list[int | None] = [None] * 4
    least[leave] = 0
    for symbol in reversed(symbols):
        initial, fault = divmod(ord(symbol) - 65, 4)
        extra = UNFINISHED if fault == TRUNCATED else 0
        row: list[int | None] = []
        for state in range(4):
            edges = [(DELETE, "D", state)]
            if fault not in (BLANK, DUPLICATE):
                edges.append((REROLE + extra, "R", NEXT[state]))
                if state in KEPT[initial]:
                    edges.append((KEEP + extra, "K", KEPT[initial][state]))
            row.append(min((ahead(least[to], cost, letter, width) for cost, letter, to in edges if least[to] is not None), default=None))
        least = row
        for _ in range(2):
            least = [
                min((w for w in (row[s], None if least[NEXT[s]] is None else ahead(least[NEXT[s]], INSERT, "I", width)) if w is not None), default=None)
                for s in range(4)
            ]
    return least


@lru_cache(maxsize=20_000)
def block_paths(symbols: str) -> tuple[list[int | None], list[str | None]]:
    """Costs and audits of a block from state to state, as lists of 16."""
    costs: list[int | None] = [None] * 16
    audits: list[str | None] = [None] * 16
    for leave in range(4):
        for enter, weight in enumerate(solve(symbols, leave)):
            if weight is not None:
                costs[4 * enter + leave], audits[4 * enter + leave] = read(weight, 3 * len(symbols))
    return costs, audits


def join_block(costs: list[int | None], audits: list[str | None], rest: list[tuple[int, int, int]]) -> tuple[list[int], list[tuple[int, int, int]]]:
    """The state each block is best left in for each it is entered in, and what is then least from there on.

    ``rest`` has (cost, letters as digits, number of letters) of what follows, by state.
    """
    chosen, least = [], []
    for enter in range(4):
        paths = []
        for leave, (cost, digits, length) in enumerate(rest):
            if costs[4 * enter + leave] is not None:
                audit = audits[4 * enter + leave]
                paths.append((costs[4 * enter + leave] + cost, digits_of(audit) << DIGIT * length | digits, len(audit) + length, leave))
        width = max(p[2] for p in paths)
        cost, digits, length, leave = min(paths, key=lambda p: weigh(*p[:3], width))
        chosen.append(leave)
        least.append((cost, digits, length))
    return chosen, least


# Rows

def damage(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, first_role, first_text, copy) after the damage that a row's id and turn decide.

    ``crc32('conv_id:turn') % 20``: 0 drops the row, 1 empties its text, 2 takes ``.``, ``!`` and ``?`` out of it,
    3 repeats it, 4 makes its role user. Null role and text are one space, and so are a null id and turn in the
    hashed text.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), blank).alias("first_role"), F.coalesce(F.col("text").cast("string"), blank).alias("first_text"),
        (F.crc32(key.cast("binary")) % 20).alias("kind"),
    ).where("kind <> 0")
    rows = rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("first_text", "[.!?]", "")).otherwise(F.col("first_text"))
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("first_role")).alias("role"), text.alias("text"), "first_role", "first_text", "copy"
    )


def in_order(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, pos): ``pos`` grows through each conversation, by turn (null first), then role and text before the damage.

    A range sort, so rows of one conversation may lie in many partitions.
    """
    start = F.substring("first_text", 1, 64)
    ranges = rows.repartitionByRange(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("first_role"), start)
    ordered = ranges.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "first_role", "first_text", "copy")
    return ordered.select("conv_id", "turn", "role", "text", F.monotonically_increasing_id().alias("pos"))


def _symbol(first: Column) -> Column:
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    initial = F.substring("role", 1, 1)
    kind = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    fault = F.when(bare == "", BLANK).when(~first, DUPLICATE).when(~F.right(bare, F.lit(1)).isin(".", "!", "?"), TRUNCATED).otherwise(FINE)
    return F.char(F.lit(65) + F.lit(4) * kind + fault)


def blocks_of(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, symbols): runs of at most 2 ** ``BLOCK_BITS`` rows of one conversation, ``pos`` of the first."""
    narrow = rows.select("conv_id", "pos", "role", "text")
    first = narrow.groupBy("conv_id", "role", F.sha2("text", 256).alias("digest")).agg(F.min("pos").alias("first_pos")).select("first_pos")
    marked = narrow.join(first, narrow["pos"] == first["first_pos"], "left")
    marked = marked.select("conv_id", "pos", _symbol(F.col("first_pos").isNotNull()).alias("symbol"))
    grouped = marked.groupBy("conv_id", F.shiftright("pos", BLOCK_BITS).alias("block")).agg(F.sort_array(F.collect_list(F.struct("pos", "symbol"))).alias("run"))
    return grouped.select("conv_id", F.col("run")[0]["pos"].alias("pos"), F.array_join(F.col("run")["symbol"], "").alias("symbols"))


SOLVED = "conv_id bigint, pos bigint, symbols string, costs array<int>, audits array<string>"
JOINED = SOLVED + ", chosen array<int>"
REPAIRED = (
    "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
    "repaired_sha256 string, n_rows bigint, n_repaired bigint"
)
_ARROW = {"bigint": pa.int64(), "string": pa.string(), "int": pa.int32(), "array<int>": pa.list_(pa.int32()), "array<string>": pa.list_(pa.string())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [(c, p, s, *block_paths(s)) for c, p, s in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "pos", "symbols")), strict=True)]
        for at in range(0, len(rows), 256):
            yield _batch(rows[at:at + 256], SOLVED)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, rest = object(), []
    for batch in batches:
        out = []
        for row in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "pos", "symbols", "costs", "audits")), strict=True):
            if row[0] != at:
                at, rest = row[0], [(cost, digits_of(audit), len(audit)) for cost, audit in ENDS]
            chosen, rest = join_block(row[3], row[4], rest)
            out.append((*row, chosen))
        if out:
            yield _batch(out, JOINED)


class _Conversation:
    """One conversation's rows as they come by: a task holds one block's edits and one row."""

    def __init__(self, conv_id: int | None):
        self.conv_id, self.state, self.cost, self.audit = conv_id, NOTHING, 0, []
        self.faults, self.illegal, self.before = [0] * 4, 0, None
        self.turns, self.lowest, self.highest = 0, None, None
        self.digest, self.rows, self.repaired = hashlib.sha256(), 0, 0
        self.edits: Iterator[str] = iter(())
        self.symbols: Iterator[str] = iter(())

    def block(self, symbols: str, costs: list[int], audits: list[str], chosen: list[int]) -> None:
        path = 4 * self.state + chosen[self.state]
        self.cost += costs[path]
        self.audit.append(audits[path])
        self.edits, self.symbols = iter(audits[path]), iter(symbols)

    def put(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.repaired else ''}{role}:{text}".encode("utf-8", "surrogatepass"))
        self.repaired += 1

    def insert(self) -> None:
        self.state = NEXT[self.state]
        self.put(ROLE[self.state], "")

    def row(self, turn: int | None, role: str, text: str) -> None:
        initial, fault = divmod(ord(next(self.symbols)) - 65, 4)
        self.rows += 1
        self.faults[fault] += 1
        self.illegal += self.before is not None and (self.before, initial) not in LEGAL
        self.before = initial
        if turn is not None and turn != self.highest:
            self.turns, self.highest = self.turns + 1, turn
            self.lowest = turn if self.lowest is None else self.lowest
        edit = next(self.edits)
        while edit == "I":
            self.insert()
            edit = next(self.edits)
        if edit == "K":
            self.state = KEPT[initial][self.state]
            self.put(role, text)
        elif edit == "R":
            self.state = NEXT[self.state]
            self.put(ROLE[self.state], text)

    def result(self) -> tuple:
        if self.rows:
            cost, letters = ENDS[self.state]
            self.cost += cost
            self.audit.append(letters)
            for _ in letters:
                self.insert()
        gaps = self.highest - self.lowest + 1 - self.turns if self.turns else 0
        return (self.conv_id, gaps, *self.faults[1:], self.illegal, self.cost, "".join(self.audit), self.digest.hexdigest(), self.rows, self.repaired)


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("conv_id", "pos", "kind", "turn", "role", "text", "symbols", "costs", "audits", "chosen")
    now: _Conversation | None = None
    out: list[tuple] = []
    for batch in batches:
        for conv, pos, kind, turn, role, text, *block in zip(*(batch.column(n).to_pylist() for n in names), strict=True):
            if now is None or conv != now.conv_id:
                if now is not None:
                    out.append(now.result())
                now = _Conversation(conv)
            if kind == 0:
                now.block(*block)
            elif kind == 1:
                now.row(turn, role, text)
        if len(out) >= 1024:
            yield _batch(out, REPAIRED)
            out.clear()
    if now is not None:
        out.append(now.result())
        yield _batch(out, REPAIRED)


def repair(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``REPAIRED`` for each conversation in ``ids`` (conv_id), from ``rows`` as ``in_order`` returns them, stored.

    ``audit`` has one letter for each edit (D, I, K, R) in order. The cheapest edits give role initials
    ``(s?(ua)+)?``; ties go to the ASCII-least audit. Blank and duplicate rows are deleted; a truncated row that
    stays costs 3. A conversation without rows has zeros, an empty audit and the hash of nothing. A null id
    is a conversation of its own; rows with equal turns go by role, then text. Ids in ``ids`` may repeat, an
    empty table gives an empty result, other columns are ignored. A conversation's texts run through
    one task as a stream, since its hash is sequential.
    """
    by_id = F.col("conv_id").asc_nulls_first()
    blocks = blocks_of(rows).mapInArrow(_solved, SOLVED)
    blocks = blocks.repartition("conv_id").sortWithinPartitions(by_id, F.col("pos").desc()).mapInArrow(_joined, JOINED)
    none = lambda kind: F.lit(None).cast(kind)
    turn = [none("bigint").alias("turn"), none("string").alias("role"), none("string").alias("text")]
    block = [none("string").alias("symbols"), none("array<int>").alias("costs"), none("array<string>").alias("audits"), none("array<int>").alias("chosen")]
    parts = (
        ids.select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct().select("conv_id", F.lit(-1).cast("bigint").alias("pos"), F.lit(-1).alias("kind"), *turn, *block)
        .unionAll(blocks.select("conv_id", "pos", F.lit(0).alias("kind"), *turn, "symbols", "costs", "audits", "chosen"))
        .unionAll(rows.select("conv_id", "pos", F.lit(1).alias("kind"), "turn", "role", "text", *block))
    )
    return parts.repartition("conv_id").sortWithinPartitions(by_id, "pos", "kind").mapInArrow(_repaired, REPAIRED)


@tidy
def repair_conversations(turns: DataFrame, damaged: bool = False) -> DataFrame:
    """``repair`` of a table (conv_id, turn, role, text); ``damaged`` says that it shall not be damaged first."""
    if damaged:
        blank = F.lit(" ")
        role, text = (F.coalesce(F.col(c).cast("string"), blank) for c in ("role", "text"))
        rows = turns.select(
            F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"),
            role.alias("first_role"), text.alias("first_text"), F.lit(0).alias("copy"),
        )
    else:
        rows = damage(turns)
    return repair(stored(in_order(rows), "repair-rows"), turns)

"""Conversation prefix trie: subtree totals by time-forward processing.

A conversation is a path from the root; equal beginnings share their nodes. A node is named by a
hash chained over its turns, so nodes are aggregates of paths and copies cost nothing more.

Totals go from the deepest level up. Nodes are dealt to shards by subtree: a node with more turn
rows below it than a shard shall hold is a top node, and what hangs below top nodes goes to shards whole. Each
shard's nodes are sorted by reverse level order (Spark's external sort) and run past a priority queue that
spills: a node takes the messages addressed to it and sends its own totals to its parent. Messages
to nodes that aren't in the shard leave it, summed up by receiver. The same is then done across the
shards' roots, with the top nodes.
"""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from veil.llm.common import stored, tidy
from veil.runtime import measured

#: A subtree of over one of so many parts of all turn rows is cut further down. There are at most so many
#: top nodes on a level.
PARTS = 4096
#: Messages that a queue holds in memory before it spills.
QUEUE_ROWS = 200_000
#: Ids in one piece of a list of ends.
PIECE_IDS = 4096

ROOT = b""
HEADS = 9  # a conversation takes fewer turns than this from its base


def shared_turns(conv_id: Column) -> Column:
    """How many turns a conversation takes from its base."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("bigint")


def turn_digests(turns: DataFrame) -> DataFrame:
    """(conv_id, place, octets, turn): the turns numbered from 0, each with a digest of role and text in place of them."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("at"), role.alias("role"),
        F.sha2(text.cast("binary"), 256).alias("tie"), F.octet_length(text).cast("bigint").alias("octets"), F.unhex(F.substring(digest, 1, 32)).alias("turn"),
    ).where("conv_id is not null")
    order = Window.partitionBy("conv_id").orderBy(F.col("at").asc_nulls_first(), "role", "tie")
    return rows.select("conv_id", (F.row_number().over(order) - 1).cast("bigint").alias("place"), "octets", "turn")


def rebuilt(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, length) and their rebuilt rows (conv_id, place, octets, turn)."""
    base = F.col("conv_id") - F.col("conv_id") % 5
    all_of = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("own")).withColumn("base", base).withColumn("h", shared_turns(F.col("conv_id")))
    lengths = all_of.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = all_of.join(lengths, "base", "left").select(
        "conv_id", (F.least(F.col("h"), F.coalesce("base_own", F.lit(0))) + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length")
    )
    heads = rows.where((F.col("place") < HEADS - 1) & (F.col("conv_id") % 5 == 0)).withColumnRenamed("conv_id", "base")
    taken = heads.join(all_of, "base").where(F.col("place") < F.col("h")).select("conv_id", "place", "octets", "turn")
    own = rows.where(F.col("place") >= shared_turns(F.col("conv_id")))
    return convs, taken.unionAll(own)


PATHS = "conv_id bigint, length bigint, depth bigint, node binary, parent binary, octets bigint"


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The nodes on each conversation's path; rows come by conversation and place, its length first."""
    length, depth, node = 0, 0, ROOT
    for batch in batches:
        out = []
        for conv, place, octets, turn, n in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "octets", "turn", "length")), strict=True):
            if n is not None:
                length, depth, node = n, 0, ROOT
                out.append((conv, length, 0, ROOT, None, 0))
                continue
            depth, parent = depth + 1, node
            node = hashlib.blake2b(parent + turn, digest_size=16).digest()
            out.append((conv, length, depth, node, parent, octets))
        if out:
            yield _batch(out, PATHS)


_ARROW = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")), strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, _ARROW[k]) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=list(names))


def paths_of(convs: DataFrame, rows: DataFrame) -> DataFrame:
    """``PATHS``: a row for each conversation and node it passes, the root included. One conversation runs through one task as a stream."""
    nothing = [F.lit(-1).cast("bigint").alias("place"), F.lit(None).cast("bigint").alias("octets"), F.lit(None).cast("binary").alias("turn")]
    parts = convs.select("conv_id", *nothing, "length").unionAll(rows.select("conv_id", "place", "octets", "turn", F.lit(None).cast("bigint").alias("length")))
    return parts.repartition("conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(_paths, PATHS)


# Time-forward processing

class SpillingQueue:
    """Messages (depth, node, children, leaves, saved), the deepest first, equal receivers summed.

    At most ``limit`` receivers are held in memory; beyond that they go as a sorted run to an unnamed scratch file of
    the task, which ends with it: nobody else reads it, and a task that is run again makes its own.
    """

    _record = struct.Struct(">q16sqqq")

    def __init__(self, limit: int = QUEUE_ROWS):
        self.limit = limit
        self.heap: list[tuple[int, bytes]] = []
        self.sums: dict[tuple[int, bytes], list[int]] = {}
        self.runs: list[tuple] = []
        self.spilled = 0

    def push(self, depth: int, node: bytes, children: int, leaves: int, saved: int) -> None:
        key = (-depth, node)
        held = self.sums.get(key)
        if held is None:
            if len(self.sums) >= self.limit:
                self._spill()
            self.sums[key] = [children, leaves, saved]
            heapq.heappush(self.heap, key)
        else:
            held[0] += children
            held[1] += leaves
            held[2] += saved

    def _spill(self) -> None:
        file = tempfile.TemporaryFile()
        for key in sorted(self.heap):
            file.write(self._record.pack(key[0], key[1].ljust(16, b"\0"), *self.sums[key]))
        file.seek(0)
        self.heap, self.sums = [], {}
        self.spilled += 1
        self._next(file)

    def _next(self, file) -> None:
        data = file.read(self._record.size)
        if data:
            depth, node, *sums = self._record.unpack(data)
            heapq.heappush(self.runs, (depth, node if depth else ROOT, self.spilled, id(file), sums, file))
        else:
            file.close()

    def first(self) -> tuple[int, bytes] | None:
        """The next receiver, as (-depth, node)."""
        heads = [x[0] for x in (self.heap,) if x] + [x[0][:2] for x in (self.runs,) if x]
        return min(heads, default=None)

    def pop(self) -> list[int]:
        """The sums of the next receiver."""
        key, sums = self.first(), [0, 0, 0]
        if self.heap and self.heap[0] == key:
            heapq.heappop(self.heap)
            sums = self.sums.pop(key)
        while self.runs and self.runs[0][:2] == key:
            *_, more, file = heapq.heappop(self.runs)
            sums = [a + b for a, b in zip(sums, more, strict=True)]
            self._next(file)
        return sums


NODES = "node binary, depth bigint, parent binary, conv_id bigint, n_convs bigint, octets bigint, n_children bigint, n_leaves bigint, saved_tokens bigint"
SWEPT = NODES + ", here boolean"


def sweep(limit: int = QUEUE_ROWS):
    """A function of batches of ``NODES`` in reverse level order that gives them with whole totals.

    What came in as totals is what nodes elsewhere have sent. Rows with ``here`` false are sums for receivers
    that weren't among the nodes.
    """

    def up(key, sums):
        return (key[1], -key[0], None, None, None, None, *sums, False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queue = SpillingQueue(limit)
        names = [x.split()[0] for x in NODES.split(", ")]
        for batch in batches:
            out = []
            for node, depth, parent, conv, n, octets, *sums in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                while (key := queue.first()) is not None and key < (-depth, node):
                    out.append(up(key, queue.pop()))
                if key == (-depth, node):
                    sums = [a + b for a, b in zip(sums, queue.pop(), strict=True)]
                children, leaves, saved = sums
                leaves, saved = leaves if children else 1, saved + (n - 1) * octets
                out.append((node, depth, parent, conv, n, octets, children, leaves, saved, True))
                if parent is not None:
                    queue.push(depth - 1, parent, 1, leaves, saved)
                if len(out) >= 4096:
                    yield _batch(out, SWEPT)
                    out.clear()
            if out:
                yield _batch(out, SWEPT)
        out = []
        while (key := queue.first()) is not None:
            out.append(up(key, queue.pop()))
            if len(out) >= 4096:
                yield _batch(out, SWEPT)
                out.clear()
        if out:
            yield _batch(out, SWEPT)

    return run


def _swept(nodes: DataFrame, limit: int) -> DataFrame:
    names = [x.split()[0] for x in NODES.split(", ")]
    return nodes.select(*names).sortWithinPartitions(F.col("depth").desc(), "node").mapInArrow(sweep(limit), SWEPT)


def totals(paths: DataFrame, parts: int = PARTS, limit: int = QUEUE_ROWS) -> DataFrame:
    """``NODES`` with their whole totals."""
    nodes = stored(
        paths.groupBy("node", "depth", "parent").agg(
            F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("octets").alias("octets"),
            F.sum(F.col("length") - F.col("depth") + 1).alias("below"),
        ), "trie-nodes",
    )
    zero = [F.lit(0).cast("bigint").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    all_rows = nodes.where("depth = 0").agg(F.sum("below")).first()[0] or 0
    is_top = (F.col("below") > -(-all_rows // parts)) | (F.col("depth") == 0)
    top = nodes.where(is_top).drop("below")
    # The first node of a conversation that isn't a top node names the shard of all that follow.
    marked = paths.join(measured(top.select(F.col("node").alias("top_node"), F.col("depth").alias("top_depth"))), (F.col("node") == F.col("top_node")) & (F.col("depth") == F.col("top_depth")), "left_anti")
    shards = marked.groupBy("conv_id").agg(F.min(F.struct("depth", "node"))["node"].alias("shard"))
    low = nodes.where(~is_top).join(shards, "conv_id").select("*", *zero)
    swept = stored(_swept(low.repartition("shard"), limit), "trie-shards")
    sent = swept.where("not here").groupBy("node", "depth").agg(*(F.sum(c).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")))
    upper = top.join(sent, ["node", "depth"], "left").fillna(0, ["n_children", "n_leaves", "saved_tokens"])
    return swept.where("here").unionAll(_swept(upper.repartition(1), limit)).drop("here")


# Ends

def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted ids of a node, joined by commas, in pieces of bounded length."""
    at, first, ids, out = None, 0, [], []

    def close():
        if ids:
            out.append((at, first, ",".join(ids)))

    for batch in batches:
        for node, conv in zip(batch.column("node").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
            if node != at or len(ids) >= PIECE_IDS:
                close()
                at, first, ids = node, conv, []
            ids.append(str(conv))
        if out:
            yield _batch(out, "node binary, first bigint, ids string")
            out.clear()
    close()
    if out:
        yield _batch(out, "node binary, first bigint, ids string")


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, digest, out = None, None, []
    for batch in batches:
        for node, ids in zip(batch.column("node").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if digest is None or node != at:
                if digest is not None:
                    out.append((at, digest.hexdigest()))
                at, digest = node, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.encode())
        if out:
            yield _batch(out, "node binary, ends_sha256 string")
            out.clear()
    if digest is not None:
        yield _batch([(at, digest.hexdigest())], "node binary, ends_sha256 string")


def ends_of(paths: DataFrame) -> DataFrame:
    """(node, ends_sha256) of the nodes where conversations end.

    Ids are range-sorted and joined into pieces first, so a node where a third of all end is spread as well; what its one
    digest has to run through are some thousand ids in a row.
    """
    ends = paths.where(F.col("depth") == F.col("length")).select("node", "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    pieces = ends.mapInArrow(_pieces, "node binary, first bigint, ids string")
    return pieces.repartition("node").sortWithinPartitions("node", "first").mapInArrow(_ends, "node binary, ends_sha256 string")


@tidy
def prefix_trie(turns: DataFrame, parts: int = PARTS, limit: int = QUEUE_ROWS) -> DataFrame:
    """A row for each node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    ``turns`` (conv_id, turn, role, text) in order of turn, null first, then role, then the SHA-256 of the
    text; null role and text are empty. Rows without an id belong to no conversation and are left out;
    repeated rows are repeated turns; other columns are ignored; an empty table gives an empty result. ``%`` keeps
    the sign of a negative id, as in SQL. Nodes are told apart by 128-bit hashes.
    """
    rows = stored(turn_digests(turns), "trie-turns")
    paths = stored(paths_of(*rebuilt(rows)), "trie-paths")
    nodes = totals(paths, parts, limit)
    above = nodes.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"), (F.col("depth") + 1).alias("depth"))
    with_parent = nodes.join(above, (nodes["parent"] == above["above"]) & (nodes["depth"] == above["depth"]), "left").drop(above["depth"])
    return with_parent.join(ends_of(paths), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )

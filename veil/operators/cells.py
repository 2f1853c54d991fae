"""Versioned cells: typed row views, version selection, and the way back to cells.

Order of evaluation of :func:`to_rows`: scope and projection filter, time
filter, newest versions per cell, value decoding, then merging (one row per
key) or flattening (one row per key and timestamp). Predicates put on the
result therefore see the newest version inside the time window.

A cell is identified by (key, family, qualifier, timestamp). Should a table
hold several rows for one cell, ``tie`` names the columns whose greater value
wins, so results do not depend on the order of the rows. Where the identity is
known to hold, ``tie=()`` lets fixed-width columns use hash aggregation.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from veil.functions.coders import Coder, decoder
from veil.functions.codec import bits, bits_to_bytes, float_steps, from_bits, from_bytes, to_bytes
from veil.functions.keys import key_bytes, key_parts
from veil.functions.values import decode_value, encode_value, to_text
from veil.runtime import measured
from veil.spec import (
    CF, FIXED_WIDTH, QUALIFIER, TS, VALUE, CellColumn, CellSpec, any_of, cell_spec, check_time_options, parse_type,
)

SLICES = 4096
#: Rows of one cell that may come together in a task when each input partition keeps its newest ones.
ROWS_OF_A_CELL = 1_000_000
MAP_PART = "map_part"
_GATHER = "_gather"
#: Partitions that the cells of one key may be dealt to where adaptive execution can't split a partition.
SPREAD = 16


# --- time -------------------------------------------------------------------

def at(cells: DataFrame, timestamp: int) -> DataFrame:
    """Only the cells written at one timestamp."""
    return cells.filter(F.col(TS) == timestamp)


def between(cells: DataFrame, min_ts: int, max_ts: int) -> DataFrame:
    """Cells of the half-open time range ``[min_ts, max_ts)``."""
    check_time_options(min_ts=min_ts, max_ts=max_ts)
    return cells.filter((F.col(TS) >= min_ts) & (F.col(TS) < max_ts))


def in_time(cells: DataFrame, timestamp=None, min_ts=None, max_ts=None) -> DataFrame:
    check_time_options(timestamp, min_ts, max_ts)
    if timestamp is not None:
        return at(cells, timestamp)
    if min_ts is not None:
        return between(cells, min_ts, max_ts)
    return cells


# --- versions ---------------------------------------------------------------

def _gathered(cells: DataFrame, by: Sequence[str], apart: Sequence[str] = (TS,)) -> DataFrame:
    """Cells whose ``by`` agree next to each other, in partitions of bounded size.

    An aggregation that isn't of fixed width sorts or keeps a whole input partition before the shuffle, and one
    row group of a file can unfold to any number of cells. The rows of a hot group may be split over several
    partitions here; each is combined on its own before the aggregation's own shuffle.

    Up to ``spark.shuffle.sort.bypassMergeThreshold`` partitions a task writes every row straight to its partition's
    file; with more it would keep and sort all that it unfolds. Adaptive execution splits those that get too large.
    Without it the hint counts for nothing: then a repartition deals cells out, and the cells of a hot key go to
    several partitions by the columns ``apart``.
    """
    spark = cells.sparkSession
    n = spark._jsparkSession.sessionState().conf().numShufflePartitions()
    unsorted = int(spark.conf.get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    n = min(n, unsorted) if unsorted > 0 else n
    if spark.conf.get("spark.sql.adaptive.enabled").lower() != "true":
        apart = [c for c in apart if c in cells.columns]
        spread = [F.pmod(F.xxhash64(*apart), F.lit(SPREAD))] if apart else []
        return cells.withColumn(_GATHER, F.xxhash64(*by, *spread)).repartition(n, _GATHER).drop(_GATHER)
    return cells.withColumn(_GATHER, F.xxhash64(*by)).hint("rebalance", n, _GATHER).drop(_GATHER)


def _fixed_width(cells: DataFrame) -> bool:
    return type(cells.schema[VALUE].dataType) in FIXED_WIDTH


def _age(tie: Sequence[str]) -> Column:
    """Sorts a cell's versions from old to new."""
    return F.struct(TS, *tie) if tie else F.col(TS)


def _newest(match: Column, value: Column, tie: Sequence[str]) -> Column:
    """The newest ``value`` among matching cells; merges map-side, so hot keys stay cheap."""
    if tuple(tie) == (VALUE,):
        return F.max(F.when(match, F.struct(F.col(TS), F.col(VALUE))))[VALUE]
    return F.max_by(F.when(match, value), F.when(match, _age(tie)))


def _newest_value(tie: Sequence[str]) -> Column:
    """The newest value of a group that holds the versions of one cell."""
    if tuple(tie) == (VALUE,):
        return F.max(F.struct(TS, VALUE))[VALUE]
    return F.max_by(F.col(VALUE), _age(tie))


def _one_value(value: Column, tie: Sequence[str]) -> Column:
    """The value that counts among rows of the same cell and timestamp."""
    tie = [c for c in tie if c != TS]
    if tie in ([], [VALUE]):
        return F.max(value)
    return F.max_by(value, F.when(value.isNotNull(), F.struct(*tie)))


def last_versions(
    cells: DataFrame, keys: Sequence[str], n: int | None = 1, tie: Sequence[str] = (VALUE,)
) -> DataFrame:
    """The newest ``n`` versions of every cell (``None``: all rows as they are).

    A version is a timestamp; of rows that repeat one, the greatest in ``tie`` counts.

    ``n = 1`` is an aggregate with map-side combine. For small ``n`` Spark
    prunes every input partition to ``n`` rows per cell before the shuffle
    (window group limit). Beyond that limit, or where there are so many input
    partitions that their rows add up, the rows of a cell are first ranked in
    slices that follow the input partitions, so that a cell holding a large
    share of the table is never sorted in one task as a whole.
    """
    if n is None:
        return cells
    if n < 1:
        raise ValueError("at least one version must be kept")
    cell = [*keys, CF, QUALIFIER]
    rest = [c for c in cells.columns if c not in cell]
    if n == 1:
        newest = cells.groupBy(*cell).agg(F.max_by(F.struct(*rest), _age(tie)).alias("_c"))
        return newest.select(*cell, "_c.*").select(*cells.columns)
    pruned = cells
    n_slices = _slices(cells, n)
    if n_slices:
        slices = Window.partitionBy(*cell, "_slice").orderBy(F.desc(TS))
        pruned = (
            cells.withColumn("_slice", F.spark_partition_id() % n_slices)
            .withColumn("_rank", F.dense_rank().over(slices))
            .filter(F.col("_rank") <= n)
            .drop("_slice", "_rank")
        )
    versions = Window.partitionBy(*cell).orderBy(F.desc(TS))
    kept = pruned.withColumn("_rank", F.dense_rank().over(versions)).filter(F.col("_rank") <= n).drop("_rank")
    # Rows that repeat a timestamp are one version: only its first row in tie order stays.
    repeats = Window.partitionBy(*cell).orderBy(F.desc(TS), *[F.desc(c) for c in tie if c != TS])
    newer = F.lag(F.struct(TS)).over(repeats)
    return kept.withColumn("_newer", newer).filter(~F.col("_newer").eqNullSafe(F.struct(TS))).drop("_newer")


def _slices(cells: DataFrame, n: int) -> int | None:
    """Slices to rank the newest ``n`` versions in first; none if the pruned rows of a cell fit into a task anyway."""
    conf = cells.sparkSession.conf
    if n > int(conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000")):
        return SLICES
    size = int(str(cells._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    share = cells.sparkSession._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    partitions = max(size // share, int(conf.get("spark.sql.shuffle.partitions")))
    return min(SLICES, math.isqrt(partitions) + 1) if partitions * n > ROWS_OF_A_CELL else None


def compact(cells: DataFrame, keys: Sequence[str], tie: Sequence[str] = (VALUE,), n: int | None = None) -> DataFrame:
    """One row per (key, family, qualifier, timestamp), optionally only the newest ``n`` versions."""
    cell = [*keys, CF, QUALIFIER, TS]
    rest = [c for c in cells.columns if c not in cell]
    one = (
        cells.groupBy(*cell)
        .agg(F.max_by(F.struct(*rest), F.struct(*tie) if tie else F.lit(0)).alias("_c"))
        .select(*cell, "_c.*")
        .select(*cells.columns)
    )
    return last_versions(one, keys, n, tie)


# --- reading ----------------------------------------------------------------

def scope_filter(spec: CellSpec, columns: Sequence[CellColumn], scope: str) -> Column | None:
    """Which cells a projection needs; plain comparisons, so they reach the Parquet scan."""
    if scope not in ("column", "family", "none"):
        raise ValueError(f"unknown scope {scope!r}")
    if scope == "none" or not columns:
        return None
    families = list(dict.fromkeys(c.cf for c in columns))
    if scope == "family":
        return F.col(CF).isin(families)
    for c in columns:
        if c.is_dynamic:
            raise ValueError(f"dynamic column {c.name!r} needs scope 'family' or 'none'")
    return any_of([
        (F.col(CF) == cf) & F.col(QUALIFIER).isin([c.qualifier for c in columns if c.cf == cf])
        for cf in families
    ])


def _typed_keys(cells: DataFrame, spec: CellSpec) -> DataFrame:
    """Cells with their keys in the types that the spec declares."""
    other = {k.name: F.col(f"`{k.name}`").cast(k.type) for k in spec.keys if cells.schema[k.name].dataType != k.type}
    return cells.withColumns(other) if other else cells


def _split_projection(spec: CellSpec, columns: Sequence[str] | None):
    names = list(columns) if columns is not None else spec.names
    return names, [spec.column(n) for n in names if n not in spec.key_names]


class _Decoder:
    """Chooses how the value of a column is decoded."""

    def __init__(self, cells: DataFrame, decoders: Mapping[str, Coder | Callable[[Column], Column]] | None):
        self.stored = cells.schema[VALUE].dataType
        self.custom = {name: decoder(d) for name, d in (decoders or {}).items()}

    def __call__(self, column: CellColumn, value: Column) -> Column:
        if column.name in self.custom:
            return self.custom[column.name](value)
        if isinstance(self.stored, T.BinaryType):
            return from_bytes(value, column.value_type)
        return decode_value(value, self.stored, column.value_type)

    def early(self, column: CellColumn, tie: Sequence[str]) -> bool:
        """Can the value be decoded before the aggregation, to keep its buffer fixed-width?

        Only where that cannot change which of two tied values wins.
        """
        if column.name in self.custom or type(column.value_type) not in FIXED_WIDTH:
            return False
        return VALUE not in tie or self.stored == column.value_type


def to_rows(
    cells: DataFrame,
    spec,
    columns: Sequence[str] | None = None,
    *,
    scope: str = "column",
    timestamp: int | None = None,
    min_ts: int | None = None,
    max_ts: int | None = None,
    max_versions: int | None = 1,
    merge_to_latest: bool = True,
    keep_ts: bool = False,
    decoders: Mapping[str, Coder | Callable[[Column], Column]] | None = None,
    tie: Sequence[str] = (VALUE,),
    split_maps_over: int | None = None,
) -> DataFrame:
    """Typed view of a cell table, in the requested column order.

    A key shows up when at least one of its cells is left after the scope,
    time and version steps; a column without a cell is null.

    Series maps hold at most ``max_versions`` entries per cell, so they need
    that bound; whole histories come from :func:`series`, in long form. A
    dynamic map has one entry per qualifier of the key; where a key may have
    very many, give ``split_maps_over``: such a key is then spread over several
    rows, numbered by ``map_part``, whose maps add up to the whole.
    """
    spec = cell_spec(spec)
    cells = _typed_keys(cells, spec)
    check_time_options(timestamp, min_ts, max_ts)
    if not merge_to_latest:
        return flatten_versions(
            cells, spec, columns, scope=scope, timestamp=timestamp, min_ts=min_ts, max_ts=max_ts,
            max_versions=max_versions, keep_ts=keep_ts, decoders=decoders, tie=tie,
        )
    names, wanted = _split_projection(spec, columns)
    needed = scope_filter(spec, wanted, scope)
    scoped = in_time(cells if needed is None else cells.filter(needed), timestamp, min_ts, max_ts)
    decode = _Decoder(cells, decoders)
    maps = any(c.is_dynamic or c.is_series for c in wanted)
    if wanted and not _fixed_width(cells):
        # maps are combined cell by cell, so a wide key's cells of one time may part
        scoped = _gathered(scoped, spec.key_names, [TS, CF, QUALIFIER] if maps else [TS])
    if maps:
        return _rows_with_maps(scoped, spec, names, wanted, decode, max_versions, tie, split_maps_over)

    aggregates, after = [], {}
    for c in wanted:
        match = spec.match(c)
        if not tie and decode.early(c, tie):
            # fixed-width buffers: the aggregation is hash-based, without any sort
            aggregates.append(_newest(match, decode(c, F.col(VALUE)), tie).alias(c.name))
        else:
            aggregates.append(_newest(match, F.col(VALUE), tie).alias(c.name))
            after[c.name] = decode(c, F.col(f"`{c.name}`")).alias(c.name)
    if not aggregates:
        return scoped.select(*spec.key_names).distinct().select(*names)
    merged = scoped.groupBy(*spec.key_names).agg(*aggregates)
    return merged.select(*[after.get(n, F.col(f"`{n}`")) for n in names])


def _rows_with_maps(scoped, spec, names, wanted, decode, n, tie, split_maps_over) -> DataFrame:
    keys = spec.key_names
    cell = [*keys, CF, QUALIFIER]
    histories = any(c.is_series for c in wanted)
    if histories and n is None:
        raise ValueError("a series map needs max_versions; use series() for whole histories")
    # one row per cell: its newest value and, for histories, its versions
    parts = [_newest_value(tie).alias("_latest")]
    if histories:
        kept = last_versions(scoped, keys, n, tie)
        if n > 1:
            kept = kept.groupBy(*cell, TS).agg(_one_value(F.col(VALUE), tie).alias(VALUE))
        source, parts = kept, [
            F.max_by(F.col(VALUE), F.col(TS)).alias("_latest"),
            F.collect_list(F.struct(F.col(TS), F.col(VALUE))).alias("_versions"),
        ]
    else:
        source = scoped
    per_cell = source.groupBy(*cell).agg(*parts)

    def history(c: CellColumn) -> Column:
        entries = F.transform(F.col("_versions"), lambda v: F.struct(v[TS], decode(c, v[VALUE])))
        return F.map_from_entries(entries)

    group = list(keys)
    if split_maps_over is not None:
        per_cell = _spread_wide_keys(per_cell, spec, wanted, split_maps_over)
        group.append(MAP_PART)

    aggregates = []
    for c in wanted:
        match = spec.match(c)
        value = history(c) if c.is_series else decode(c, F.col("_latest"))
        if not c.is_dynamic:
            aggregates.append(F.first(F.when(match, value), ignorenulls=True).alias(c.name))
            continue
        entry = F.struct(spec.map_key(c).alias("k"), value.alias("v"), F.col(QUALIFIER).alias("q"))
        aggregates.append(
            F.when(
                F.count_if(F.col(CF) == c.cf) > 0,
                _entries_to_map(F.collect_list(F.when(match, entry)), c.regex is not None),
            ).alias(c.name)
        )
    extra = [MAP_PART] if split_maps_over is not None else []
    return per_cell.groupBy(*group).agg(*aggregates).select(*names, *extra)


def _entries_to_map(entries: Column, keys_may_repeat: bool) -> Column:
    if keys_may_repeat:
        # qualifiers can capture the same text: the last one in qualifier order wins
        entries = F.array_sort(
            entries,
            lambda a, b: F.when(a["k"] < b["k"], -1).when(a["k"] > b["k"], 1)
            .when(a["q"] < b["q"], -1).when(a["q"] > b["q"], 1).otherwise(0),
        )
        entries = F.transform(
            F.array(entries),
            lambda all_: F.filter(all_, lambda e, i: ~F.coalesce(F.get(all_, i + 1)["k"] == e["k"], F.lit(False))),
        )[0]
    return F.map_from_entries(F.transform(entries, lambda e: F.struct(e["k"], e["v"])))


def _spread_wide_keys(per_cell: DataFrame, spec: CellSpec, wanted, limit: int) -> DataFrame:
    """Number the slices of keys with more than ``limit`` dynamic entries; all others get part 0."""
    keys = spec.key_names
    dynamic = any_of([spec.match(c) for c in wanted if c.is_dynamic] or [F.lit(False)])
    sizes = per_cell.groupBy(*keys).agg(F.count_if(dynamic).alias("_n"))
    wide = sizes.filter(F.col("_n") > limit).select(*keys, F.ceil(F.col("_n") / limit).alias("_parts"))
    spread = F.pmod(F.xxhash64(F.col(CF), F.col(QUALIFIER)), F.col("_parts"))
    return (
        per_cell.join(measured(wide), keys, "left")
        .withColumn(MAP_PART, F.when(dynamic & F.col("_parts").isNotNull(), spread).otherwise(0).cast("int"))
        .drop("_parts")
    )


def flatten_versions(
    cells: DataFrame,
    spec,
    columns: Sequence[str] | None = None,
    *,
    scope: str = "column",
    timestamp: int | None = None,
    min_ts: int | None = None,
    max_ts: int | None = None,
    max_versions: int | None = 1,
    keep_ts: bool = False,
    decoders: Mapping[str, Coder | Callable[[Column], Column]] | None = None,
    tie: Sequence[str] = (VALUE,),
) -> DataFrame:
    """One row per key and distinct timestamp; columns without a cell at that time are null.

    Without ``keep_ts`` the timestamp is left out and equal rows collapse.
    """
    spec = cell_spec(spec)
    cells = _typed_keys(cells, spec)
    check_time_options(timestamp, min_ts, max_ts)
    names, wanted = _split_projection(spec, columns)
    if any(c.is_dynamic or isinstance(c.type, T.MapType) for c in wanted):
        raise ValueError("flattening works on plain value columns, not on maps")
    needed = scope_filter(spec, wanted, scope)
    if wanted:
        needed = scope_filter(spec, wanted, "column")
    scoped = in_time(cells if needed is None else cells.filter(needed), timestamp, min_ts, max_ts)
    kept = last_versions(scoped, spec.key_names, max_versions, tie)
    group = [*spec.key_names, TS]
    decode = _Decoder(cells, decoders)
    out = names + ([TS] if keep_ts and TS not in names else [])
    if not wanted:
        return kept.select(*out).distinct()
    aggregates, after = [], {}
    for c in wanted:
        match = spec.match(c)
        early = decode.early(c, tie)
        value = decode(c, F.col(VALUE)) if early else F.col(VALUE)
        aggregates.append(_one_value(F.when(match, value), tie).alias(c.name))
        if not early:
            after[c.name] = decode(c, F.col(f"`{c.name}`")).alias(c.name)
    rows = kept.groupBy(*group).agg(*aggregates).select(*[after.get(n, F.col(f"`{n}`")) for n in out])
    return rows if keep_ts else rows.distinct()


def series(cells: DataFrame, spec, name: str, *, timestamp=None, min_ts=None, max_ts=None,
           max_versions: int | None = 1, tie: Sequence[str] = (VALUE,)) -> DataFrame:
    """Long form of a series or dynamic column: one row per map entry, nothing collected per key."""
    spec = cell_spec(spec)
    cells = _typed_keys(cells, spec)
    c = spec.column(name)
    scoped = in_time(cells.filter(spec.match(c)), timestamp, min_ts, max_ts)
    kept = last_versions(scoped, spec.key_names, max_versions if c.is_series else 1, tie)
    decode = _Decoder(cells, None)
    entry = []
    if c.is_dynamic:
        entry.append(spec.map_key(c).alias("name"))
    if c.is_series:
        entry.append(F.col(TS))
    return kept.select(*spec.key_names, *entry, decode(c, F.col(VALUE)).alias(VALUE))


def map_entries(
    cells: DataFrame, spec, name: str, *, timestamp=None, min_ts=None, max_ts=None, max_versions: int = 1, tie: Sequence[str] = (VALUE,),
) -> DataFrame:
    """(keys, ``name``, ``value``): the entries of a dynamic column, one row each.

    A history has its at most ``max_versions`` versions as a map in ``value``. Where a pattern captures the same text from
    several qualifiers, the last one in qualifier order counts.
    """
    spec = cell_spec(spec)
    c = spec.column(name)
    if not c.is_dynamic:
        raise ValueError(f"column {name!r} has no entries by qualifier")
    cells = _typed_keys(cells, spec)
    keys, decode = spec.key_names, _Decoder(cells, None)
    scoped = in_time(cells.filter(spec.match(c)), timestamp, min_ts, max_ts)
    if c.is_series:
        kept = last_versions(scoped, keys, max_versions, tie)
        one = kept.groupBy(*keys, CF, QUALIFIER, TS).agg(_one_value(F.col(VALUE), tie).alias(VALUE))
        versions = F.map_from_entries(F.collect_list(F.struct(F.col(TS), decode(c, F.col(VALUE)))))
        per_cell = one.groupBy(*keys, QUALIFIER).agg(versions.alias("_value"))
    else:
        per_cell = scoped.groupBy(*keys, QUALIFIER).agg(_newest_value(tie).alias("_value")).withColumn("_value", decode(c, F.col("_value")))
    named = per_cell.select(*keys, spec.map_key(c).alias("_name"), QUALIFIER, "_value")
    if c.regex is not None:
        named = named.groupBy(*keys, "_name").agg(F.max_by("_value", QUALIFIER).alias("_value"))
    return named.select(*keys, F.col("_name").alias("name"), F.col("_value").alias(VALUE))


def map_parts(cells: DataFrame, spec, name: str, entries: int = 100_000, **options) -> DataFrame:
    """(keys, ``map_part``, the column): a dynamic column as maps of at most ``entries`` entries.

    The entries (see :func:`map_entries`) are range-sorted by key and name, and the sorted stream is cut every ``entries``
    rows. So a key with any number of qualifiers is spread over tasks and rows, nothing is
    measured first, and no task ever holds more than one part. The maps of a key add up to
    the whole; ``map_part`` grows in the order of names, with gaps. A narrow key that a cut
    happens to meet has two parts.
    """
    spec = cell_spec(spec)
    keys = spec.key_names
    order = [*keys, "name"]
    ordered = map_entries(cells, spec, name, **options).repartitionByRange(*order).sortWithinPartitions(*order)
    cut = F.floor(F.monotonically_increasing_id() / F.lit(entries)).cast("bigint")
    part = ordered.withColumn(MAP_PART, cut)
    return part.groupBy(*keys, MAP_PART).agg(F.map_from_entries(F.collect_list(F.struct("name", VALUE))).alias(name))


# --- counts and structure ---------------------------------------------------

def count_rows(cells: DataFrame, spec) -> DataFrame:
    """Number of keys, reading the key columns only."""
    keys = cell_spec(spec).key_names
    return cells.select(*keys).distinct().agg(F.count(F.lit(1)).alias("rows"))


def families(cells: DataFrame) -> DataFrame:
    return cells.select(CF).distinct()


# Text patterns of the types a cell value can be taken for.
TYPE_PATTERNS = {
    "boolean": r"^(true|false)$",
    "bigint": r"^[+-]?[0-9]+$",
    "double": r"^[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)([eE][+-]?[0-9]+)?$",
}


def discover_schema(cells: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What an unknown cell table holds: cells, rows and the narrowest fitting type per column.

    Cells are first brought together by (family, qualifier, key), so one huge
    column or key is spread over all tasks, and no distinct count is needed.
    """
    stored = cells.schema[VALUE].dataType
    value = F.col(VALUE)
    if isinstance(stored, T.StringType):
        # The narrowest type of each cell, by number; whole numbers beyond the type's range are not taken for it.
        whole = value.rlike(TYPE_PATTERNS["bigint"]) & value.try_cast("bigint").isNotNull()
        narrow = F.when(value.rlike(TYPE_PATTERNS["boolean"]), 0).when(whole, 1).when(value.rlike(TYPE_PATTERNS["double"]), 2).otherwise(3)
        low, high = F.min("low"), F.max("high")
        kind = (
            F.when(high == 0, "boolean").when((low >= 1) & (high == 1), "bigint").when((low >= 1) & (high == 2), "double")
            .otherwise("string")
        )
    else:
        narrow, kind = F.lit(None).cast("int"), F.lit(stored.simpleString())
    narrow = F.when(value.isNotNull(), narrow)
    per_row = _gathered(cells, [CF, QUALIFIER, *keys]).groupBy(CF, QUALIFIER, *keys).agg(F.count(F.lit(1)).alias("n"), F.min(narrow).alias("low"), F.max(narrow).alias("high"))
    rows = F.count(F.col(keys[0]) if len(keys) == 1 else F.lit(1))
    return per_row.groupBy(CF, QUALIFIER).agg(F.sum("n").alias("cells"), rows.alias("rows"), kind.alias("type"))


# --- writing ----------------------------------------------------------------

def to_cells(
    df: DataFrame, spec, ts: int | None = None, stored: str | T.DataType = "string", coders: Mapping[str, Coder] | None = None,
) -> DataFrame:
    """Rows to cells, in one pass over ``df``. A column in ``coders`` is stored as its coder says.

    Null values, null maps and null map values make no cell, so they never
    overwrite an older value. All cells without a timestamp of their own get
    ``ts``, by default the driver's clock at this call: one value for the
    whole write, which also stays the same when tasks are repeated.
    """
    spec = cell_spec(spec)
    stored = parse_type(stored)
    clock = F.lit(int(time.time() * 1000) if ts is None else ts).cast("bigint")

    def form(c: CellColumn, value: Column) -> Column:
        if coders and c.name in coders:
            return coders[c.name].encode(value).cast(stored)
        return encode_value(value, c.value_type, stored)

    def cell(c: CellColumn, qualifier, stamp, value) -> Column:
        return F.struct(
            F.lit(c.cf).alias(CF),
            (F.lit(qualifier) if isinstance(qualifier, str) else qualifier).alias(QUALIFIER),
            stamp.alias(TS),
            form(c, value).alias(VALUE),
        )

    def map_cells(c: CellColumn) -> Column:
        """Cells of one map column; the map keys are qualifiers, timestamps, or both."""
        entries = F.map_entries(F.col(f"`{c.name}`"))
        if not c.is_dynamic:
            return F.transform(entries, lambda e: cell(c, c.qualifier, e["key"], e["value"]))
        if not c.is_series:
            return F.transform(entries, lambda e: cell(c, e["key"], clock, e["value"]))
        return F.flatten(F.transform(entries, lambda q: F.transform(
            F.coalesce(F.map_entries(q["value"]), F.array()), lambda v: cell(c, q["key"], v["key"], v["value"])
        )))

    single, lists = [], []
    for c in spec.columns:
        if c.name not in df.columns:
            continue
        if c.is_dynamic or c.is_series:
            lists.append(map_cells(c))
        else:
            single.append(cell(c, c.qualifier, clock, F.col(f"`{c.name}`")))
    pieces = ([F.array(*single)] if single else []) + [F.coalesce(l, F.array()) for l in lists]
    if not pieces:
        raise ValueError("the frame has none of the columns of the spec")
    all_cells = pieces[0] if len(pieces) == 1 else F.concat(*pieces)
    return (
        df.select(*spec.key_names, F.inline(all_cells))
        .filter(F.col(VALUE).isNotNull())
    )


def _by_type(spec: CellSpec, convert: Callable[[T.DataType], Column], otherwise: Column) -> Column:
    """Convert each cell by its column's value type, spelling every conversion once per type."""
    out = otherwise
    for kind in dict.fromkeys(c.value_type for c in spec.columns):
        match = any_of([spec.match(c) for c in spec.columns if c.value_type == kind])
        out = F.when(match, convert(kind)).otherwise(out)
    return out


def _own_forms(spec: CellSpec, coders: Mapping[str, Coder] | None, convert: Callable[[CellColumn, Coder], Column], otherwise: Column) -> Column:
    """Cells of columns with a coder by their coder, all others as before."""
    for name, coder in (coders or {}).items():
        c = spec.column(name)
        otherwise = F.when(spec.match(c), convert(c, coder)).otherwise(otherwise)
    return otherwise


def decode_cells(raw: DataFrame, spec, rowkey: str = "rowkey", coders: Mapping[str, Coder] | None = None) -> DataFrame:
    """A dump of raw binary cells (key and value) as cells with typed keys and text values.

    Cells of undeclared columns keep their place with a null value, and so do numbers with too few bytes.
    Columns in ``coders`` are read by their coder.
    """
    spec = cell_spec(spec)
    numbers = [c for c in spec.columns if type(c.value_type) in FIXED_WIDTH]
    if numbers:
        # a projection of its own, so every value is read once
        raw = raw.withColumn("_bits", F.when(any_of([spec.match(c) for c in numbers]), bits(F.col(VALUE))))

    def text(kind: T.DataType) -> Column:
        typed = from_bits(F.col("_bits"), kind, F.octet_length(VALUE)) if type(kind) in FIXED_WIDTH else from_bytes(F.col(VALUE), kind)
        return to_text(typed, kind)

    value = _by_type(spec, text, F.lit(None).cast("string"))
    value = _own_forms(spec, coders, lambda c, coder: to_text(coder.decode(F.col(VALUE)), c.value_type), value)
    return raw.select(*key_parts(F.col(rowkey), spec.keys), CF, QUALIFIER, TS, value.alias(VALUE))


def encode_cells(cells: DataFrame, spec, rowkey: str = "rowkey", coders: Mapping[str, Coder] | None = None) -> DataFrame:
    """Cells with typed keys to raw binary cells: the way back of :func:`decode_cells`."""
    spec = cell_spec(spec)
    stored = cells.schema[VALUE].dataType
    floats = {}
    for kind in dict.fromkeys(c.value_type for c in spec.columns):
        if not isinstance(kind, (T.FloatType, T.DoubleType)):
            continue
        match = any_of([spec.match(c) for c in spec.columns if c.value_type == kind])
        typed = F.when(match, decode_value(F.col(VALUE), stored, kind))
        for name, step in float_steps(typed, kind, f"_{kind.simpleString()}"):
            cells = cells.withColumn(name, step)
        floats[kind] = bits_to_bytes(F.col(name), kind)

    def raw_bytes(kind: T.DataType) -> Column:
        return floats[kind] if kind in floats else to_bytes(decode_value(F.col(VALUE), stored, kind), kind)

    value = _by_type(spec, raw_bytes, F.lit(None).cast("binary"))
    own = lambda c, coder: coder.encode(decode_value(F.col(VALUE), stored, c.value_type)).cast("binary")
    value = _own_forms(spec, coders, own, value)
    return cells.select(key_bytes(spec.keys).alias(rowkey), CF, QUALIFIER, TS, value.alias(VALUE))

"""Erasure: masking or deleting the rows of requested keys.

Keys are compared as text, never as numbers (``'007'`` is not ``'7'``). The
requests are brought down to distinct keys and broadcast only when their
measured size allows; the target table is then neither shuffled nor sorted.
No personal value is logged or returned by the audit functions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from veil.operators.lookup import first_per_key
from veil.runtime import fits_broadcast
from veil.spec import CF, QUALIFIER, TS, VALUE, any_of, parse_type

# The replacement texts of erased fields.
MASKS = {
    "iban": "FRXX 2002 XXXX 2606 XXXX YYYY 606",
    "street": "XX RUE DE PARIS 750XX PARIS",
}
# The family that holds the personal fields of a cell table.
PERSONAL_FAMILY = "demographics"

_KEY = "_request"


def request_keys(requests: DataFrame, key: str) -> DataFrame:
    """Distinct requested keys as text, blanks dropped."""
    text = F.trim(F.col(key).cast("string"))
    return requests.select(text.alias(_KEY)).filter((F.col(_KEY) != "") & F.col(_KEY).isNotNull()).distinct()


class _Requested:
    """The distinct request keys, measured once, and the joins with them.

    Small requests are broadcast. Large ones are joined by shuffle, where
    adaptive execution splits the partition of a key with very many rows.
    """

    def __init__(self, requests: DataFrame, key: str):
        self.key = key
        self.keys = request_keys(requests, key)
        self.small = fits_broadcast(self.keys)

    def small_side(self, df: DataFrame) -> DataFrame:
        """Hint for a frame that is no larger than the requests."""
        return F.broadcast(df) if self.small else df

    def join(self, target: DataFrame, how: str, also: Column | None = None) -> DataFrame:
        same = F.col(self.key).cast("string") == F.col(_KEY)
        return target.join(self.small_side(self.keys), same if also is None else same & also, how)

    def unmatched(self, target: DataFrame) -> DataFrame:
        """Requested keys without a row: the target is first cut down to the requested keys.

        Found and requested keys meet in an aggregation, where repeated keys
        are merged before the shuffle.
        """
        text = F.col(self.key).cast("string")
        found = self.join(target.select(self.key), "left_semi").select(text.alias(_KEY), F.lit(True).alias("_found"))
        asked = self.keys.select(_KEY, F.lit(False).alias("_found"))
        known = asked.unionByName(found).groupBy(_KEY).agg(F.bool_or("_found").alias("_found"))
        return known.filter(~F.col("_found")).select(F.col(_KEY).alias(self.key))


def _masked(df: DataFrame, masks: Mapping[str, object], hit: Column | None) -> list[Column]:
    out = []
    for f in df.schema.fields:
        if f.name in masks:
            mask = F.lit(masks[f.name]).cast(f.dataType)
            value = mask if hit is None else F.when(hit, mask).otherwise(F.col(f"`{f.name}`"))
            out.append(value.alias(f.name))
        elif f.name != _KEY:
            out.append(F.col(f"`{f.name}`"))
    return out


def mask(
    target: DataFrame,
    requests: DataFrame,
    key: str,
    masks: Mapping[str, object] | None = None,
    *,
    one_row_per_key: bool = False,
    order: Sequence | None = None,
    upsert_unmatched: bool = False,
) -> DataFrame:
    """Overwrite the masked columns of all rows whose key is requested.

    ``one_row_per_key`` keeps only the first row (in ``order``) of a requested
    key. ``upsert_unmatched`` adds a row holding just the key and the masks
    for every requested key the target lacks.
    """
    masks = dict(MASKS if masks is None else masks)
    missing = [c for c in (key, *masks) if c not in target.columns]
    if missing:
        raise ValueError(f"the target has no column {missing}")
    if key in masks:
        raise ValueError("the key itself cannot be masked")
    asked = _Requested(requests, key)
    if one_row_per_key:
        order = list(order) if order else [c for c in target.columns if c != key]
        hits = first_per_key(asked.join(target, "left_semi"), key, *order)
        hits = hits.select(*_masked(hits, masks, None))
        out = asked.join(target, "left_anti").unionByName(hits)
    else:
        flagged = asked.join(target, "left")
        out = flagged.select(*_masked(flagged, masks, F.col(_KEY).isNotNull()))
    if upsert_unmatched:
        kind = target.schema[key].dataType
        new = asked.unmatched(target).select(
            *[
                (F.col(key).cast(kind) if f.name == key else F.lit(masks.get(f.name)).cast(f.dataType)).alias(f.name)
                for f in target.schema.fields
            ]
        )
        out = out.unionByName(new)
    return out


def unmatched(target: DataFrame, requests: DataFrame, key: str) -> DataFrame:
    """Requested keys (text) without any row in the target."""
    return _Requested(requests, key).unmatched(target)


def match_requests(target: DataFrame, requests: DataFrame, key: str) -> DataFrame:
    """Every request with its target rows: ``matched`` tells whether there were any.

    Unmatched requests appear once, with null columns.
    """
    asked = _Requested(requests, key)
    found = asked.join(target, "left_semi")
    text = F.col(key).cast("string").alias(key)
    rest = [F.col(f"`{c}`") for c in target.columns if c != key]
    hits = found.select(text, F.lit(True).alias("matched"), *rest)
    misses = asked.unmatched(target).select(
        key, F.lit(False).alias("matched"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields if f.name != key],
    )
    return hits.unionByName(misses)


def erase(target: DataFrame, requests: DataFrame, key: str) -> DataFrame:
    """The target without the rows of requested keys."""
    return _Requested(requests, key).join(target, "left_anti")


# What a request may ask for, as options of mask(); "delete" asks for no row to be left.
KINDS = {
    "mask": {}, "replace": {"one_row_per_key": True}, "upsert": {"upsert_unmatched": True},
    "replace_upsert": {"one_row_per_key": True, "upsert_unmatched": True}, "delete": None,
}


def check_kind(kind: str) -> str:
    if kind not in KINDS:
        raise ValueError(f"unknown kind of request {kind!r}; there are {sorted(KINDS)}")
    return kind


def answer(
    target: DataFrame, requests: DataFrame, key: str, kind: str = "mask", masks: Mapping[str, object] | None = None,
    order: Sequence | None = None,
) -> DataFrame:
    """The target after requests of one kind: all rows masked, one row per key left, unknown keys added, or rows deleted."""
    if KINDS[check_kind(kind)] is None:
        return erase(target, requests, key)
    return mask(target, requests, key, masks, order=order, **KINDS[kind])


def audit(target: DataFrame, requests: DataFrame, key: str, fields: Sequence[str] | None = None) -> DataFrame:
    """Per request: rows found, and in how many of them each field was set. Counts only."""
    fields = [c for c in target.columns if c != key] if fields is None else list(fields)
    asked = _Requested(requests, key)
    found = (
        asked.join(target.select(key, *fields), "left_semi")
        .groupBy(F.col(key).cast("string").alias("_found"))
        .agg(F.count(F.lit(1)).alias("rows_found"), *[F.count(f"`{c}`").alias(f"{c}_found") for c in fields])
    )
    counts = ["rows_found", *[f"{c}_found" for c in fields]]
    return asked.keys.join(asked.small_side(found), F.col(_KEY) == F.col("_found"), "left").select(
        F.col(_KEY).alias(key), *[F.coalesce(F.col(f"`{c}`"), F.lit(0)).alias(c) for c in counts]
    )


def _mask_list(masks: Mapping, family: str) -> list[tuple[str, str, object]]:
    """Masks as (family, qualifier, value); a plain name stands for a qualifier of ``family``."""
    return [(*(k if isinstance(k, tuple) else (family, k)), v) for k, v in masks.items()]


def mask_entries(
    requests: DataFrame, key: str, ts: int, masks: Mapping | None = None, *, family: str = PERSONAL_FAMILY,
    key_type: str | T.DataType = "string", value_type: str | T.DataType = "string",
) -> DataFrame:
    """The mask cells alone: one per distinct requested key and masked qualifier."""
    key_type, value_type = parse_type(key_type), parse_type(value_type)
    cells = [
        F.struct(
            F.lit(cf).alias(CF), F.lit(q).alias(QUALIFIER), F.lit(ts).cast("bigint").alias(TS),
            F.lit(v).cast(value_type).alias(VALUE),
        )
        for cf, q, v in _mask_list(MASKS if masks is None else masks, family)
    ]
    return request_keys(requests, key).select(F.col(_KEY).cast(key_type).alias(key), F.inline(F.array(*cells)))


def newer_than(masks: DataFrame, cells: DataFrame, requests: DataFrame, key: str) -> DataFrame:
    """``masks`` with timestamps above the newest version of their own cell, so that a mask always wins.

    Of ``cells`` only keys, names and timestamps are read, and only masked cells of
    requested keys are aggregated.
    """
    cell = [key, CF, QUALIFIER]
    names = masks.select(CF, QUALIFIER).distinct()
    held = _Requested(requests, key).join(cells.select(*cell, TS), "left_semi").join(F.broadcast(names), [CF, QUALIFIER])
    newest = held.groupBy(*cell).agg(F.max(TS).alias("_newest"))
    return masks.join(newest, cell, "left").select(
        key, CF, QUALIFIER, F.greatest(F.col(TS), F.col("_newest") + 1).cast("bigint").alias(TS), VALUE
    )


def mask_cells(
    cells: DataFrame,
    requests: DataFrame,
    key: str,
    ts: int,
    masks: Mapping | None = None,
    *,
    family: str = PERSONAL_FAMILY,
    purge_history: bool = False,
) -> DataFrame:
    """Put a newer mask cell over every masked qualifier of the requested keys.

    It gets ``ts``, or a timestamp just above a version that is not older.

    Without ``purge_history`` older versions stay in the table and can still be
    read by version or time; with it they are dropped. A requested key gets its
    mask cells even if it had no cell before, as an upsert would do.
    """
    new = mask_entries(
        requests, key, ts, masks, family=family,
        key_type=cells.schema[key].dataType, value_type=cells.schema[VALUE].dataType,
    )
    if purge_history:
        # Nothing is left that a mask would have to be newer than.
        pairs = [(cf, q) for cf, q, _ in _mask_list(MASKS if masks is None else masks, family)]
        cells = purge(cells, requests, key, pairs)
    else:
        new = newer_than(new, cells, requests, key)
    return cells.unionByName(new, allowMissingColumns=True)


def purge(cells: DataFrame, requests: DataFrame, key: str, columns: Sequence[tuple[str, str]]) -> DataFrame:
    """Drop every version of the given (family, qualifier) pairs of the requested keys."""
    personal = any_of([(F.col(CF) == cf) & (F.col(QUALIFIER) == q) for cf, q in columns])
    return _Requested(requests, key).join(cells, "left_anti", personal)

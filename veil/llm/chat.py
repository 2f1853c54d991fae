"""Chat formatting: a finite-state machine over roles and a declarative template.

A conversation's turns are sorted inside one partition and run through as a stream, so
neither side ever holds a whole conversation: a task keeps one turn and the machine's
state, however long the conversation is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

START = "start"


@dataclass(frozen=True)
class Part:
    """What stands before and after a turn of one role, and whether its text is learned."""

    opening: str
    closing: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks of each role; ``other`` serves roles without marks and names the role in {role}.

    ``order`` says which roles may follow which; ``ends`` which may come last.
    """

    parts: dict[str, Part]
    other: Part
    order: dict[str, tuple[str, ...]]
    ends: tuple[str, ...]
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        marks = [m for p in self.parts.values() for m in (p.opening, p.closing)] + [self.other.opening.split("{role}")[0], self.other.closing]
        controls = tuple(sorted({m.strip() for m in marks if m.strip()}, key=lambda x: (-len(x), x)))
        for a in controls:
            if a.startswith("\\") or any(a != b and (a.startswith(b[i:]) or b[i:].startswith(a)) for b in controls for i in range(1, len(b)) if b[i] == a[0]):
                raise ValueError(f"the mark {a!r} overlaps another one; texts could not be told from marks")
        object.__setattr__(self, "controls", controls)


DEFAULT = Template(
    parts={
        "system": Part("<<SYS>> ", " <</SYS>>"),
        "user": Part("[INST] ", " [/INST]"),
        "assistant": Part("<ans> ", " </s>", loss=True),
    },
    other=Part("[ROLE={role}] ", " [/ROLE]"),
    order={START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)},
    ends=("assistant",),
)


class Codec:
    """Texts with every backslash and mark escaped, and back."""

    def __init__(self, template: Template):
        marks = "|".join(re.escape(c) for c in template.controls)
        self._special = re.compile(rf"\\|{marks}")
        self._back = re.compile(r"\\(.)", re.S)

    def escape(self, text: str) -> str:
        return self._special.sub(lambda m: "\\\\" if m[0] == "\\" else m[0][0] + "\\" + m[0][1:], text)

    def role(self, role: str) -> str:
        """A role inside a mark, where a closing bracket would end the mark early."""
        return self.escape(role).replace("]", "\\]")

    def unescape(self, text: str) -> str:
        return self._back.sub(r"\1", text)


def turns_in_order(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), a conversation's rows together and by turn; equal turns by role, then text."""
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


SEGMENTS = "conv_id bigint, seq bigint, turn bigint, segment string, loss boolean, violation string"


def format_chat(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """``SEGMENTS``: three segments for each turn (mark, text, mark), in ``seq`` order; their concatenation is the output.

    ``loss`` is true for the texts to be learned alone. ``violation`` is set on the first segment
    of a turn that may not stand there, and on the last segment of a conversation that may not
    end there; the turn is formatted all the same. Null text and role count as empty. A null
    conv_id is a conversation of its own. Only the four named columns are read; an empty table gives
    an empty result; repeated rows are repeated turns.
    """
    codec = Codec(template)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, seq, held = object(), START, 0, None
        out: list[tuple] = []

        def ended():
            if held is not None:
                bad = state not in template.ends
                out.append((*held, held_violation(bad)))

        def held_violation(bad):
            return f"a conversation may not end with {state}" if bad else None

        for batch in batches:
            for conv, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text")), strict=True):
                if conv != at:
                    ended()
                    at, state, seq, held = conv, START, 0, None
                elif held is not None:
                    out.append((*held, None))
                part = template.parts.get(role, template.other)
                wrong = None if role in template.order.get(state, ()) else f"{role or 'no role'} after {state or 'no role'}"
                out.append((conv, seq, turn, part.opening.replace("{role}", codec.role(role)), False, wrong))
                out.append((conv, seq + 1, turn, codec.escape(text), part.loss, None))
                held = (conv, seq + 2, turn, part.closing, False)
                state, seq = role, seq + 3
                if len(out) >= 4096:
                    yield _batch(out)
                    out.clear()
        ended()
        if out:
            yield _batch(out)

    return turns_in_order(turns).mapInArrow(segments, SEGMENTS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.string()]
    names = ["conv_id", "seq", "turn", "segment", "loss", "violation"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


class Reader:
    """Reads roles and texts back from formatted segments, by the marks alone."""

    def __init__(self, template: Template):
        self.codec = Codec(template)
        self.openings = {p.opening: role for role, p in template.parts.items()}
        self.closings = {p.opening: p.closing for p in template.parts.values()}
        self.before, self.after = template.other.opening.split("{role}")
        self.other = template.other

    def role(self, mark: str) -> tuple[str, str]:
        """(role, closing mark) of an opening mark."""
        if mark in self.openings:
            return self.openings[mark], self.closings[mark]
        if not (mark.startswith(self.before) and mark.endswith(self.after)):
            raise ValueError(f"not a mark: {mark!r}")
        return self.codec.unescape(mark[len(self.before):len(mark) - len(self.after)]), self.other.closing

    def turns(self, text: str) -> list[tuple[str, str]]:
        """(role, text) of a whole formatted conversation."""
        found, at = [], 0
        while at < len(text):
            mark = next((m for m in self.openings if text.startswith(m, at)), None)
            if mark is None:
                end = re.compile(rf"(?:[^\\]|\\.)*?{re.escape(self.after)}", re.S).match(text, at)
                if not end or not text.startswith(self.before, at):
                    raise ValueError(f"no mark at {at}")
                mark = end[0]
            role, closing = self.role(mark)
            at += len(mark)
            to = text.index(closing, at)
            found.append((role, self.codec.unescape(text[at:to])))
            at = to + len(closing)
        return found


DIGESTS = "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint, n_violations bigint"


def read_back(segments: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """``DIGESTS`` of each conversation, from the formatted output.

    The turns are parsed from the marks in the text, three segments at a time, and digests run
    along, so a conversation of any length needs the memory of one turn.
    """
    reader = Reader(template)
    ordered = segments.select("conv_id", "seq", "segment", "loss", "violation").repartition("conv_id").sortWithinPartitions("conv_id", "seq")

    def digest(batches):
        at, state, pending = object(), None, ""
        out = []

        def close():
            if state is not None:
                out.append((at, state["n"], state["turns"].hexdigest(), state["loss"], state["learned"].hexdigest(), state["chars"], state["bad"]))

        for batch in batches:
            for conv, seq, text, loss, wrong in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "seq", "segment", "loss", "violation")), strict=True):
                if conv != at or state is None:
                    close()
                    at, pending = conv, ""
                    state = {"n": 0, "turns": hashlib.sha256(), "loss": 0, "learned": hashlib.sha256(), "chars": 0, "bad": 0}
                state["chars"] += len(text)
                state["bad"] += wrong is not None
                if loss:
                    plain = reader.codec.unescape(text)
                    state["loss"] += len(plain)
                    state["learned"].update(plain.encode("utf-8", "surrogatepass"))
                pending += text
                if seq % 3 == 2:  # a turn is complete
                    for role, said in reader.turns(pending):
                        state["n"] += 1
                        state["turns"].update(f"{role}\n{said}\n".encode("utf-8", "surrogatepass"))
                    pending = ""
            if len(out) >= 4096:
                yield _digests(out)
                out.clear()
        close()
        if out:
            yield _digests(out)

    return ordered.mapInArrow(digest, DIGESTS)


def _digests(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    names = [x.split()[0] for x in DIGESTS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

"""Chat formatting by a finite-state machine over roles and a declarative template.

The turns of a conversation stream by in order through a machine whose state is
the last role. The template says what opens and closes a turn of each role and
which parts are trained on; each turn becomes text segments with a loss flag.
Control strings inside texts are escaped with a backslash, backslashes too, so
no text can forge a turn and every text can be had back. ``read_back`` parses
the formatted output alone and returns roles, texts and what is under the mask.

A conversation is never gathered: rows are dealt by conversation, sorted by
turn, and each task keeps one turn and running digests in memory.

Defined cases: a NULL text is empty, a NULL role an unnamed other role; turns
out of order (system not first, two of one role in a row, assistant first,
unknown roles) are formatted all the same and marked not ``valid``; equal turn
numbers are ordered by role, then text; rows without a conversation id form one
conversation. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Fixed markers of the default template.
DEFAULT_TURNS = {
    "system": ("<<SYS>>", "<</SYS>>"),
    "user": ("[INST]", "[/INST]"),
    "assistant": ("<s>", "</s>"),
    "tool": ("<tool>", "</tool>"),
}


@dataclass(frozen=True)
class Template:
    """Markers by role, the roles whose texts are trained on, and who may follow whom ('' is the start)."""

    turns: tuple[tuple[str, str, str], ...] = tuple((r, a, b) for r, (a, b) in DEFAULT_TURNS.items())
    #: Any other role is written with its name between these.
    other: tuple[str, str, str] = ("<role:", ">", "</role>")
    trained: tuple[str, ...] = ("assistant",)
    follows: tuple[tuple[str, tuple[str, ...]], ...] = (
        ("", ("system", "user")), ("system", ("user",)), ("user", ("assistant",)), ("assistant", ("user", "tool")), ("tool", ("assistant",)))
    last: tuple[str, ...] = ("assistant",)

    def controls(self) -> list[str]:
        marks = {m for _, a, b in self.turns for m in (a, b)} | {self.other[0], self.other[2]}
        return sorted(marks, key=len, reverse=True)


def escape(text: str, template: Template) -> str:
    """A backslash before every control string and backslash."""
    return re.sub("|".join(map(re.escape, ["\\", *template.controls()])), lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.S)


def turn_segments(role: str, text: str, template: Template) -> list[tuple[str, bool]]:
    """The (text, loss) segments of one turn."""
    marks = {r: (a, b) for r, a, b in template.turns}
    start, mid, end = template.other
    opening, closing = marks.get(role) or (start + escape(role, template).replace(mid, "\\" + mid) + mid, end)
    return [(opening, False), (escape(text, template), role in template.trained), (closing, False)]


class Reader:
    """Parses formatted segments back into turns, one at a time."""

    def __init__(self, template: Template):
        self.template = template
        self.opened = {a: (r, b) for r, a, b in template.turns}
        self.scan = re.compile("|".join([r"\\.", *map(re.escape, template.controls())]), re.S)
        self.name_end = re.compile(r"\\.|" + re.escape(template.other[1]), re.S)

    def turns(self, text: str, loss: list[tuple[int, int]]) -> Iterator[tuple[str, str, str]]:
        """(role, text, text under the mask) of every turn of a stretch of whole turns."""
        at = 0
        while at < len(text):
            opening = next((m for m in self.template.controls() if text.startswith(m, at) and (m in self.opened or m == self.template.other[0])), None)
            if opening is None:
                raise ValueError(f"no turn begins at {at}")
            at += len(opening)
            if opening in self.opened:
                role, closing = self.opened[opening]
            else:
                end = next(m for m in self.name_end.finditer(text, at) if m[0] == self.template.other[1])
                role, closing, at = unescape(text[at:end.start()]), self.template.other[2], end.end()
            end = next(m for m in self.scan.finditer(text, at) if m[0][0] != "\\")
            if end[0] != closing:
                raise ValueError(f"a turn of {role!r} ends with {end[0]!r}")
            under = "".join(text[max(a, at):min(b, end.start())] for a, b in loss)
            yield role, unescape(text[at:end.start()]), unescape(under)
            at = end.end()


def in_order(conversations: DataFrame, template: Template) -> DataFrame:
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Segments (conv_id, place, part, segment, loss, valid) in order within each conversation.

    ``place`` numbers the turns of a conversation from 0, whatever their own numbers.
    ``valid`` says whether this turn may stand here, and on the closing segment
    of a conversation's last turn whether it may end so. A conversation's
    segments are consecutive rows of one partition.
    """
    allowed = dict(template.follows)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, role, place = None, "", -1
        held: list[tuple] = []  # the last turn waits to learn whether another follows
        names = ["conv_id", "place", "part", "segment", "loss", "valid"]
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_()]

        def as_batch(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * 6, kinds)], names=names)

        def ended() -> list[tuple]:
            return [*held[:-1], (*held[-1][:-1], held[-1][-1] and role in template.last)] if held else []

        for batch in batches:
            out: list[tuple] = []
            for c, r, text in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "role", "text"))):
                if place < 0 or c != conv:
                    out += ended()
                    conv, role, place = c, "", 0
                else:
                    out += held
                    place += 1
                ok = r in allowed.get(role, ())
                held = [(c, place, i, s, loss, ok) for i, (s, loss) in enumerate(turn_segments(r, text, template))]
                role = r
                if len(out) > 3000:
                    yield as_batch(out)
                    out = []
            yield as_batch(out)
        yield as_batch(ended())

    return in_order(conversations.withColumn("conv_id", F.col("conv_id").cast("long")), template).mapInArrow(
        rows, "conv_id long, place long, part int, segment string, loss boolean, valid boolean")


def read_back(segments: DataFrame, template: Template = Template(), arranged: bool = False) -> DataFrame:
    """One row per conversation from its segments alone.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    valid). ``arranged`` rows come straight from ``format_conversations``;
    others are dealt and sorted anew.
    """
    if not arranged:
        segments = segments.repartition("conv_id").sortWithinPartitions("conv_id", "place", "part")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(template)
        names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "valid"]
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_()]
        state: dict | None = None
        text, loss = [], []

        def take_turns() -> None:
            for role, own, under in reader.turns("".join(text), loss):
                state["n_turns"] += 1
                state["turns"].update(f"{role}\n{own}\n".encode())
                state["loss_chars"] += len(under)
                state["loss"].update(under.encode())
            text.clear()
            loss.clear()

        def finished() -> list[tuple]:
            take_turns()
            return [(state["conv_id"], state["n_turns"], state["turns"].hexdigest(), state["loss_chars"], state["loss"].hexdigest(), state["chars"], state["valid"])]

        def as_batch(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out) if out else [[]] * 7, kinds)], names=names)

        for batch in batches:
            out: list[tuple] = []
            for conv, part, segment, trained, valid in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "part", "segment", "loss", "valid"))):
                if state is None or conv != state["conv_id"]:
                    out += finished() if state else []
                    state = {"conv_id": conv, "n_turns": 0, "turns": hashlib.sha256(), "loss_chars": 0, "loss": hashlib.sha256(), "chars": 0, "valid": True}
                elif part == 0:
                    take_turns()
                at = sum(map(len, text))
                text.append(segment)
                state["chars"] += len(segment)
                state["valid"] &= valid
                if trained:
                    loss.append((at, at + len(segment)))
            yield as_batch(out)
        if state:
            yield as_batch(finished())

    return segments.mapInArrow(rows, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean")

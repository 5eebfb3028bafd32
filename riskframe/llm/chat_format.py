"""Operator 6: chat formatting by a declarative template and a state machine over roles.

A template gives for each role the marks before and behind a turn and whether its text is learned;
roles it does not know are written with their name. Each turn becomes segments (text, loss flag).
The state machine says which role may follow which; a conversation that breaks the order is
formatted all the same, and the number of its first bad turn is given.

Inside texts the template's marks are broken up by a backslash behind their first character, and
backslashes are doubled, so a mark in the output is always the template's own and every text can
be read back. :func:`read_back` does that from the formatted parts.

Turns are dealt by conversation, sorted by turn and streamed, and a conversation is written in
parts of bounded size, so a very long one needs no more memory than a short one. (The digests that
operator 6 returns are one hash over all its turns in order, which is one stream by nature.)

Results: null text or role is empty. Rows of one turn are ordered by role, then text; a null turn
comes first; rows with a null conversation form one. An empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import materialize

PART_CHARS = 1 << 20


@dataclass(frozen=True)
class Turn:
    before: str
    behind: str
    learned: bool = False


@dataclass(frozen=True)
class Template:
    roles: dict[str, Turn] = field(default_factory=lambda: {
        "system": Turn("<s>[SYS]", "[/SYS]"),
        "user": Turn("<s>[INST]", "[/INST]"),
        "assistant": Turn("<s>[ANSWER]", "</s>", True)})
    #: for roles not named above: marks before the name, between name and text, and behind the text
    other: tuple[str, str, str] = ("<s>[ROLE]", "[TEXT]", "[/ROLE]")
    #: which roles may follow a role; "" is the start
    follows: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)})
    #: roles that may end a conversation
    ends: tuple[str, ...] = ("assistant",)

    def marks(self) -> list[str]:
        found = {"<s>", "[INST]", "[/INST]", "[SYS]", "[ANSWER]", "[ROLE]", *self.other}
        for t in self.roles.values():
            found |= {t.before, t.behind}
        return sorted(found, key=lambda m: (-len(m), m))


class Codec:
    """Escaping, formatting of a turn, and reading back, for one template."""

    def __init__(self, template: Template):
        self.template = template
        marks = template.marks()
        if any(len(m) < 2 or "\\" in m for m in marks):
            raise ValueError("a mark needs two characters and no backslash")
        self.mark = re.compile("|".join(map(re.escape, marks)))
        self.hidden = re.compile(r"\\(\\?)")
        self.openers = {t.before: (role, t) for role, t in template.roles.items()}
        self.opening = re.compile("|".join(sorted(map(re.escape, [*self.openers, template.other[0]]), key=len, reverse=True)))

    def escape(self, text: str) -> str:
        text = text.replace("\\", "\\\\")
        # a broken mark can't make another one, but marks may overlap: until none is left
        while self.mark.search(text):
            text = self.mark.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)
        return text

    def unescape(self, text: str) -> str:
        return self.hidden.sub(lambda m: m[1], text)

    def segments(self, role: str, text: str) -> list[tuple[str, bool]]:
        """(text, loss) segments of a turn."""
        turn = self.template.roles.get(role)
        if turn is None:
            a, b, c = self.template.other
            return [(a + self.escape(role) + b + self.escape(text) + c, False)]
        return [(turn.before, False), (self.escape(text), turn.learned), (turn.behind, False)]

    def read(self, stream: str, at: int) -> tuple[str, str, int, int, int]:
        """The turn that begins at ``at``: role, text, where its text begins and ends, and where
        the turn ends."""
        opened = self.opening.match(stream, at)
        if opened is None:
            raise ValueError("no turn begins here")
        begin = opened.end()
        if opened[0] in self.openers:
            role, turn = self.openers[opened[0]]
            end = stream.index(turn.behind, begin)
            return role, self.unescape(stream[begin:end]), begin, end, end + len(turn.behind)
        _, middle, behind = self.template.other
        split = stream.index(middle, begin)
        end = stream.index(behind, split + len(middle))
        return self.unescape(stream[begin:split]), self.unescape(stream[split + len(middle):end]), split + len(middle), end, end + len(behind)


PARTS = "conv_id long, part int, formatted string, loss_spans array<int>, n_turns long, bad_turn long, last boolean"
_PARTS = pa.schema([("conv_id", pa.int64()), ("part", pa.int32()), ("formatted", pa.string()), ("loss_spans", pa.list_(pa.int32())),
                    ("n_turns", pa.int64()), ("bad_turn", pa.int64()), ("last", pa.bool_())])


def _ordered(turns: DataFrame, *keys: str) -> DataFrame:
    return turns.repartition(keys[0]).sortWithinPartitions(*keys)


def format_turns(turns: DataFrame, template: Template = Template(), part_chars: int = PART_CHARS) -> DataFrame:
    """Formatted conversations in parts: text, [begin, end) pairs of characters to learn, turns in
    the part, and in the last part the first turn that broke the order (-1: none; the number of
    turns: it ended on a role that can't end)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(template)
        rules, held = template, []
        state = {"conv": None, "open": False}

        def begin(conv) -> None:
            state.update(conv=conv, open=True, part=0, role="", turn=0, bad=-1)
            clear()

        def clear() -> None:
            state.update(text=[], size=0, spans=[], turns=0)

        def emit(last: bool) -> dict:
            bad = state["bad"]
            if last and bad < 0 and state["role"] not in rules.ends:
                bad = state["turn"]
            row = {"conv_id": state["conv"], "part": state["part"], "formatted": "".join(state["text"]), "loss_spans": state["spans"],
                   "n_turns": state["turns"], "bad_turn": bad if last else None, "last": last}
            state["part"] += 1
            clear()
            return row

        for batch in batches:
            for conv, role, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if state["open"] and conv != state["conv"]:
                    held.append(emit(True))
                    state["open"] = False
                if not state["open"]:
                    begin(conv)
                if state["size"] >= part_chars:
                    held.append(emit(False))
                if state["bad"] < 0 and role not in rules.follows.get(state["role"], ()):
                    state["bad"] = state["turn"]
                state["role"], state["turn"] = role, state["turn"] + 1
                for piece, learned in codec.segments(role, text):
                    if learned:
                        state["spans"] += [state["size"], state["size"] + len(piece)]
                    state["text"].append(piece)
                    state["size"] += len(piece)
                state["turns"] += 1
                if len(held) >= 500 or sum(len(r["formatted"]) for r in held[-1:]) >= part_chars:
                    yield pa.RecordBatch.from_pylist(held, _PARTS)
                    held = []
        if state["open"]:
            held.append(emit(True))
        if held:
            yield pa.RecordBatch.from_pylist(held, _PARTS)

    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.coalesce(F.col("role"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text"), F.lit("")).alias("text"), F.col("turn").alias("turn"))
    ordered = _ordered(rows, "conv_id", "turn", "role", "text")
    return ordered.select("conv_id", "role", "text").mapInArrow(run, PARTS)


DIGEST = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, bad_turn long"
_DIGEST = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                     ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("bad_turn", pa.int64())])


def read_back(parts: DataFrame, template: Template = Template()) -> DataFrame:
    """One row a conversation, read from its formatted parts alone: the turns by the template's
    marks, the learned text by the loss spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, out, now = Codec(template), [], None
        for batch in batches:
            for row in batch.to_pylist():
                if now is None:
                    now = {"n": 0, "turns": hashlib.sha256(), "loss": hashlib.sha256(), "loss_chars": 0, "chars": 0}
                text, at, spans = row["formatted"], 0, row["loss_spans"]
                while at < len(text):
                    role, said, _, _, at = codec.read(text, at)
                    now["n"] += 1
                    now["turns"].update(f"{role}\n{said}\n".encode())
                for a, b in zip(spans[::2], spans[1::2]):
                    learned = codec.unescape(text[a:b])
                    now["loss"].update(learned.encode())
                    now["loss_chars"] += len(learned)
                now["chars"] += len(text)
                if row["last"]:
                    out.append({"conv_id": row["conv_id"], "n_turns": now["n"], "turns_sha256": now["turns"].hexdigest(), "loss_chars": now["loss_chars"],
                                "loss_sha256": now["loss"].hexdigest(), "formatted_chars": now["chars"], "bad_turn": row["bad_turn"]})
                    now = None
            if out:
                yield pa.RecordBatch.from_pylist(out, _DIGEST)
                out = []

    return _ordered(parts, "conv_id", "part").mapInArrow(run, DIGEST)


#: the conversation that the query adds: both of its texts are made of control strings
PROBE = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def with_probe(turns: DataFrame) -> DataFrame:
    kinds = turns.select("conv_id", "turn", "role", "text")
    return kinds.unionByName(turns.sparkSession.createDataFrame(PROBE, kinds.schema))


def formatted_table(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """The formatted parts, written to shared storage and read again."""
    return materialize(format_turns(turns, template), "chat")

"""Chat formatting from a declarative template.

A template names the mark that opens a turn of each role, the mark that closes a turn, the roles
whose text bears loss, and the transitions of a finite-state machine over roles that says which
turn may follow which. Formatting emits segments in order: the opening mark, the text and the
closing mark of each turn, each with its loss flag, and the verdict of the machine so far.

Control strings inside texts are escaped with a backslash, as is the backslash itself, so every
text can be read back; a role without a mark of its own is written into the mark, escaped as well.

Conversations are sorted by turn and streamed through a task one row at a time. Only the state of
the machine is kept, so a conversation of any length needs no more memory than its longest text.
A conversation is read in order by one task because its digests and its turn order are sequential.

Cases: a null text is empty; a null role is empty and never valid; a null turn comes first; rows of
one turn are ordered by role and text; a null conv_id is a conversation of its own; repeated rows
are turns of their own; an empty table gives no segments; other input columns are left out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemill.llm import batches

START = "start"


@dataclass(frozen=True)
class Template:
    """`labels` of roles stand between `open` and `colon`; `follows` are the transitions by role."""

    labels: dict[str, str] = field(default_factory=lambda: {"system": "System", "user": "User", "assistant": "Assistant"})
    open: str = "### "
    colon: str = ": "
    close: str = " </turn>\n"
    controls: tuple[str, ...] = ("###", "</turn>")
    loss: frozenset[str] = frozenset({"assistant"})
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {START: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    #: Roles that may end a conversation.
    ends: tuple[str, ...] = ("assistant",)

    def _any(self, *more: str) -> str:
        return "|".join(re.escape(c) for c in sorted({"\\", *self.controls, *more}, key=len, reverse=True))

    def escaped(self, text: str) -> str:
        return re.sub(self._any(), lambda m: "\\" + m[0], text)

    def unescaped(self, text: str) -> str:
        return re.sub(rf"\\({self._any()})", r"\1", text)

    def header(self, role: str) -> str:
        label = self.labels.get(role)
        # "=" keeps a role without a label apart from the labels.
        return self.open + (label if label else "=" + re.sub(self._any(":"), lambda m: "\\" + m[0], role)) + self.colon

    def role(self, label: str) -> str:
        if label.startswith("="):
            return re.sub(rf"\\({self._any(':')})", r"\1", label[1:])
        return {v: k for k, v in self.labels.items()}[label]

    def turn(self) -> re.Pattern:
        """A whole turn of formatted text: label and escaped text."""
        plain = "".join(f"(?!{re.escape(c)})" for c in self.controls)
        char = rf"(?:\\(?:{self._any(':')})|{plain}[^\\])"
        label = rf"(?:\\(?:{self._any(':')})|(?!:){plain}[^\\])*"
        return re.compile(
            f"{re.escape(self.open)}({label}){re.escape(self.colon)}({char}*?){re.escape(self.close)}", re.DOTALL
        )


SEGMENTS = "conv_id long, turn_no long, part int, text string, loss boolean, valid boolean"
_SEGMENTS = pa.schema([
    ("conv_id", pa.int64()), ("turn_no", pa.int64()), ("part", pa.int32()), ("text", pa.string()), ("loss", pa.bool_()),
    ("valid", pa.bool_()),
])


def _format(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conversation: object = START
        state, turn_no, valid = START, 0, True
        for batch in batches:
            rows: list[tuple] = []
            size = 0
            for conv, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "role", "text"))):
                if conv != conversation:
                    conversation, state, turn_no, valid = conv, START, 0, True
                role, text = role or "", text or ""
                valid = valid and role in template.follows.get(state, ())
                state = role
                for part, (piece, loss) in enumerate((
                    (template.header(role), False), (template.escaped(text), role in template.loss), (template.close, False),
                )):
                    rows.append((conv, turn_no, part, piece, loss, valid))
                turn_no, size = turn_no + 1, size + len(text)
                if size > 1 << 22:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SEGMENTS)], schema=_SEGMENTS)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SEGMENTS)], schema=_SEGMENTS)

    return run


def formatted(
    turns: DataFrame, template: Template = Template(), conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
) -> DataFrame:
    """Segments (conv_id, turn_no, part, text, loss, valid), in order within each partition;
    a conversation lies in one partition. `valid` says whether the turns so far are in order."""
    batches.small(turns.sparkSession)
    rows = turns.select(
        F.col(conv).cast("long").alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("text")
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return ordered.mapInArrow(_format(template), SEGMENTS)


READ = (
    "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "valid boolean, complete boolean"
)
_READ = pa.schema([
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()), ("complete", pa.bool_()),
])


class _Reader:
    """Reads the formatted text of one conversation as it comes, turn by turn."""

    def __init__(self, template: Template, conv: int | None) -> None:
        self.template, self.conv, self.pattern = template, conv, template.turn()
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.rest: list[str] = []
        self.last, self.valid = START, True

    def add(self, text: str, loss: bool, valid: bool) -> None:
        self.chars += len(text)
        self.valid = valid
        self.rest.append(text)
        if loss:
            plain = self.template.unescaped(text)
            self.loss_chars += len(plain)
            self.loss.update(plain.encode())
        if text.endswith(self.template.close):
            self._turns()

    def _turns(self) -> None:
        held = "".join(self.rest)
        at = 0
        while found := self.pattern.match(held, at):
            self.last = self.template.role(found[1])
            self.turns.update(f"{self.last}\n{self.template.unescaped(found[2])}\n".encode())
            self.n_turns, at = self.n_turns + 1, found.end()
        self.rest = [held[at:]]

    def row(self) -> tuple:
        if "".join(self.rest):
            raise ValueError(f"formatted text of conversation {self.conv} does not end with a turn")
        return (
            self.conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, self.valid,
            self.valid and self.last in self.template.ends,
        )


def _read(template: Template):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader: _Reader | None = None
        for batch in batches:
            rows: list[tuple] = []
            for conv, text, loss, valid in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "text", "loss", "valid"))):
                if reader is None or conv != reader.conv:
                    if reader:
                        rows.append(reader.row())
                    reader = _Reader(template, conv)
                reader.add(text, loss, valid)
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _READ)], schema=_READ)
        if reader:
            yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip(reader.row(), _READ)], schema=_READ)

    return run


def read_back(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per conversation, from the text and the loss flags of its segments alone.

    `segments` as `formatted` gives them: in order, a conversation in one partition. `valid`: every
    turn was allowed after the one before; `complete`: valid, and the last role may end it.
    """
    return segments.mapInArrow(_read(template), READ)

"""Chat formatting by a grammar round trip.

Every turn becomes one block of a small grammar:

    user        [INST] text [/INST]
    assistant   [OUT]text[/OUT]</s>
    other       [ROLE]role[/ROLE]text[/END]

Control strings inside a role or text are always escaped: a backslash makes the next character literal.  The
rendered block is reparsed by the deterministic parser; if the turn read back differs from the source, every
special character is escaped as well, until both are identical.  `digest_conversations` parses the rendered
conversation as one character stream, whatever its cut into rows, and takes turns and loss mask from it.

Defined cases: a null text is empty, a null role is the empty role; turns with equal numbers are
ordered by role and text; repeated rows are turns of their own; a null conv_id is a conversation of
its own; an empty table gives an empty result; extra columns don't matter.  The parser looks at each character
a bounded number of times, so very long and hostile texts take linear time.  A conversation is streamed turn by
turn through one sorted partition, as its digests are sequential: a very long one needs no more memory than its
longest turn, but its time is one task's.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import chunks

CONTROLS = re.compile(r"\[/?(?:INST|OUT|ROLE|END)\]|</?s>|\\")
SPECIALS = re.compile(r"[\[<\\]")
ESCAPED = re.compile(r"\\(.)", re.S)
#: (opening string, closing string) by role
MARKS = {"user": ("[INST] ", " [/INST]"), "assistant": ("[OUT]", "[/OUT]</s>")}
OTHER = ("[ROLE]", "[/ROLE]", "[/END]")
STOPS = {c: re.compile(rf"\\.|{re.escape(c)}", re.S) for c in (*(c for _, c in MARKS.values()), *OTHER[1:])}
ESCAPES = (lambda s: CONTROLS.sub(r"\\\g<0>", s), lambda s: SPECIALS.sub(r"\\\g<0>", s))


def write_turn(role: str, text: str, escape) -> str:
    if role in MARKS:
        opening, closing = MARKS[role]
        return opening + escape(text) + closing
    return OTHER[0] + escape(role) + OTHER[1] + escape(text) + OTHER[2]


class Parser:
    """Turns of a rendered text that is fed in pieces; a piece may end anywhere."""

    def __init__(self) -> None:
        self.rest = ""  # what no turn has been read from yet
        self.seen = 0  # up to where the closing string has been looked for
        self.state: tuple[str | None, str] | None = None  # (role, closing string) of the open turn; the role of another is None until read
        self.body = 0

    def feed(self, piece: str) -> Iterator[tuple[str, str]]:
        self.rest += piece
        at = 0  # consumed
        while True:
            if self.state is None:
                if at == len(self.rest):
                    break
                opened = next(((r, o, c) for r, (o, c) in MARKS.items() if self.rest.startswith(o, at)), None)
                if opened is None and self.rest.startswith(OTHER[0], at):
                    opened = (None, OTHER[0], OTHER[1])
                if opened is None:
                    if any(o.startswith(self.rest[at:]) for o in ("[INST] ", "[OUT]", OTHER[0])):
                        break  # the piece ends inside an opening string
                    raise ValueError("no turn begins here")
                role, opening, closing = opened
                self.state, self.body = (role, closing), at + len(opening)
                self.seen = self.body
            role, closing = self.state
            end = self._closing(closing)
            if end < 0:
                break
            text = ESCAPED.sub(r"\1", self.rest[self.body : end])
            self.body = self.seen = end + len(closing)
            if closing == OTHER[1]:
                self.state = (text, OTHER[2])
                continue
            yield role, text
            self.state, at = None, self.body
        # keep only what is still open
        self.rest = self.rest[at:]
        self.seen, self.body = self.seen - at, self.body - at

    def _closing(self, closing: str) -> int:
        """The place of the next unescaped closing string, or -1 if it hasn't come yet."""
        for m in STOPS[closing].finditer(self.rest, self.seen):
            if m.group() == closing:
                return m.start()
            self.seen = m.end()  # an escaped character
        self.seen = max(self.seen, len(self.rest) - len(closing) + 1)  # a part of it may stand at the end
        return -1

    def close(self) -> None:
        if self.rest or self.state is not None:
            raise ValueError("the text ends inside a turn")


def parse(rendered: str) -> list[tuple[str, str]] | None:
    """The turns of a rendered text; None if it is no sentence of the grammar."""
    parser = Parser()
    try:
        turns = list(parser.feed(rendered))
        parser.close()
    except ValueError:
        return None
    return turns


def render_turn(role: str, text: str) -> str:
    """The least escaped block that reads back as exactly this turn; control strings are never left unescaped."""
    for escape in ESCAPES:
        block = write_turn(role, text, escape)
        if parse(block) == [(role, text)]:
            return block
    raise AssertionError("a fully escaped block always reads back")


def format_turns(df: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows (conv_id, turn, formatted) in order of turn within each partition; concatenated, they are the conversations."""
    rows = df.select(
        F.col(conversation).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(role, F.lit("")).alias("role"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    rows = rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunks(batches):
            blocks = [render_turn(r, t) for r, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(blocks, pa.string())], names=["conv_id", "turn", "formatted"])

    return rows.mapInArrow(run, "conv_id long, turn long, formatted string")


class Reader:
    """Reads one formatted conversation back, piece by piece."""

    def __init__(self, key: int | None) -> None:
        self.key, self.parser = key, Parser()
        self.n_turns = self.loss_chars = self.chars = 0
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()

    def feed(self, piece: str) -> None:
        self.chars += len(piece)
        for role, text in self.parser.feed(piece):
            raw = text.encode("utf-8")
            self.n_turns += 1
            self.turns.update(role.encode("utf-8") + b"\n" + raw + b"\n")
            if role == "assistant":
                self.loss_chars += len(text)
                self.loss.update(raw)

    def row(self) -> tuple:
        self.parser.close()
        return self.key, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


def digest_conversations(formatted: DataFrame) -> DataFrame:
    """Reads each formatted conversation back, one row each.  The input comes from `format_turns`."""
    schema = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
        reader = None
        for b in chunks(batches):
            done = []
            for conv, block in zip(b.column(0).to_pylist(), b.column(2).to_pylist()):
                if reader is None or conv != reader.key:
                    if reader is not None:
                        done.append(reader.row())
                    reader = Reader(conv)
                reader.feed(block)
            if done:
                yield batch(done)
        if reader is not None:
            yield batch([reader.row()])

    return formatted.mapInArrow(run, schema)

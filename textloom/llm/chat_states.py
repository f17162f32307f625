"""Operator 10: conversations to text with a loss mask, by a machine over roles.

A declarative template says which role may follow which, how a turn is written,
and which parts carry loss.  Turns are read in order, one conversation after the
other, so a conversation of any length takes bounded memory.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame

# Segments sent on at a time.
BATCH = 4000
_MARK = re.compile(r"<(\\*)\|")
_ESCAPED = re.compile(r"<\\(\\*)\|")
_NAMED = re.compile(r"\\[\\n]")


def escape(text: str) -> str:
    """Put one more backslash into every ``<|``, ``<\\|``, ``<\\\\|`` …, so none is a mark."""
    return _MARK.sub(r"<\\\1|", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"<\1|", text)


@dataclass(frozen=True)
class Template:
    """``{role}`` stands for the turn's role; roles named in ``loss`` are learned from."""

    before: str = "<|im_start|>{role}\n"
    after: str = "<|im_end|>\n"
    loss: frozenset = frozenset({"assistant"})
    #: From the state, which is the role before ("" at the start), to the roles allowed.
    follows: dict = field(default_factory=lambda: {
        "": {"system", "user"}, "system": {"user"}, "user": {"assistant"},
        "assistant": {"user", "tool"}, "tool": {"assistant", "tool"}})


DEFAULT = Template()
SEGMENTS = "conv_id long, turn_no long, segment int, text string, loss boolean, valid boolean"


def turn_segments(role: str, text: str, template: Template) -> list[tuple[str, bool]]:
    """The texts of a turn and whether each carries loss: mark, escaped text, closing mark."""
    name = escape(role.replace("\\", "\\\\").replace("\n", "\\n"))  # on one line
    return [(template.before.format(role=name), False),
            (escape(text), role in template.loss), (template.after, False)]


def _in_order(turns: DataFrame) -> DataFrame:
    """Whole conversations in tasks, their turns in order; ties by role and text, nulls first."""
    return (turns.select("conv_id", "turn", "role", "text").repartition("conv_id")
            .sortWithinPartitions("conv_id", "turn", "role", "text"))


def _walk(batches: Iterator[pa.RecordBatch], template: Template) -> Iterator[tuple]:
    """``conv_id, is_new, turn_no, segments, valid`` for each turn in order."""
    conv, state, turn_no, valid, begun = None, "", 0, True, False
    for batch in batches:
        for i, r, t in zip(*(batch.column(k) for k in ("conv_id", "role", "text"))):
            i, role, text = i.as_py(), r.as_py() or "", t.as_py() or ""
            new = not begun or i != conv
            if new:
                conv, state, turn_no, valid, begun = i, "", 0, True, True
            # The machine stops at the first role out of order; the turns are written all the same.
            valid = valid and role in template.follows.get(state, ())
            yield i, new, turn_no, turn_segments(role, text, template), valid
            state, turn_no = role, turn_no + 1


def segments(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """The text segments of every turn of ``turns(conv_id, turn, role, text)``.

    Joined in the order of ``turn_no, segment`` they are the formatted text.
    ``valid`` is true as long as the order of roles is allowed.  A null text is an
    empty one, a null role an empty (and never allowed) one; turns with the same
    number, or none, are ordered by role and text; repeated rows are turns of
    their own; an empty table has no segments; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for i, _, n, parts, valid in _walk(batches, template):
            rows += [(i, n, k, text, loss, valid) for k, (text, loss) in enumerate(parts)]
            if len(rows) >= BATCH:
                yield _batch(rows)
                rows = []
        if rows:
            yield _batch(rows)

    return _in_order(turns).mapInArrow(run, SEGMENTS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.bool_(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      ["conv_id", "turn_no", "segment", "text", "loss", "valid"])


class Reader:
    """Reads formatted text back as a stream and takes digests of what it finds.

    It is given pieces of the text with their loss flag, cut anywhere, and knows the
    marks of the template only.  Every ``<|`` must belong to a mark in its place, and
    loss must lie on whole texts; anything else is an error, such as a text that was
    not escaped.  It holds no more than the turn it is in.
    """

    def __init__(self, template: Template):
        self.begin, self.name_end = template.before.split("{role}")
        self.end = template.after
        if not (self.begin.startswith("<|") and self.end.startswith("<|")):
            raise ValueError("marks of a template begin with <|")
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.chars = 0
        self.held, self.flags, self.role, self.seen = "", [], None, 0

    def feed(self, piece: str, loss: bool) -> None:
        self.held += piece
        self.chars += len(piece)
        if piece:
            self.flags.append([len(piece), loss])
        while self._step():
            pass

    def _take(self, n: int) -> tuple[str, set[bool]]:
        """The next characters and the loss flags that lie on them."""
        text, self.held, flags, left = self.held[:n], self.held[n:], set(), n
        while left:
            size, loss = self.flags[0]
            flags.add(loss)
            self.flags[0][0] -= min(left, size)
            left -= min(left, size)
            if not self.flags[0][0]:
                self.flags.pop(0)
        self.seen = 0
        return text, flags

    def _mark(self, mark: str, at: int) -> bool:
        """Whether the mark stands there; an error if another one does, false if the text ends within."""
        found = self.held[at:at + len(mark)]
        if not mark.startswith(found):
            raise ValueError(f"{found!r} where {mark!r} is expected")
        return found == mark

    def _plain(self, n: int) -> str:
        text, flags = self._take(n)
        if True in flags:
            raise ValueError("loss on a mark")
        return text

    def _step(self) -> bool:
        if self.role is None:
            if not self.held or not self._mark(self.begin, 0):
                return False
            stop = self.held.find(self.name_end, len(self.begin))
            if "<|" in self.held[len(self.begin):stop if stop >= 0 else None]:
                raise ValueError("a mark within a role")
            if stop < 0:
                return False
            self.role = self._plain(stop + len(self.name_end))[len(self.begin):stop]
            return True
        at = self.held.find("<|", self.seen)
        if at < 0:
            # All but a last character, which may begin a mark, has been looked at.
            self.seen = max(0, len(self.held) - 1)
            return False
        self.seen = at
        if not self._mark(self.end, at):
            return False
        written, flags = self._take(at)
        self._plain(len(self.end))
        if len(flags) > 1:
            raise ValueError("loss on a part of a text")
        role, text = _NAMED.sub(lambda m: "\n" if m[0] == "\\n" else "\\", unescape(self.role)), unescape(written)
        self.turns.update(f"{role}\n{text}\n".encode("utf-8", "surrogatepass"))
        if True in flags:
            self.loss.update(text.encode("utf-8", "surrogatepass"))
            self.loss_chars += len(text)
        self.n_turns, self.role = self.n_turns + 1, None
        return True

    def row(self, conv: int, valid: bool) -> tuple:
        if self.held or self.role is not None:
            raise ValueError("the text ends within a turn")
        return (conv, self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, valid)


DIGESTS = ("conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
           "formatted_chars long, valid boolean")


def digests(turns: DataFrame, template: Template = DEFAULT) -> DataFrame:
    """Counts and digests of each conversation, read back from its segments."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, reader, last = [], None, (None, True)
        for i, new, _, parts, valid in _walk(batches, template):
            if new:
                if reader:
                    rows.append(reader.row(*last))
                if len(rows) >= BATCH:
                    yield _digest_batch(rows)
                    rows = []
                reader = Reader(template)
            for text, loss in parts:
                reader.feed(text, loss)
            last = i, valid
        if reader:
            yield _digest_batch([*rows, reader.row(*last)])

    return _in_order(turns).mapInArrow(run, DIGESTS)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.bool_())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                      [x.split()[0] for x in DIGESTS.split(", ")])

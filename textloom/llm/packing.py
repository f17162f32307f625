"""Operator 8: sum-of-squares online packing of tokenized documents into windows.

Each Spark partition is packed by itself, in the order of its rows, with one
array that counts the partly filled windows of every level.  A document's full
windows are cut off; its rest goes to the level that leaves the smallest sum of
squared counts.  At the end of the partition the windows still open are poured
together into full ones, and what then remains is cut into sequences whose
lengths are powers of two, which need no padding.  Nothing is shuffled, and a
task that is run again reads the same rows and packs them the same way.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from textloom.llm.chunks import byte_bpe, grouped

WINDOW = 2048
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")
# Sequences are numbered within a partition; the partition stands above these bits.
SEQUENCE_BITS = 40


class SumOfSquares:
    """Places sizes from 1 to ``window`` - 1, one after the other, into windows."""

    def __init__(self, window: int = WINDOW):
        self.window = window
        # How many open windows have each fill level; level 0 stands for a new window.
        self.levels = np.zeros(window + 1, np.int64)
        self.open: dict[int, list[int]] = defaultdict(list)
        self.windows = 0

    def place(self, size: int) -> tuple[int, int]:
        """The window and the offset for a piece."""
        n, top = self.levels, self.window - size
        # Moving a window from level h to h + size changes the sum of squares by
        # 2 n[h+size] + 1 - 2 n[h] + 1; full and new windows are not counted.
        change = 2 * (n[size:self.window + 1] - n[:top + 1]) + 2
        change[0] -= 1
        change[top] -= 1
        change[1:][n[1:top + 1] == 0] = np.iinfo(np.int64).max
        level = int(change.argmin())
        if level:
            window = self.open[level].pop()
            n[level] -= 1
        else:
            window, self.windows = self.windows, self.windows + 1
        if level < top:
            self.open[level + size].append(window)
            n[level + size] += 1
        return window, level


def powers(n: int) -> list[int]:
    """The powers of two that add up to ``n``, largest first."""
    return [1 << b for b in reversed(range(n.bit_length())) if n >> b & 1]


class Packer:
    """Pieces of documents; those in windows still open are held back until ``finish``."""

    def __init__(self, window: int = WINDOW):
        self.rule, self.window = SumOfSquares(window), window
        self.parts: dict[int, list[tuple]] = {}
        self.number = 0

    def _next(self) -> int:
        self.number += 1
        return self.number - 1

    def add(self, doc: tuple, ids: np.ndarray) -> Iterator[tuple]:
        """``doc, start, ids, sequence, offset`` of the pieces whose windows are full by now."""
        whole = len(ids) // self.window * self.window
        for start in range(0, whole, self.window):
            yield doc, start, ids[start:start + self.window], self._next(), 0
        rest = ids[whole:]
        if len(rest):
            window, level = self.rule.place(len(rest))
            # A copy, so that the rest doesn't keep the whole document in memory.
            parts = self.parts.setdefault(window, [])
            parts.append((doc, whole, rest.copy(), level))
            if level + len(rest) == self.window:
                sequence = self._next()
                for doc_, start, piece, offset in self.parts.pop(window):
                    yield doc_, start, piece, sequence, offset

    def finish(self) -> Iterator[tuple]:
        """Pour the open windows together, in order of their numbers."""
        left = sum(len(p[2]) for parts in self.parts.values() for p in parts)
        room = [self.window] * (left // self.window) + powers(left % self.window)
        sequence, offset, at = self._next() if room else 0, 0, 0
        for window in sorted(self.parts):
            for doc, start, piece, _ in self.parts[window]:
                while len(piece):
                    if offset == room[at]:
                        at, sequence, offset = at + 1, self._next(), 0
                    n = min(len(piece), room[at] - offset)
                    yield doc, start, piece[:n], sequence, offset
                    start, piece, offset = start + n, piece[n:], offset + n
        self.parts = {}


def pack(docs: DataFrame, path: str, end_id: int = 1, window: int = WINDOW, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents in sequences of at most ``window`` tokens.

    ``docs(doc_id, text)`` is tokenized by the byte-level BPE at ``path`` and each
    document ends with ``end_id``, so a null or empty text has this one token.
    Repeated rows are packed as often as they stand there; other columns are
    ignored.  Columns: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset and, unless ``with_ids`` is false, ids.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (bpe, memo), packer = byte_bpe(path), Packer(window)
        base = TaskContext.get().partitionId() << SEQUENCE_BITS
        ready: list[tuple] = []
        for batch in batches:
            rows = ((i.as_py(), t.as_py() or "") for i, t in zip(batch.column(0), batch.column(1)))
            for group in grouped(rows, 1):
                for (i, _), slots in zip(group, memo.encoded([bpe.keys(t) for _, t in group])):
                    ids = np.append(memo.ids(slots), np.uint32(end_id))
                    ready += packer.add((i, len(ids)), ids)
                if len(ready) > 2000:
                    yield _pieces(ready, base, with_ids)
                    ready = []
        ready += packer.finish()
        if ready:
            yield _pieces(ready, base, with_ids)

    schema = SCHEMA + ", ids array<int>" * with_ids
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _pieces(ready: list[tuple], base: int, with_ids: bool) -> pa.RecordBatch:
    columns = {
        "doc_id": [doc[0] for doc, *_ in ready],
        "start": [start for _, start, *_ in ready],
        "length": [len(ids) for _, _, ids, *_ in ready],
        "ids_crc32": [zlib.crc32(ids.astype("<u4").tobytes()) for _, _, ids, *_ in ready],
        "doc_tokens": [doc[1] for doc, *_ in ready],
        "sequence_id": [base + s for *_, s, _ in ready],
        "offset": [o for *_, o in ready],
    }
    arrays = [pa.array(v, pa.int64()) for v in columns.values()]
    if with_ids:
        arrays.append(pa.array([ids.astype(np.int32) for _, _, ids, *_ in ready], pa.list_(pa.int32())))
    return pa.RecordBatch.from_arrays(arrays, [*columns, *["ids"] * with_ids])

"""Operator 1: token counts kept in segment trees, so that edits re-encode little.

A document's text is cut into leaves of whole pre-tokens.  Its tree sums
characters and tokens over the leaves, as an array in which node ``i`` is the sum
of nodes ``2 i`` and ``2 i + 1``.  Edits find their leaves along the character sums;
those that touch the same leaves are one region.  The regions of many documents are
encoded together, and the sums above their leaves are updated once a document.

A leaf ends where a few neighbouring characters alone make the tokenizer begin a
word: before a space and a non-space, after a line feed or tab between two
non-spaces, and after punctuation and before a letter or digit.  Texts without
spaces are cut as well.  An edit takes in one more leaf on a side only where it
touches these characters.  A run of letters without any such place stays whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.llm.chunks import ChunkMemo, byte_bpe, byte_bpe_keys, grouped, literal

# Words of a leaf when its text is cut anew.
LEAF_WORDS = 32
# Chunks longer than this are cut within.
LONG_CHUNK = 48
EDITS = "array<struct<start:int,stop:int,text:string>>"
TREES = "doc_id long, text string, chars array<int>, tokens array<int>"
COUNTS = ("doc_id long, n_tokens_before long, n_tokens long, n_edits long, n_chars long, "
          "n_chars_encoded long, n_leaves long")
# An apostrophe may belong to the letter after it.
_BORDER = re.compile(r"(?<=[^\w\s'])(?=[^\W_])|(?<=\S[\t-\r])(?=\S)")
Edit = tuple[int, int, str]


def counting_memo(path: str) -> ChunkMemo:
    """Numbers of tokens of chunks; strings of special tokens are ordinary text."""
    return byte_bpe(path, special=False)[1]


def chunks_of(text: str) -> list[str]:
    """``byte_bpe_keys`` with long chunks cut at borders."""
    keys = byte_bpe_keys(text)
    if len(text) < LONG_CHUNK or max(map(len, keys)) < LONG_CHUNK:
        return keys
    out: list[str] = []
    for k in keys:
        if len(k) < LONG_CHUNK:
            out.append(k)
        else:
            first, *rest = _BORDER.split(literal(k))
            # A border never follows the space that begins a plain chunk.
            out.append(k[:len(k) - sum(map(len, rest))])
            out += [" " + x for x in rest]
    return out


def leaves_of(text: str, keys: list[str], tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Characters and tokens of the leaves of a text, from its chunks and their numbers of tokens."""
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # A plain key stands for a space and itself, another one has a space too many.
    plain = np.array([k[0] != " " for k in keys])
    size = np.array([len(k) for k in keys], np.int64) + np.where(plain, 1, -1)
    if not plain.all():
        at = np.cumsum(size) - size
        for i in np.flatnonzero(~plain).tolist():
            plain[i] = _BORDER.match(text, int(at[i])) is not None
        plain[0] = True
    begin = np.flatnonzero(plain)[::LEAF_WORDS]
    return np.add.reduceat(size, begin), np.add.reduceat(tokens, begin)


def leaves_of_all(texts: list[str], memo: ChunkMemo) -> list[tuple[np.ndarray, np.ndarray]]:
    """The leaves of many texts, whose chunks are looked up together."""
    keys = [chunks_of(t) for t in texts]
    counts = [memo.sizes(slots) for slots in memo.encoded(keys)] if texts else []
    return [leaves_of(*x) for x in zip(texts, keys, counts)]


class TokenTree:
    """A text with the sums of its leaves."""

    def __init__(self, text: str, memo: ChunkMemo, chars=None, tokens=None, leaves=None):
        self.text, self.memo, self.encoded = text, memo, 0
        if chars is None:
            self._build(*(leaves or leaves_of_all([text], memo)[0]))
        else:
            self.chars, self.tokens = np.array(chars, np.int64), np.array(tokens, np.int64)
            self.width = len(self.chars) // 2

    def _build(self, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.width = 1 << max(0, len(chars) - 1).bit_length()
        self.chars, self.tokens = (self._sums(x) for x in (chars, tokens))

    def _sums(self, leaves: np.ndarray) -> np.ndarray:
        tree = np.zeros(2 * self.width, np.int64)
        tree[self.width:self.width + len(leaves)] = leaves
        level = self.width
        while level > 1:
            tree[level // 2:level] = tree[level:2 * level].reshape(-1, 2).sum(axis=1)
            level //= 2
        return tree

    @property
    def n_tokens(self) -> int:
        return int(self.tokens[1])

    def regions(self, edits: list[Edit]) -> list[tuple[int, int, str]]:
        """Runs of leaves that edits touch, with their new text; ``text`` becomes the edited one.

        The edits are in order and do not overlap.
        """
        ends = np.cumsum(self.chars[self.width:])
        total = int(ends[-1])
        begins = np.r_[0, ends[:-1]]

        def leaf(char: np.ndarray) -> np.ndarray:
            return np.searchsorted(ends, np.clip(char, 0, max(0, total - 1)), "right").clip(max=len(ends) - 1)

        start, stop = (np.array([e[k] for e in edits], np.int64) for k in (0, 1))
        first, last = leaf(start), leaf(np.maximum(start, stop - 1))
        # An edit of the two characters at a leaf's border takes in the leaf on the other side.
        first = np.where(start < begins[first] + 2, leaf(begins[first] - 1), first)
        last = np.where(stop >= ends[last] - 1, leaf(ends[last]), last)
        new_run = np.r_[True, first[1:] > np.maximum.accumulate(last)[:-1]]
        out, whole, at = [], [], 0
        for mine in np.split(np.arange(len(edits)), np.flatnonzero(new_run)[1:]):
            lo, hi = int(first[mine[0]]), int(last[mine].max())
            here, parts = int(begins[lo]), []
            whole.append(self.text[at:here])
            for a, z, new in (edits[i] for i in mine):
                parts += [self.text[here:a], new]
                here = z
            at = int(ends[hi])
            out.append((lo, hi, "".join([*parts, self.text[here:at]])))
            whole.append(out[-1][2])
        self.text = "".join([*whole, self.text[at:]])
        return out

    def replace(self, regions: list[tuple[int, int, str]], leaves: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """Put the leaves of the regions' new texts in place of the old ones."""
        self.encoded += sum(len(text) for _, _, text in regions)
        if any(len(chars) > hi - lo + 1 for (lo, hi, _), (chars, _) in zip(regions, leaves)):
            # More leaves than before: the others move up, with the counts they have.
            for tree, k in ((self.chars, 0), (self.tokens, 1)):
                old, parts, at = tree[self.width:], [], 0
                for (lo, hi, _), new in zip(regions, leaves):
                    parts += [old[at:lo], new[k]]
                    at = hi + 1
                joined = np.concatenate([*parts, old[at:]])
                chars, tokens = (joined, None) if k == 0 else (chars, joined)
            full = chars > 0
            self._build(chars[full], tokens[full])
            return
        at = np.concatenate([np.arange(lo, hi + 1) for lo, hi, _ in regions]) + self.width
        for tree, k in ((self.chars, 0), (self.tokens, 1)):
            tree[at] = np.concatenate([np.r_[new[k], np.zeros(hi - lo + 1 - len(new[k]), np.int64)]
                                       for (lo, hi, _), new in zip(regions, leaves)])
        while at[0] > 1:
            at = np.unique(at // 2)
            for tree in (self.chars, self.tokens):
                tree[at] = tree[2 * at] + tree[2 * at + 1]

    def edit(self, start: int, stop: int, new: str) -> None:
        """Put ``new`` in place of the characters from ``start`` to ``stop``."""
        edit_all([(self, [(start, stop, new)])], self.memo)


def usable(edits: list[Edit], length: int) -> list[Edit]:
    """The edits in order, without those that overlap an earlier one or leave the text."""
    out, done = [], 0
    for start, stop, new in sorted(edits):
        if done <= start <= stop <= length:
            out.append((start, stop, new))
            done = stop
    return out


def edit_all(work: list[tuple[TokenTree, list[Edit]]], memo: ChunkMemo) -> None:
    """Apply usable edits to many trees; all regions are encoded together."""
    touched = [(tree, tree.regions(edits)) for tree, edits in work if edits]
    leaves = iter(leaves_of_all([text for _, regions in touched for _, _, text in regions], memo))
    for tree, regions in touched:
        tree.replace(regions, [next(leaves) for _ in regions])


def _listed(edits: list[dict] | None) -> list[Edit]:
    return [(e["start"], e["stop"], e["text"] or "") for e in edits or []]


def build_trees(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, text, chars, tokens``: a tree for each row; null and empty texts have one empty leaf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = counting_memo(path)
        for group in _groups(batches):
            leaves = leaves_of_all([t for _, t in group], memo)
            yield _trees([(i, TokenTree(t, memo, leaves=x)) for (i, t), x in zip(group, leaves)])

    return docs.select("doc_id", "text").mapInArrow(run, TREES)


def edit_trees(trees: DataFrame, edits: DataFrame, path: str) -> DataFrame:
    """The trees after ``edits(doc_id, start, stop, text)``, which count characters of the texts as they are.

    Edits of a document are applied from the left; one that overlaps an earlier
    one or leaves the text is left out, as are those of unknown documents.  A null
    text deletes.  Documents without edits pass unread.
    """
    listed = edits.filter("doc_id IS NOT NULL AND start IS NOT NULL AND stop IS NOT NULL").groupBy("doc_id").agg(
        F.collect_list(F.struct("start", "stop", "text")).cast(EDITS).alias("edits"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = counting_memo(path)
        for batch in batches:
            work, ids = [], []
            for row in batch.to_pylist():
                tree = TokenTree(row["text"] or "", memo, row["chars"], row["tokens"])
                work.append((tree, usable(_listed(row["edits"]), len(tree.text))))
                ids.append(row["doc_id"])
            edit_all(work, memo)
            yield _trees([(i, tree) for i, (tree, _) in zip(ids, work)])

    return trees.join(listed, "doc_id", "left").select("doc_id", "text", "chars", "tokens", "edits").mapInArrow(run, TREES)


def _trees(rows: list[tuple[int, TokenTree]]) -> pa.RecordBatch:
    sums = pa.list_(pa.int32())
    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in rows], pa.int64()), pa.array([t.text for _, t in rows], pa.string()),
         pa.array([t.chars.astype(np.int32) for _, t in rows], sums), pa.array([t.tokens.astype(np.int32) for _, t in rows], sums)],
        ["doc_id", "text", "chars", "tokens"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    for batch in batches:
        rows = zip(*(batch.column(k) for k in range(batch.num_columns)))
        yield from grouped(((x[0].as_py(), x[1].as_py() or "", *(y.as_py() for y in x[2:])) for x in rows), 1)


def count_edited(docs: DataFrame, edits: Column | Callable[[str], list[Edit]], path: str) -> DataFrame:
    """Token counts of each row of ``docs(doc_id, text)`` before and after edits of its text.

    ``edits`` is an array column of ``start, stop, text``, or a function that finds
    the edits in a text.  An edit that overlaps an earlier one is left out.  The trees
    of a group of texts are built together, edited together and left; nothing is
    shuffled.  Null texts and null arrays are empty; repeated rows give repeated
    results; an empty table gives no rows.
    """
    asked = not isinstance(edits, Column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = counting_memo(path)
        for group in _groups(batches):
            trees = [TokenTree(t, memo, leaves=x) for (_, t, *_), x in zip(group, leaves_of_all([t for _, t, *_ in group], memo))]
            before = [t.n_tokens for t in trees]
            wanted = [usable(edits(t) if asked else _listed(*e), len(t)) for _, t, *e in group]
            edit_all(list(zip(trees, wanted)), memo)
            rows = [(row[0], n, tree.n_tokens, len(e), len(tree.text), tree.encoded, int((tree.chars[tree.width:] > 0).sum()))
                    for row, n, tree, e in zip(group, before, trees, wanted)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], [x.split()[0] for x in COUNTS.split(", ")])

    columns = ["doc_id", "text"] if asked else ["doc_id", "text", edits.cast(EDITS).alias("edits")]
    return docs.select(*columns).mapInArrow(run, COUNTS)

"""Ids of short text chunks, looked up in bulk and remembered by each worker.

Texts are cut where no token can reach across, so the same chunk always has the
same ids.  A worker keeps the ids of the chunks it has met, up to ``limit``
chunks; then it starts afresh.  The memory of a worker is thus bounded, and
losing an executor loses nothing but this memory.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa

# Characters of text that are encoded together.
GROUP_CHARS = 500_000
# Chunks a worker remembers.
LIMIT = 300_000

_BEFORE_WORD = re.compile(r" (?=\S)")


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


def give_back() -> None:
    """Return memory that Arrow holds for batches that are done; workers live on for later stages."""
    pa.default_memory_pool().release_unused()


class Grown:
    """A numpy array that is appended to."""

    def __init__(self, dtype):
        self.values, self.n = np.empty(1024, dtype), 0

    def extend(self, more: np.ndarray) -> None:
        need = self.n + len(more)
        if need > len(self.values):
            self.values = np.concatenate([self.values[: self.n], np.empty(max(need, self.n), self.values.dtype)])
        self.values[self.n:need] = more
        self.n = need


class ChunkMemo:
    """``encode(chunks)`` returns the flat ids and the number of ids of each of the new chunks."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], limit: int = LIMIT):
        self.encode, self.limit = encode, limit
        self.clear()

    def clear(self) -> None:
        self.slot: dict[str, int] = {}
        self.flat, self.start, self.size = Grown(np.uint32), Grown(np.int64), Grown(np.int64)

    def slots(self, chunks: list[str]) -> np.ndarray:
        """A number for each chunk; ``start`` and ``size`` say where its ids stand in ``flat``."""
        got = np.fromiter(map(self.slot.get, chunks, repeat(-1)), np.int64, len(chunks))
        missing = np.flatnonzero(got < 0)
        if len(missing):
            new = list(dict.fromkeys(chunks[i] for i in missing))
            ids, sizes = self.encode(new)
            base = len(self.slot)
            self.start.extend(self.flat.n + np.cumsum(sizes) - sizes)
            self.size.extend(sizes)
            self.flat.extend(ids)
            self.slot.update(zip(new, range(base, base + len(new))))
            got[missing] = [self.slot[chunks[i]] for i in missing]
        return got

    def sizes(self, slots: np.ndarray) -> np.ndarray:
        return self.size.values[slots]

    def ids(self, slots: np.ndarray) -> np.ndarray:
        """The ids of the chunks, one after the other."""
        size = self.size.values[slots]
        ends = np.cumsum(size)
        if not len(ends):
            return np.empty(0, np.uint32)
        at = np.repeat(self.start.values[slots] - (ends - size), size) + np.arange(ends[-1])
        return self.flat.values[at]

    def encoded(self, split: list[list[str]]) -> Iterator[np.ndarray]:
        """The slots of each of the texts, which are given as lists of chunks."""
        if len(self.slot) > self.limit:
            self.clear()
        lengths = np.cumsum([len(c) for c in split])
        all_slots = self.slots([c for chunks in split for c in chunks])
        return iter(np.split(all_slots, lengths[:-1]))


def grouped(items: Iterable[tuple], text_at: int, chars: int = GROUP_CHARS) -> Iterator[list[tuple]]:
    """Lists of items whose texts have about ``chars`` characters together; a longer text stands alone."""
    group, held = [], 0
    for item in items:
        n = len(item[text_at])
        if group and held + n > chars:
            yield group
            group, held = [], 0
        group.append(item)
        held += n
    if group:
        yield group


# --- byte-level BPE whose words take a leading space ----------------------------------
#
# A chunk is written as its key: "word" stands for " word", and a chunk that is no
# space followed by a non-space has one more space in front, so " \n" stands for "\n".


def literal(key: str) -> str:
    return key[1:] if key[0] == " " else " " + key


def byte_bpe_keys(text: str) -> list[str]:
    """The keys of a text's chunks for a tokenizer with ``public_tokenizers.PATTERN``.

    Its words always begin anew at a space before a non-space.  A line feed
    between two other non-spaces is a word of its own.
    """
    if not text:
        return []
    lines = text.split("\n")
    if any(not x or x[0].isspace() or x[-1].isspace() for x in lines):
        return _at_spaces(text)
    out: list[str] = []
    for line in lines:
        if line.isprintable() and "  " not in line:
            # No white space but single spaces between words.
            words = line.split(" ")
            words[0] = " " + words[0]
            out += words
        else:
            out += _at_spaces(line)
        out.append(" \n")
    out.pop()
    return out


def _at_spaces(text: str) -> list[str]:
    first, *rest = _BEFORE_WORD.split(text)
    return [" " + first, *rest] if first else rest


class ByteBpe:
    """A byte-level BPE from a ``tokenizers`` file, run by tiktoken on its vocabulary."""

    def __init__(self, path: str, special: bool = True):
        import tiktoken
        from public_tokenizers import PATTERN

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        number = {c: b for b, c in enumerate(byte_characters())}
        named = {t["content"]: t["id"] for t in spec["added_tokens"]}
        # Ids follow the order of the merges, so they are the ranks.
        ranks = {bytes(number[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in named}
        self.special = named if special else {}
        self.codec = tiktoken.Encoding("bytes", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)
        self.length = np.zeros(max([*ranks.values(), *named.values()]) + 1, np.int64)
        for token, i in [*ranks.items(), *((t.encode(), i) for t, i in self.special.items())]:
            self.length[i] = len(token)

    def keys(self, text: str) -> list[str]:
        """Keys of the chunks of a text; one with the string of a special token is left whole."""
        if any(s in text for s in self.special):
            return [" " + text]
        return byte_bpe_keys(text)

    def encode(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of chunks and the number of ids of each."""
        # Plain chunks are encoded in one text, as nothing reaches across their first spaces.
        plain = np.array([k[0] != " " for k in keys])
        joined = [" " + k for k in keys if k[0] != " "]
        ids = self.codec.encode_to_numpy("".join(joined)) if joined else np.empty(0, np.uint32)
        ends = np.cumsum([len(c.encode("utf-8", "replace")) for c in joined])
        upto = np.searchsorted(np.cumsum(self.length[ids]), ends, side="left") + 1
        size = np.zeros(len(keys), np.int64)
        size[plain] = np.diff(np.r_[0, upto]) if joined else 0
        others = [self.codec.encode(k[1:], allowed_special="all") for k in keys if k[0] == " "]
        size[~plain] = [len(x) for x in others]
        flat = np.empty(size.sum(), np.uint32)
        is_plain = np.repeat(plain, size)
        flat[is_plain] = ids
        flat[~is_plain] = [i for x in others for i in x]
        return flat, size


@lru_cache
def byte_bpe(path: str, special: bool = True) -> tuple[ByteBpe, ChunkMemo]:
    """The tokenizer and its memory, shared by the tasks of a worker."""
    bpe = ByteBpe(path, special)
    return bpe, ChunkMemo(bpe.encode)

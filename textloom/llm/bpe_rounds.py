"""Operator 9: BPE encoding and decoding by batched merge rounds in numpy.

The symbols of many words stand in one flat array.  In each round every word
looks up the ranks of its neighbouring pairs by binary search over the sorted
pair keys, and merges its lowest-ranked pair wherever it stands, from the left.
A word without a known pair is done.  Spark deals the texts out; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from textloom.llm.chunks import ChunkMemo, byte_characters, grouped

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
_NO_PAIR = np.iinfo(np.int64).max
# White space as the tokenizer's pattern has it.
_SPACE = "\t-\r \x85\xa0  -     　"
_WORDS = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|\p{{L}}+|\p{{N}}|[^{_SPACE}\p{{L}}\p{{N}}]+")
_SPACES = re.compile(f"[{_SPACE}]+")
# str.split() also splits at these, the tokenizer doesn't.
_SEPARATORS = re.compile("[\x1c-\x1f]")


class WordBpe:
    """A BPE with word ends, read from a ``tokenizers`` file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        end = spec["model"]["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for token, i in [*vocab.items(), *self.special.items()]:
            self.token[i] = token
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        chars = byte_characters()
        self.first = np.array([vocab[c] for c in chars], np.int64)
        self.last = np.array([vocab[c + end] for c in chars], np.int64)
        names = sorted(self.special, key=len, reverse=True)
        self.at_special = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None

    # --- texts to words ---------------------------------------------------------------

    def words(self, chunk: str) -> list[str]:
        """The words of a piece of text without white space."""
        # A capital sigma is lowered without regard to its place, unlike str.lower() does.
        return _WORDS.findall(unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower())

    def chunks(self, text: str) -> list[str]:
        """Pieces without white space, which words never reach across; special tokens stand alone."""
        if self.at_special and self.at_special.search(text):
            parts = self.at_special.split(text)
            return [c for i, part in enumerate(parts) for c in ([part] if i % 2 else self._plain(part))]
        return self._plain(text)

    @staticmethod
    def _plain(text: str) -> list[str]:
        if _SEPARATORS.search(text):
            return [c for c in _SPACES.split(text) if c]
        return text.split()

    # --- words to ids -----------------------------------------------------------------

    def merge(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of non-empty words and the number of ids of each."""
        raw = [w.encode("utf-8", "replace") for w in words]
        size = np.array([len(b) for b in raw], np.int64)
        joined = np.frombuffer(b"".join(raw), np.uint8)
        symbols, word = self.first[joined], np.repeat(np.arange(len(raw)), size)
        ends = np.cumsum(size) - 1
        symbols[ends] = self.last[joined[ends]]
        ready: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols) > 1:
            key = symbols[:-1] << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.rank[at], _NO_PAIR)
            rank = np.append(rank, _NO_PAIR)
            begin = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.minimum.reduceat(rank, begin)
            # Words without a pair are set aside, so later rounds touch unfinished words only.
            open_word = np.repeat(lowest < _NO_PAIR, np.diff(np.r_[begin, len(word)]))
            if not open_word.all():
                ready.append((word[~open_word], symbols[~open_word]))
                rank, word, symbols = rank[open_word], word[open_word], symbols[open_word]
                lowest = lowest[lowest < _NO_PAIR]
                if not len(symbols):
                    break
                begin = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            best = np.repeat(lowest, np.diff(np.r_[begin, len(word)]))
            hit = rank == best
            # In a run of overlapping pairs every second one is merged, from the left.
            starts = np.flatnonzero(hit & ~np.r_[False, hit[:-1]])
            place = np.arange(len(hit))
            run = np.zeros(len(hit), np.int64)
            run[starts] = place[starts]
            hit &= (place - np.maximum.accumulate(run)) % 2 == 0
            symbols = symbols.copy()
            symbols[hit] = self.made[rank[hit]]
            stays = ~np.r_[False, hit[:-1]]
            symbols, word = symbols[stays], word[stays]
        ready.append((word, symbols))
        word, symbols = (np.concatenate(x) for x in zip(*ready))
        order = np.argsort(word, kind="stable")
        return symbols[order].astype(np.uint32), np.bincount(word, minlength=len(raw)).astype(np.int64)

    def encode_chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of chunks and the number of ids of each."""
        split = [[] if c in self.special else self.words(c) for c in chunks]
        ids, size = self.merge([w for words in split for w in words] or [" "])
        owner = np.repeat(np.arange(len(chunks)), [len(w) for w in split])
        per_chunk = np.bincount(owner, size[:len(owner)], len(chunks)).astype(np.int64)
        if not len(owner):
            ids = ids[:0]
        special = [i for i, c in enumerate(chunks) if c in self.special]
        if special:
            at = (np.cumsum(per_chunk) - per_chunk)[special]
            ids = np.insert(ids, at, [self.special[chunks[i]] for i in special])
            per_chunk[special] = 1
        return ids.astype(np.uint32), per_chunk

    def decode(self, ids) -> str:
        """The tokens of the ids, joined by spaces: this tokenizer has no decoder of its own."""
        return " ".join(map(self.token.__getitem__, ids))


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids`` of every whole text, as the tokenizers library encodes it without added tokens.

    Null and empty texts have no ids; repeated rows give repeated results; other
    columns are ignored.  Strings of special tokens become their ids.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, codes in _encoded(path, batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([c.astype(np.int32) for c in codes], pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(coded: DataFrame, path: str) -> DataFrame:
    """``doc_id, text`` of ``coded(doc_id, ids)``; null ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = word_bpe(path)
        for batch in batches:
            texts = [bpe.decode(x.as_py() or []) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return coded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """``encode`` and ``decode`` of every text in one pass, as counts and SHA-256 digests."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, _ = word_bpe(path)
        for ids, codes in _encoded(path, batches):
            digest = [hashlib.sha256(c.astype("<u4").tobytes()).hexdigest() for c in codes]
            text = [hashlib.sha256(bpe.decode(c.tolist()).encode("utf-8")).hexdigest() for c in codes]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(c) for c in codes], pa.int64()), pa.array(digest), pa.array(text)],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


@lru_cache
def word_bpe(path: str) -> tuple[WordBpe, ChunkMemo]:
    """The tokenizer and its memory, shared by the tasks of a worker."""
    bpe = WordBpe(path)
    return bpe, ChunkMemo(bpe.encode_chunks)


def _encoded(path: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[np.ndarray]]]:
    bpe, memo = word_bpe(path)
    for batch in batches:
        rows = ((i.as_py(), t.as_py() or "") for i, t in zip(batch.column(0), batch.column(1)))
        for group in grouped(rows, 1):
            slots = memo.encoded([bpe.chunks(t) for _, t in group])
            yield [i for i, _ in group], [memo.ids(s) for s in slots]

"""Operator 5: quality rules as a short-circuit cascade.

Every document gets its base measures.  The rules beyond them are tried in the
order of rejections per cost, both estimated on a sample, and a document that a
rule rejects is not shown to the later ones.  The verdict is that of all rules
together, so it doesn't depend on the order; only the work does.
"""

from __future__ import annotations

import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Documents that cost and selectivity are estimated on, at most.
SAMPLE_DOCS = 500
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean")


class Doc:
    """A text with its words, cut at ASCII white space, and what is counted in them."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.raw = self.text.encode("utf-8", "replace")
        self.words = self.raw.split()

    def measures(self) -> dict[str, int]:
        raw, words = self.raw, self.words
        # Code points: bytes that don't continue a character.
        chars = len(self.text) - sum(raw.count(c) for c in (b" ", b"\t", b"\n", b"\r", b"\v", b"\f"))
        lines = [x for x in raw.split(b"\n") if x and not x.isspace()]
        m = {"n_words": len(words), "word_chars": chars,
             "n_symbols": sum(raw.count(s.encode()) for s in SYMBOLS),
             "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": repeat_words(words)}
        self.__dict__.update(m)
        self.n_lines = len(lines)
        return m

    @property
    def base_failed(self) -> bool:
        return self.n_words < MIN_WORDS or 100 * self.n_repeat_words > MAX_REPEAT_PERCENT * self.n_words


def repeat_words(words: list[bytes]) -> int:
    """Words that stand in a window of three words found more than once."""
    n = len(words) - 2
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    w = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, len(words))
    bits = len(number).bit_length()
    if bits <= 21:
        key = (w[:-2] << 2 * bits) | (w[1:-1] << bits) | w[2:]
    else:
        key = np.unique(np.stack([w[:-2], w[1:-1], w[2:]], 1), axis=0, return_inverse=True)[1].ravel()
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    again = np.zeros(n, bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    hit = np.zeros(len(words), bool)
    for k in range(3):
        hit[k:k + n] |= again
    return int(hit.sum())


@dataclass(frozen=True)
class Rule:
    """``rejects(doc)`` may use the measures of a document that passed the base rules."""

    name: str
    rejects: Callable[[Doc], bool]


def _mean_length(d: Doc) -> bool:
    return d.word_chars < 2 * d.n_words or d.word_chars > 15 * d.n_words


def _symbols(d: Doc) -> bool:
    return 10 * d.n_symbols > d.n_words


def _dup_lines(d: Doc) -> bool:
    return 2 * d.n_dup_lines > d.n_lines


def _no_letters(d: Doc) -> bool:
    # A word counts when any of its bytes is a letter or belongs to a longer character.
    lettered = sum(1 for w in d.words if not w.isascii() or w.upper() != w.lower())
    return 2 * lettered < d.n_words


def _one_word(d: Doc) -> bool:
    return 10 * max(Counter(d.words).values()) > 3 * d.n_words


def _ellipses(d: Doc) -> bool:
    ends = [x.rstrip() for x in d.raw.split(b"\n")]
    return 10 * sum(x.endswith((b"...", "…".encode())) for x in ends) > 3 * max(1, d.n_lines)


RULES = (Rule("mean_length", _mean_length), Rule("symbols", _symbols), Rule("dup_lines", _dup_lines),
         Rule("no_letters", _no_letters), Rule("one_word", _one_word), Rule("ellipses", _ellipses))


def plan(texts: list[str], rules: tuple[Rule, ...] = RULES) -> list[tuple[str, float, float]]:
    """``name, cost in seconds, share rejected`` of each rule, best rejections per cost first."""
    docs = [d for d in map(Doc, texts) if d.measures() and not d.base_failed]
    found = []
    for rule in rules:
        began = time.process_time()
        rejected = sum(rule.rejects(d) for d in docs)
        cost = (time.process_time() - began) / max(1, len(docs))
        found.append((rule.name, cost, rejected / max(1, len(docs))))
    return sorted(found, key=lambda x: (-x[2] / max(x[1], 1e-9), x[1], x[0]))


def sample_texts(docs: DataFrame, n: int = SAMPLE_DOCS) -> list[str]:
    """At most ``n`` texts, those with the smallest hashes of their ids."""
    by = F.xxhash64(F.col("doc_id").cast("string"))
    ids = docs.filter("text IS NOT NULL").select("doc_id", by.alias("h")).orderBy("h", "doc_id").limit(n)
    some = docs.select("doc_id", "text").join(F.broadcast(ids.select("doc_id").distinct()), "doc_id")
    return [r.text for r in some.select("text").limit(n).collect()]


def judge(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample: int = SAMPLE_DOCS) -> DataFrame:
    """The base measures and the verdict for each row of ``docs(doc_id, text)``.

    A null text has no words, so it fails as an empty one does.  Repeated rows are
    judged alike; ties between rules in the plan go to the cheaper, then to the
    name; an empty table gives no rows; other columns are ignored.
    """
    names = [name for name, _, _ in plan(sample_texts(docs, sample), rules)]
    ordered = sorted(rules, key=lambda r: names.index(r.name))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column(1):
                doc = Doc(text.as_py())
                m = list(doc.measures().values())
                failed = doc.base_failed
                rows.append([*m, failed, not failed and not any(r.rejects(doc) for r in ordered)])
            columns = list(zip(*rows)) if rows else [[]] * 7
            arrays = [pa.array(c, pa.int64()) for c in columns[:5]] + [pa.array(c, pa.bool_()) for c in columns[5:]]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], ["doc_id", *MEASURES, "base_failed", "kept"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)

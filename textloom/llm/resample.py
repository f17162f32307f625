"""Operator 12: resampling of documents towards a target distribution.

Texts become words joined by single spaces.  For each length a regular expression
with look-arounds at both borders is run over them with overlapping matches, and each
match is the span of an n-gram, whose CRC-32 names its bucket.  A document's weight is
the sum of its features' gains, the log ratio of a bucket's share in the target to
that in the documents; documents are drawn without replacement by weight plus
Gumbel noise.

Each text is scanned once.  The buckets of a document are written as bytes of its
features, and counts and weights come from these.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.lookup import pick
from textloom.operators.ranking import rank_rows
from textloom.session import materialize

_APART = regex.compile(rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+")


@dataclass(frozen=True)
class Settings:
    shortest: int = 1       # words of a feature, at least and at most
    longest: int = 1
    buckets: int = 10000
    min_words: int = 20     # of a document that may be drawn
    percent: int = 10       # of these documents that are drawn
    seed: str = "2024"
    scale: int = 1000       # gains, noise and scores are whole numbers in this unit


DEFAULT = Settings()


@lru_cache
def _runs(words: int):
    """Runs of so many words between single spaces."""
    return regex.compile(rb"(?<![^ ])[^ ]++(?: [^ ]++){%d}(?![^ ])" % (words - 1))


def spaced(text: bytes) -> bytes:
    """The words of a text in UTF-8 with A-Z in lower case, between single spaces."""
    return _APART.sub(b" ", text.lower()).strip(b" ")


def spans(words: bytes, s: Settings = DEFAULT) -> Iterator[tuple[int, int]]:
    """Start and end of all features in a text made by ``spaced``, by length and place."""
    for n in range(s.shortest, s.longest + 1):
        for m in _runs(n).finditer(words, overlapped=True):
            yield m.span()


def text_buckets(words: bytes, s: Settings = DEFAULT) -> np.ndarray:
    """The bucket of each feature, repeats included."""
    return np.fromiter((crc32(words[a:z]) for a, z in spans(words, s)), np.int64) % s.buckets


FEATURES = "n_words long, n_features long, buckets array<int>, counts array<int>"


def featurize(texts: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """``texts`` without ``text``, with its number of words and features and its buckets with their counts.

    A null text has no words.  Columns of these names are replaced.
    """
    added = [x.split()[0] for x in FEATURES.split(", ")]
    texts = texts.drop(*added)
    kept = [c for c in texts.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, features, buckets, counts = [], [], [], []
            for t in batch.column("text").cast(pa.binary()):
                spoken = spaced(t.as_py() or b"")
                found = text_buckets(spoken, s)
                at, n = np.unique(found, return_counts=True)
                words.append(spoken.count(b" ") + 1 if spoken else 0)
                features.append(len(found))
                buckets.append(at.astype(np.int32))
                counts.append(n.astype(np.int32))
            lists = [pa.array(x, pa.list_(pa.int32())) for x in (buckets, counts)]
            numbers = [pa.array(x, pa.int64()) for x in (words, features)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *numbers, *lists], [*kept, *added])

    fields = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.select(*kept).schema), FEATURES])
    return texts.mapInArrow(run, fields)


def bucket_counts(featured: DataFrame, s: Settings = DEFAULT) -> np.ndarray:
    """How many features of all texts are in each bucket; ``s.buckets`` numbers, whatever the input."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(s.buckets, np.int64)
        for b in batches:
            np.add.at(total, b.column(0).flatten().to_numpy(), b.column(1).flatten().to_numpy())
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    sums = featured.select("buckets", "counts").mapInArrow(add, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(s.buckets, np.int64)
    for row in sums.collect():
        out[row["bucket"]] = row["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray, s: Settings = DEFAULT) -> np.ndarray:
    """The gain of each bucket from its counts in the documents and in the target."""
    in_source, in_target = (float(x.sum()) + s.buckets for x in (source, target))
    return np.array([math.floor(s.scale * math.log((t + 1.0) * in_source / ((n + 1.0) * in_target)))
                     for n, t in zip(source.tolist(), target.tolist())], np.int64)


def weigh(featured: DataFrame, gain: np.ndarray) -> DataFrame:
    """``featured`` with ``weight``, the sum of the gains of a document's features, in place of its buckets."""
    kept = [c for c in featured.columns if c not in ("buckets", "counts", "weight")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("buckets")
            ends = np.r_[0, np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))]
            sums = np.r_[0, np.cumsum(gain[lists.flatten().to_numpy()] * b.column("counts").flatten().to_numpy())]
            weight = pa.array(sums[ends[1:]] - sums[ends[:-1]], pa.int64())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), weight], [*kept, "weight"])

    narrow = featured.select(*kept)
    return featured.mapInArrow(run, narrow.withColumn("weight", F.lit(0).cast("long")).schema)


def noise(doc_id: F.Column, s: Settings = DEFAULT) -> F.Column:
    """Gumbel noise in whole units, from the first 32 bits of a hash of seed and id."""
    text = F.concat(F.lit(f"{s.seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 8), 16, 10).cast("long")
    return F.floor(-s.scale * F.log(-F.log((h + 0.5) / 4294967296.0)))


def rank(docs: DataFrame, target: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` of all rows of ``docs`` (doc_id, text).

    ``target`` has ``text``.  Of the N documents with ``s.min_words`` words, the
    ``floor(percent * N / 100)`` with the highest scores get ranks from 1, ties to the
    smaller id; a null id counts as an empty one and comes last in a tie.  The others' rank is
    null.  Texts that are null or have no words have weight 0.  Each row is a document
    of its own, repeated rows too.  An empty target or table is fine; other columns
    are left out.
    """
    featured = materialize(featurize(docs.select("doc_id", "text"), s), "resample-features")
    wanted = bucket_counts(featurize(target.select("text"), s), s)
    weighed = weigh(featured, gains(bucket_counts(featured, s), wanted, s))
    score = (F.col("weight") + noise(F.col("doc_id"), s)).alias("score")
    scored = materialize(weighed.select("doc_id", "n_words", "n_features", "weight", score), "resample-scores")
    columns = ["doc_id", "n_features", "weight", "score"]
    able = scored.filter(F.col("n_words") >= s.min_words).select(*columns)
    drawn = s.percent * able.count() // 100
    ranked = rank_rows(able, [F.desc("score"), F.asc_nulls_last("doc_id")])
    place = F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank")
    rest = scored.filter(F.col("n_words") < s.min_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked.select(*columns, place).unionByName(rest)


def draw(docs: DataFrame, target: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """The rows of ``docs`` whose id is drawn, with all their columns; ids should be unique, and a null id is never drawn."""
    return pick(docs, rank(docs, target, s).filter("rank IS NOT NULL").select("doc_id").distinct(), "doc_id")

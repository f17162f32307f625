"""Operator 2: toxicity by non-negative positive-unlabelled learning.

Linear classifiers over hashed words are trained from documents confirmed as
toxic and from unlabelled ones.  The risk of the unlabelled part is corrected by
the class prior, R = pi R+(+1) + max(0, Ru(-1) - pi R+(-1)); where the corrected
part turns negative, its gradient is reversed.  Each classifier is trained in a
Spark task of its own on its own bounded sample; scores are their mean.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.llm.chunks import give_back

BUCKETS = 1 << 18
# Words whose bucket a task remembers.
CACHED_WORDS = 60_000
_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class Settings:
    """Bounds and parameters of the training."""

    bags: int = 4                # classifiers
    positives: int = 4000        # toxic documents a bag learns from, at most
    unlabelled: int = 8000       # unlabelled documents a bag learns from, at most
    steps: int = 1000
    batch: int = 512
    rate: float = 0.03
    decay: float = 1e-3
    prior: float | None = None   # share of toxic documents; None: that of the labelled ones
    seed: int = 7


DEFAULT = Settings()


def text_features(text: str | None, cache: dict[str, int]) -> np.ndarray:
    """The distinct hash buckets of a text's words in lower case."""
    words = set(_WORD.findall((text or "").lower()))
    got = list(map(cache.get, words, repeat(-1)))
    if -1 in got:
        if len(cache) > CACHED_WORDS:
            cache.clear()
        for w in words:
            if w not in cache:
                cache[w] = xxhash.xxh64_intdigest(w.encode("utf-8", "replace")) % BUCKETS
        got = [cache.get(w, 0) for w in words]
    return np.unique(np.array(got, np.int64))


def _rows(features: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    size = np.array([len(f) for f in features], np.int64)
    return np.repeat(np.arange(len(features)), size), np.concatenate([*features, np.empty(0, np.int64)]).astype(np.int64)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def telling_buckets(pos: list[np.ndarray], unl: list[np.ndarray], s: Settings) -> np.ndarray:
    """The buckets whose shares of toxic and of unlabelled documents differ by more than chance.

    The difference is measured in standard errors and must exceed what the largest of
    so many differences would reach by chance, so a word in few documents counts where
    few are all there are.
    """
    if not pos or not unl:
        return np.empty(0, np.int64)
    in_pos, in_unl = (np.bincount(np.concatenate(x), minlength=BUCKETS) for x in (pos, unl))
    both = (in_pos + in_unl) / (len(pos) + len(unl))
    error = np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / len(pos) + 1 / len(unl)))
    z = np.abs(in_pos / len(pos) - in_unl / len(unl)) / error
    return np.flatnonzero(z > np.sqrt(2 * np.log(max(2, np.count_nonzero(both)))))


def fit_nnpu(pos: list[np.ndarray], unl: list[np.ndarray], prior: float, s: Settings, seed: int) -> tuple[np.ndarray, float]:
    """Weights of the buckets and the intercept, by Adam on the non-negative risk of the logistic loss."""
    w, bias = np.zeros(BUCKETS), float(np.log(prior / (1 - prior)))
    known = telling_buckets(pos, unl, s)
    if not len(known):
        return w, bias
    # Only known buckets take part, renumbered.
    number = np.full(BUCKETS, -1)
    number[known] = np.arange(len(known))
    pos, unl = ([number[f][number[f] >= 0] for f in x] for x in (pos, unl))
    rng, theta = np.random.default_rng(seed), np.append(np.zeros(len(known)), bias)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, s.steps + 1):
        p = [pos[i] for i in rng.integers(0, len(pos), min(s.batch, len(pos)))]
        u = [unl[i] for i in rng.integers(0, len(unl), min(s.batch, len(unl)))]
        (rp, cp), (ru, cu) = _rows(p), _rows(u)
        fp = np.bincount(rp, theta[cp], len(p)) + theta[-1]
        fu = np.bincount(ru, theta[cu], len(u)) + theta[-1]
        up, uu = _sigmoid(fp), _sigmoid(fu)
        negative = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        # Slopes of the losses at each document.
        as_pos, p_as_neg, u_as_neg = prior * (up - 1) / len(p), prior * up / len(p), uu / len(u)
        if negative >= 0:
            dp, du = as_pos - p_as_neg, u_as_neg
        else:
            dp, du = p_as_neg, -u_as_neg
        grad = np.bincount(np.r_[cp, cu], np.r_[dp[rp], du[ru]], len(theta)) + s.decay * theta
        grad[-1] = dp.sum() + du.sum()
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
        theta = theta - s.rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    w[known] = theta[:-1]
    return w, float(theta[-1])


def training_rows(docs: DataFrame, labels: DataFrame, s: Settings = DEFAULT) -> DataFrame:
    """``bag, positive, text``: the bounded samples of all bags.

    ``labels(doc_id, toxic)`` confirms toxic documents; every other document is
    unlabelled.  The rows with the smallest hashes of bag and id are taken.
    """
    toxic = labels.filter("toxic = 1").select("doc_id").distinct()
    ids = docs.select("doc_id").distinct()
    wanted = ids.join(toxic, "doc_id", "left_semi").withColumn("positive", F.lit(True)).unionByName(
        ids.join(toxic, "doc_id", "left_anti").withColumn("positive", F.lit(False)))
    parts = []
    for bag in range(s.bags):
        h = F.xxhash64(F.lit(bag), F.col("doc_id").cast("string"))
        for positive, n in ((True, s.positives), (False, s.unlabelled)):
            parts.append(wanted.filter(F.col("positive") == positive)
                         .select("doc_id", "positive", F.lit(bag).alias("bag"), h.alias("h")).orderBy("h", "doc_id").limit(n))
    chosen = parts[0]
    for p in parts[1:]:
        chosen = chosen.unionByName(p)
    # At most bags * (positives + unlabelled) ids.
    return docs.select("doc_id", "text").join(F.broadcast(chosen.drop("h")), "doc_id").select("bag", "positive", "text")


def fit(docs: DataFrame, labels: DataFrame, s: Settings = DEFAULT) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """The classifiers: buckets, their weights, intercept.

    Labels of unknown documents, null ids and null labels are left out.  Without
    toxic documents every score is the prior.
    """
    prior = s.prior
    if prior is None:
        n, toxic = labels.agg(F.count("toxic"), F.sum("toxic")).first()
        prior = float(toxic or 0) / n if n else 0.0
    prior = min(max(prior, 1e-4), 0.5)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, int] = {}
        for b in batches:
            f = [text_features(t.as_py(), cache).astype(np.int32) for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(f, pa.list_(pa.int32()))], ["bag", "positive", "features"])

    def train(rows: pd.DataFrame) -> pd.DataFrame:
        bag = int(rows["bag"].iloc[0])
        # Tasks deliver rows in any order; training needs one.
        keyed = [(bool(p), np.asarray(f, np.int32)) for p, f in zip(rows["positive"], rows["features"])]
        keyed.sort(key=lambda x: (x[0], len(x[1]), x[1].tobytes()))
        w, bias = fit_nnpu([f for p, f in keyed if p], [f for p, f in keyed if not p], prior, s, s.seed + bag)
        at = np.flatnonzero(w)
        return pd.DataFrame({"bag": [bag], "buckets": [at.astype(np.int32)], "weights": [w[at]], "bias": [bias]})

    coded = training_rows(docs, labels, s).mapInArrow(features, "bag int, positive boolean, features array<int>")
    got = coded.groupBy("bag").applyInPandas(train, "bag int, buckets array<int>, weights array<double>, bias double")
    # One row a bag with at most BUCKETS weights.
    models = [(np.array(r.buckets), np.array(r.weights), r.bias) for r in got.orderBy("bag").collect()]
    return models or [(np.empty(0, np.int64), np.empty(0), float(np.log(prior / (1 - prior))))]


def score(docs: DataFrame, models: list[tuple[np.ndarray, np.ndarray, float]]) -> DataFrame:
    """``docs`` with ``score``, 0 to 1, of each whole text; null and empty texts get that of no words.

    Repeated rows are scored alike.  A column named ``score`` is replaced.
    """
    docs = docs.drop("score")
    names, at = [*docs.columns, "score"], docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache: dict[str, int] = {}
        w = np.zeros((len(models), BUCKETS))
        for row, (buckets, weights, _) in zip(w, models):
            row[np.asarray(buckets, np.int64)] = weights
        bias = np.array([b for _, _, b in models])
        for batch in batches:
            logits = [w[:, text_features(t.as_py(), cache)].sum(axis=1) + bias for t in batch.column(at)]
            scores = [float(_sigmoid(x).mean()) for x in logits]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names)
        cache.clear()
        give_back()

    return docs.mapInArrow(run, docs.withColumn("score", F.lit(0.0)).schema)

"""Text classification for the safety gates.

Two models fit on a table of labels: multinomial naive Bayes as plain
aggregations, and logistic regression on hashed word n-grams from Spark ML.
Texts are expected on one line, flattened or normalised.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.fixed import GATE_SCORE
from textloom.operators.lookup import lookup
from textloom.session import BROADCAST_BYTES, BROADCAST_ROWS, HOT_KEYS, materialize

# What the two gates look for; the stand-in for NSFW is a low quality label.
TARGETS = {"nsfw": "quality = 0", "toxic": "toxic = 1"}


def words(text: str) -> Column:
    return F.filter(F.split(F.col(text), " "), lambda w: w != "")


@dataclass
class NaiveBayes:
    """``weights(token, n, w_<target>...)`` and the log prior odds of each target."""

    weights: DataFrame
    priors: dict[str, float]


def nb_counts(docs: DataFrame, labels: DataFrame, targets: Mapping[str, str] = TARGETS,
              text: str = "text", key: str = "doc_id") -> DataFrame:
    """``token, n, pos_<target>...``: occurrences in labelled documents.

    ``targets`` maps a name to the SQL condition on ``labels`` that is positive.
    """
    flags = labels.select(key, *[F.expr(cond).cast("long").alias(f"is_{t}") for t, cond in targets.items()])
    tokens = docs.select(key, text).join(flags, key).select(
        F.explode(words(text)).alias("token"), *[f"is_{t}" for t in targets])
    return tokens.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(f"is_{t}").alias(f"pos_{t}") for t in targets])


def nb_fit(docs: DataFrame, labels: DataFrame, targets: Mapping[str, str] = TARGETS,
           text: str = "text", key: str = "doc_id") -> NaiveBayes:
    """Log likelihood ratio of every token with add-one smoothing."""
    counts = materialize(nb_counts(docs, labels, targets, text, key), "nb-counts")
    total = counts.agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("n"),
                       *[F.sum(f"pos_{t}").alias(f"pos_{t}") for t in targets]).first()
    labelled = labels.join(docs.select(key), key, "left_semi").agg(
        F.count(F.lit(1)).alias("n"), *[F.count_if(F.expr(c)).alias(t) for t, c in targets.items()]).first()
    ratios, priors = [], {}
    for t in targets:
        if not 0 < labelled[t] < labelled.n:
            raise ValueError(f"labels for {t} need documents of both kinds")
        pos, neg = total[f"pos_{t}"] + total.size, total.n - total[f"pos_{t}"] + total.size
        ratio = F.log((F.col(f"pos_{t}") + 1) / F.lit(float(pos))) - F.log(
            (F.col("n") - F.col(f"pos_{t}") + 1) / F.lit(float(neg)))
        ratios.append(ratio.alias(f"w_{t}"))
        odds = labelled[t] / (labelled.n - labelled[t])
        priors[t] = math.log(odds)
    return NaiveBayes(counts.select("token", "n", *ratios), priors)


def _odds_to_columns(odds: Column, target: str) -> dict[str, Column]:
    """Top label and its probability from log odds."""
    p = 1 / (1 + F.exp(-odds))
    return {f"{target}_label": F.when(odds > 0, target).otherwise(f"non-{target}"),
            f"{target}_score": F.round(F.when(odds > 0, p).otherwise(1 - p), 6)}


def nb_odds(docs: DataFrame, model: NaiveBayes, text: str = "text", key: str = "doc_id",
            broadcast_rows: int = BROADCAST_ROWS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """``key, odds_<target>...``, one row for each document.

    Weights of a checked size go to every task and texts are scored where they
    are.  With more of them the most frequent words go, and only the others meet
    their weights in a join.
    """
    scored = _with_odds(docs.select(key, text), model, text, broadcast_rows, hot_keys)
    return scored.select(key, *[F.col("__odds")[f"odds_{t}"].alias(f"odds_{t}") for t in model.priors])


def nb_score(docs: DataFrame, model: NaiveBayes, text: str = "text", key: str = "doc_id",
             broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``key`` and, for every target, ``<target>_label`` and ``<target>_score``."""
    odds = nb_odds(docs, model, text, key, broadcast_rows)
    columns = {}
    for t in model.priors:
        columns |= _odds_to_columns(F.col(f"odds_{t}"), t)
    return odds.select(key, *[c.alias(name) for name, c in columns.items()])


def score_harmful(docs: DataFrame, model: NaiveBayes, text: str = "text", key: str = "doc_id",
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with the labels and scores of both gates.

    Weights of a checked size go to every task and texts are scored where they
    are; with more of them rarer words are joined with their weights (``nb_odds``).
    """
    columns = {}
    for t in model.priors:
        columns |= _odds_to_columns(F.col("__odds")[f"odds_{t}"], t)
    scored = _with_odds(docs, model, text, broadcast_rows)
    return scored.select(*docs.columns, *[c.alias(name) for name, c in columns.items()])


def _with_odds(docs: DataFrame, model: NaiveBayes, text: str, broadcast_rows: int, hot_keys: int = HOT_KEYS) -> DataFrame:
    """``docs`` with ``__odds``, a struct of ``odds_<target>...``.

    What the weights sent leave over is listed for each text, a word once.  These
    words are joined with the other weights, those frequent among them without a
    shuffle; the sums go back to their rows by a number, as keys may repeat.
    """
    least = _least_sent(model, broadcast_rows)
    if least is None:
        return docs.withColumn("__odds", _odds_in_row(model, model.weights, text, False))
    sent = model.weights.filter(F.col("n") >= least)
    rows = materialize(docs.withColumn("__odds", _odds_in_row(model, sent, text, True)).withColumn(
        "__row", F.monotonically_increasing_id()), "partly-scored")
    tokens = rows.select("__row", F.explode(F.arrays_zip(
        F.col("__odds.words").alias("token"), F.col("__odds.times").alias("times"))).alias("w")).select("__row", "w.*")
    # A word's rows in the join are the documents that hold it.
    held = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("docs"))
    names = [f"w_{t}" for t in model.priors]
    weights = materialize(
        model.weights.filter(F.col("n") < least).select("token", *names).join(held, "token"), "met-weights")
    met = lookup(tokens, weights, "token", "docs", broadcast_rows=broadcast_rows, hot_keys=hot_keys)
    sums = materialize(met.groupBy("__row").agg(*[F.sum(F.col(w) * F.col("times")).alias(w) for w in names]), "rarer-words")
    odds = F.struct(*[(F.col(f"__odds.odds_{t}") + F.coalesce(f"w_{t}", F.lit(0.0))).alias(f"odds_{t}") for t in model.priors])
    return rows.join(sums, "__row", "left").select(*docs.columns, odds.alias("__odds"))


def _least_sent(model: NaiveBayes, broadcast_rows: int) -> int | None:
    """The count from which on the weights of words are few enough to send, None if all are.

    Few counts differ: the distinct ones together are at most the labelled words.
    """
    by_count = model.weights.groupBy("n").agg(F.count(F.lit(1)).alias("size"), F.sum(F.octet_length("token")).alias("held"))
    rows, held, least = 0, 0, None
    for n, size, length in sorted(by_count.collect(), reverse=True):
        rows, held = rows + size, held + length
        if rows > broadcast_rows or held > BROADCAST_BYTES:
            return n + 1 if least is None else least
        least = n
    return None


def _odds_in_row(model: NaiveBayes, sent: DataFrame, text: str, listed: bool) -> Column:
    """Arrow function with the weights ``sent`` to all tasks; ``listed`` adds the words without one and how often they occur."""
    targets = list(model.priors)
    rows = sent.select("token", *[f"w_{t}" for t in targets]).toPandas()
    place = sent.sparkSession.sparkContext.broadcast(
        (dict(zip(rows["token"], range(len(rows)))), np.vstack([rows.drop(columns="token").to_numpy(float), np.zeros(len(targets))])))
    priors, unknown = [model.priors[t] for t in targets], len(rows)
    kinds = [f"odds_{t} double" for t in targets] + ["words array<string>", "times array<long>"] * listed

    @F.pandas_udf(", ".join(kinds))
    def odds(docs: pd.Series) -> pd.DataFrame:
        at, weights = place.value
        sums, others = [], []
        for d in docs:
            # Words are split here, so that one text's at a time are held.
            found = (d or "").split(" ")
            if "" in found:
                found = [w for w in found if w]
            places = np.fromiter(map(at.get, found, repeat(unknown)), np.intp, len(found))
            sums.append(weights.take(places, axis=0).sum(axis=0))
            if listed:
                others.append(Counter([found[k] for k in np.flatnonzero(places == unknown).tolist()]))
        out = pd.DataFrame(np.array(sums).reshape(-1, len(targets)) + priors, columns=[f"odds_{t}" for t in targets])
        return out.assign(words=[list(c) for c in others], times=[list(c.values()) for c in others]) if listed else out

    return odds(F.col(text))


def gate_label_only(scored: DataFrame) -> DataFrame:
    """Collecting gate: both labels must be harmless, scores are ignored."""
    return scored.filter((F.col("nsfw_label") == "non-nsfw") & (F.col("toxic_label") == "non-toxic"))


def gate_threshold(scored: DataFrame, score: float = GATE_SCORE) -> DataFrame:
    """Cleaning gate: harmless with a score above, respectively at least, the limit."""
    return gate_label_only(scored).filter((F.col("nsfw_score") > score) & (F.col("toxic_score") >= score))


# --- logistic regression on hashed n-grams ---------------------------------------

def train_text_classifier(docs: DataFrame, labels: DataFrame, target: str, condition: str | None = None,
                          text: str = "text", key: str = "doc_id", features: int = 1 << 16) -> PipelineModel:
    """Unigrams and bigrams, hashed, into a regularised logistic regression.

    Rows are dealt out by a hash of the key and go in key order within it, so
    that sums run over the same rows in the same order every time.  The fit asks
    for its rows several times; their features are written once before.
    """
    flagged = docs.select(key, text).join(
        labels.select(key, F.expr(condition or TARGETS[target]).cast("double").alias("label")), key)
    parts = max(1, labels.count() // 10_000)
    split = RegexTokenizer(inputCol=text, outputCol="words", pattern=r"\s+", toLowercase=False)
    pairs = NGram(n=2, inputCol="words", outputCol="pairs")
    hash_words = HashingTF(inputCol="words", outputCol="word_features", numFeatures=features)
    hash_pairs = HashingTF(inputCol="pairs", outputCol="pair_features", numFeatures=features)
    both = VectorAssembler(inputCols=["word_features", "pair_features"], outputCol="features")
    hashed = PipelineModel([split, pairs, hash_words, hash_pairs, both])
    # The number of features is all that is passed on of their names.
    width = {"ml_attr": {"num_attrs": 2 * features}}
    rows = materialize(hashed.transform(flagged).select(key, "label", F.col("features").alias("features", metadata=width)), "features")
    fit = LogisticRegression(regParam=0.01, maxIter=20)
    return PipelineModel([*hashed.stages, fit.fit(rows.repartition(parts, key).sortWithinPartitions(key))])


def classify(docs: DataFrame, model: PipelineModel, target: str) -> DataFrame:
    """``docs`` with ``<target>_label`` and ``<target>_score``; no shuffle."""
    p = vector_to_array(F.col("probability"))[1]
    scored = model.transform(docs).withColumn("__p", p)
    return scored.select(
        *docs.columns,
        F.when(F.col("__p") > 0.5, target).otherwise(f"non-{target}").alias(f"{target}_label"),
        F.round(F.greatest("__p", 1 - F.col("__p")), 6).alias(f"{target}_score"))

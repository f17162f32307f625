"""A count-based next-token model and the evaluation of token sequences."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom import fixed
from textloom.operators.lookup import lookup
from textloom.session import materialize

# Batches of the running mean that are summed together.
CHUNK = 10_000


@dataclass
class Bigram:
    """``pairs(prev, next, n, p)``, ``totals(prev, total)``, and the vocabulary size."""

    pairs: DataFrame
    totals: DataFrame
    vocab_size: int


def _pairs_of(x: Column, y: Column, ignore: int | None) -> Column:
    """Aligned (prev, next) of two arrays of equal length."""
    both = F.arrays_zip(x.alias("prev"), y.alias("next"))
    return both if ignore is None else F.filter(both, lambda e: e["next"] != ignore)


def fit_bigram(examples: DataFrame, vocab_size: int, ignore: int | None = fixed.PAD_ID) -> Bigram:
    """Counts of (x, y) over the examples, probabilities with add-one smoothing."""
    pairs = examples.select(F.inline(_pairs_of(F.col("x"), F.col("y"), ignore)))
    counts = materialize(pairs.groupBy("prev", "next").agg(F.count(F.lit(1)).alias("n")), "bigrams")
    totals = counts.groupBy("prev").agg(F.sum("n").alias("total"))
    # A token has at most vocab_size successors, so this join is even.
    p = (F.col("n") + 1) / (F.col("total") + F.lit(vocab_size))
    return Bigram(counts.join(totals, "prev").select("prev", "next", "n", p.alias("p")), totals, vocab_size)


def token_nll(examples: DataFrame, model: Bigram, ignore: int = fixed.PAD_ID, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep..., nll, targets``: summed cross-entropy and number of targets of each example.

    Pairs meet the model where they are, when its size allows to broadcast it, and
    only sums are shuffled, one row for an example and task.  Examples whose targets are all ignored have zero targets.
    """
    pairs = _pairs_of(F.col("x"), F.col("y"), ignore)
    seen = examples.select(*keep, F.inline_outer(pairs)).withColumn("times", F.col("next").isNotNull().cast("long"))
    by_pair = model.pairs.select(F.struct("prev", "next").alias("pair"), "n", "p")
    by_prev = model.totals.withColumn("p_unseen", 1 / (F.col("total") + F.lit(model.vocab_size)))
    known = lookup(seen.withColumn("pair", F.struct("prev", "next")), by_pair, "pair", "n", how="left")
    known = lookup(known.drop("n"), by_prev, "prev", "total", how="left")
    p = F.coalesce("p", "p_unseen", F.lit(1.0 / model.vocab_size))
    return known.groupBy(*keep).agg(
        F.sum(F.when(F.col("times") > 0, -F.log(p) * F.col("times")).otherwise(0.0)).alias("nll"),
        F.sum("times").alias("targets"))


def batch_loss(scored: DataFrame, batch: str = "batch", by: tuple[str, ...] = ()) -> DataFrame:
    """``by..., batch, loss``: mean over the targets of a batch.

    A batch without targets has no mean and is left out.
    """
    sums = scored.groupBy(*by, batch).agg(F.sum("nll").alias("nll"), F.sum("targets").alias("targets"))
    return sums.filter(F.col("targets") > 0).select(*by, batch, (F.col("nll") / F.col("targets")).alias("loss"))


def mean_loss(losses: DataFrame) -> DataFrame:
    """Unweighted mean over batches; 0 when there are none."""
    return losses.agg(F.coalesce(F.avg("loss"), F.lit(0.0)).alias("loss"))


def perplexity(losses: DataFrame) -> DataFrame:
    """exp of the mean batch loss; null without batches."""
    return losses.agg(F.avg("loss").alias("loss")).select("loss", F.exp("loss").alias("perplexity"))


def running_loss(losses: DataFrame, batch: str = "batch", by: tuple[str, ...] = (), chunk: int = CHUNK) -> DataFrame:
    """Add ``running``: the mean of a batch's loss and those of all batches before it.

    Sums run inside chunks of batches; a chunk starts from the totals of the
    chunks before it, which are few and are the only thing ordered in one task.
    """
    rows = losses.withColumn("__chunk", F.floor(F.col(batch) / chunk))
    totals = rows.groupBy(*by, "__chunk").agg(F.sum("loss").alias("__s"), F.count(F.lit(1)).alias("__c"))
    earlier = Window.partitionBy(*by).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(*by, "__chunk", F.coalesce(F.sum("__s").over(earlier), F.lit(0.0)).alias("__s0"),
                           F.coalesce(F.sum("__c").over(earlier), F.lit(0)).alias("__c0"))
    inside = Window.partitionBy(*by, "__chunk").orderBy(batch).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({"__s": F.sum("loss").over(inside), "__c": F.count(F.lit(1)).over(inside)})
    running = (F.col("__s") + F.col("__s0")) / (F.col("__c") + F.col("__c0"))
    return summed.join(starts, [*by, "__chunk"]).select(*losses.columns, running.alias("running"))


def next_token_topk(model: Bigram, k: int, temperature: float = 1.0) -> DataFrame:
    """``prev, next, p``: successors among the k best, ties kept, renormalised.

    The score of a successor is the log of its probability.  ``k = 0`` keeps all.
    Successors of one token are at most the vocabulary, so the windows are small.
    """
    score = F.log("p") / max(temperature, fixed.MIN_TEMPERATURE)
    scored = model.pairs.select("prev", "next", score.alias("score"))
    if k > 0:
        best_first = Window.partitionBy("prev").orderBy(F.desc("score"))
        scored = scored.withColumn("r", F.rank().over(best_first)).filter(F.col("r") <= k)
    each = Window.partitionBy("prev")
    shifted = scored.withColumn("e", F.exp(F.col("score") - F.max("score").over(each)))
    return shifted.select("prev", "next", (F.col("e") / F.sum("e").over(each)).alias("p"))


def clip_context(ids: Column, length: int = fixed.CONTEXT_LENGTH) -> Column:
    """The last ``length`` ids."""
    return F.slice(ids, F.greatest(F.size(ids) - length, F.lit(0)) + 1, length)

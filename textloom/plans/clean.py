"""Cleaning a corpus: normalise, gate, judge, mask, remove near duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.fixed import GATE_SCORE
from textloom.functions.pii import mask_text
from textloom.functions.points import normalize_by_table
from textloom.operators.lookup import pick
from textloom.operators.neardup import dedup
from textloom.operators.quality import judge_quality, keep_quality
from textloom.operators.ranking import rank_ordered
from textloom.operators.safety import NaiveBayes, gate_threshold, nb_fit, score_harmful
from textloom.session import materialize, scratch
from textloom.sources.lines import number_lines, parse_labelled, write_lines


def normalized(df: DataFrame, text: str = "text", mask_first: bool = False) -> DataFrame:
    """Normalised text.  Punctuation is gone after it, and with it every e-mail and
    IP address; ``mask_first`` masks them while they still are recognisable."""
    return (mask_text(df, text) if mask_first else df).withColumn(text, normalize_by_table(F.col(text)))


def fit_gates(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id") -> NaiveBayes:
    """Models of both gates, fit on the normalised text of the labelled documents only."""
    return nb_fit(normalized(pick(docs.select(key, text), labels, key), text), labels, text=text, key=key)


def clean_pages(df: DataFrame, model: NaiveBayes, text: str = "text", key: str = "doc_id",
                mask_first: bool = False) -> DataFrame:
    """Documents that pass both gates and the quality rules, normalised and masked.

    The rules are a conjunction, so the cheap ones run first.
    """
    good = keep_quality(normalized(df, text, mask_first), text)
    return mask_text(gate_threshold(score_harmful(good, model, text, key)).select(*good.columns), text)


def judge_pages(df: DataFrame, model: NaiveBayes, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``key, drop_reason``: the first reason to drop a document, null when it stays.

    Reasons come in the order of the steps: NSFW gate, toxicity gate, quality rules.
    """
    scored = judge_quality(score_harmful(normalized(df, text), model, text, key), text)
    nsfw = (F.col("nsfw_label") != "non-nsfw") | (F.col("nsfw_score") <= GATE_SCORE)
    toxic = (F.col("toxic_label") != "non-toxic") | (F.col("toxic_score") < GATE_SCORE)
    return scored.select(key, F.when(nsfw, "nsfw").when(toxic, "toxic").otherwise(F.col("drop_reason")).alias("drop_reason"))


def clean(df: DataFrame, model: NaiveBayes, text: str = "text", key: str = "doc_id",
          scope: list[str] | None = None, mask_first: bool = False) -> DataFrame:
    """``clean_pages`` without near duplicates."""
    cleaned = materialize(clean_pages(df, model, text, key, mask_first), "cleaned")
    return dedup(cleaned, text=text, key=key, scope=scope)


def clean_chunked(df: DataFrame, model: NaiveBayes, chunk_size: int, position: str = "doc_id",
                  text: str = "text", key: str = "doc_id") -> DataFrame:
    """``clean`` with near duplicates looked for only within chunks of ``chunk_size`` positions."""
    chunked = df.withColumn("chunk_id", F.floor(F.col(position) / chunk_size))
    return clean(chunked, model, text, key, scope=["chunk_id"])


def process_corpus(spark: SparkSession, path_in: str, path_out: str, model: NaiveBayes,
                   chunk_size: int | None = None) -> None:
    """Labelled or plain lines in, cleaned lines out, in the order of the input.

    Near duplicates are removed over the whole input unless ``chunk_size`` is given;
    a chunk is then that many non-blank lines.
    """
    with scratch(spark):
        lines = parse_labelled(number_lines(spark, path_in))
        if chunk_size is None:
            cleaned = clean(lines, model)
        else:
            ranked = rank_ordered(lines, "doc_id").withColumn("position", F.col("rank") - 1)
            cleaned = clean_chunked(ranked, model, chunk_size, "position")
        write_lines(cleaned.orderBy("doc_id"), path_out)

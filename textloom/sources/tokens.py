"""Token datasets and tokenizer models on disk."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.operators.bpe import Tokenizer


def write_token_dataset(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One folder for each value of ``split``."""
    df.write.partitionBy("split").mode(mode).parquet(path)


def read_token_dataset(spark: SparkSession, path: str, split: str | None = None) -> DataFrame:
    """``input_ids`` only; other columns and splits are never read."""
    df = spark.read.parquet(path)
    if split is not None:
        df = df.where(F.col("split") == split)
    return df.select("input_ids")


def tokenizer_json(model: Tokenizer) -> str:
    """``vocab`` id to hex bytes, ``merges`` "left|right" to rank, ``special_tokens`` text to id.

    The size of a model is the vocabulary size its caller asked for.
    """
    return json.dumps({
        "vocab": {str(i): token.hex() for i, token in model.tokens.items()},
        "merges": {f"{left.hex()}|{right.hex()}": rank for (left, right), rank in model.merges.items()},
        "special_tokens": model.specials,
    })


def save_tokenizer(model: Tokenizer, path: str, mode: str = "errorifexists") -> None:
    model.spark.createDataFrame([(tokenizer_json(model),)], "value string").coalesce(1).write.mode(mode).text(path)


def load_tokenizer(spark: SparkSession, path: str) -> Tokenizer:
    """Inverse of ``save_tokenizer``; a missing ``special_tokens`` is empty."""
    schema = "vocab map<string,string>, merges map<string,int>, special_tokens map<string,int>"
    row = spark.read.schema(schema).json(path, multiLine=True).first()
    merges = sorted((row.merges or {}).items(), key=lambda kv: kv[1])
    return Tokenizer(
        spark,
        tokens={int(i): bytes.fromhex(h) for i, h in row.vocab.items()},
        merges={tuple(bytes.fromhex(h) for h in pair.split("|")): rank for pair, rank in merges},
        specials=dict(sorted((row.special_tokens or {}).items(), key=lambda kv: kv[1])),
    )

"""Documents to packed training sequences, in stages that each write and reread their table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import packing, pu_toxicity, secret_index, simhash_grid, suffix_blocks
from textloom.llm.queries import TOXIC_AT, held_out
from textloom.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _counted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; rows without text are scored as empty ones."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    scored = pu_toxicity.score(docs.select(*COLUMNS), pu_toxicity.fit(docs, labels))
    return scored.filter(F.col("score") < TOXIC_AT).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each class."""
    return simhash_grid.representatives(docs.select(*COLUMNS))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings that also start earlier."""
    return _counted(suffix_blocks.remove(docs.select(*COLUMNS)))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with secrets masked."""
    return _counted(secret_index.redact(docs.select(*COLUMNS)))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their token ids."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", toxicity),
    ("simhash near-dedup", near_duplicates),
    ("suffix-array dedup", repeated_passages),
    ("secret scans", secrets),
    ("packing", pack),
]

# The scores of trained classifiers can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each works on what its predecessor wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{i + 1}")
    return docs

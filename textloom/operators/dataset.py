"""Token sequences to fixed-length training sets."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom import fixed
from textloom.operators.ranking import kth_shuffled, rank_ordered, rank_shuffled, shuffled_key


def byte_ids(c: Column) -> Column:
    """Ids of the base vocabulary: one token for each UTF-8 byte."""
    # Latin-1 gives every byte a character of the same number.
    chars = F.regexp_extract_all(F.decode(F.encode(c, "UTF-8"), "ISO-8859-1"), F.lit("(?s)."), F.lit(0))
    return F.transform(chars, F.ascii)


def split_sets(df: DataFrame, valid_share: float = fixed.VALID_SHARE, seed: int = 42,
               key: str = "doc_id") -> DataFrame:
    """Add ``split``: the first ceil(share * n) rows in hashed order are ``valid``.

    Only the boundary row is looked for, over the keys; the split itself is a
    projection and moves no rows.
    """
    n_valid = math.ceil(valid_share * df.count())
    if n_valid == 0:
        return df.withColumn("split", F.lit("train"))
    last_hash, last_key = kth_shuffled(df.select(key), key, seed, n_valid)
    h = shuffled_key(key, seed)
    is_valid = (h < last_hash) | ((h == last_hash) & (F.col(key) <= last_key))
    return df.withColumn("split", F.when(is_valid, "valid").otherwise("train"))


def pad_or_truncate(ids: Column, length: int = fixed.CONTEXT_LENGTH, pad: int = fixed.PAD_ID) -> Column:
    """Exactly ``length + 1`` ids."""
    filler = F.array_repeat(F.lit(pad), length + 1)
    return F.slice(F.concat(F.slice(ids, 1, length + 1), filler), 1, length + 1)


def training_examples(df: DataFrame, length: int = fixed.CONTEXT_LENGTH, pad: int = fixed.PAD_ID,
                      ids: str = "input_ids") -> DataFrame:
    """Replace the ids by ``x`` and ``y``, the window and its shift by one."""
    window = "__window"
    return (
        df.withColumn(window, pad_or_truncate(F.col(ids), length, pad))
        .withColumns({"x": F.slice(window, 1, length), "y": F.slice(window, 2, length)})
        .drop(window, ids)
    )


def loss_mask(y: Column, ignore: int = fixed.PAD_ID) -> Column:
    return F.transform(y, lambda t: t != ignore)


def make_batches(df: DataFrame, size: int = fixed.BATCH_SIZE, seed: int | None = None,
                 key: str = "doc_id") -> DataFrame:
    """Add ``batch``: shuffled by ``seed`` when given, otherwise in key order.

    The short last batch stays.
    """
    ranked = rank_ordered(df, key, "__rank") if seed is None else rank_shuffled(df, key, seed, "__rank")
    return ranked.withColumn("batch", F.floor((F.col("__rank") - 1) / size).cast("long")).drop("__rank")


def dataset_summary(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("examples"))

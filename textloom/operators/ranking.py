"""Global row numbers without a global sort in one task."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.session import materialize

HASH_DIGITS = 4
# Rows that a bucket of a ranking is meant for.
BUCKET_ROWS = 1_000_000


def rank_rows(df: DataFrame, order: list[Column], rank: str = "rank", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Number the rows of a narrow table from 1 in the given order.

    The rows are dealt by ranges of the order to as many buckets as they need and
    numbered within them; a bucket's offset is the size of those before it, one row
    for a bucket.  When equal rows may be many, the order must tell them apart, as
    they share a bucket.
    """
    spread = materialize(df, "to-rank")
    buckets = max(1, math.ceil(spread.count() / bucket_rows))
    dealt = materialize(spread.repartitionByRange(buckets, *order).withColumn("__bucket", F.spark_partition_id()), "ranges")
    return _number(dealt, order, rank)


def _number(df: DataFrame, order: list[str | Column], rank: str) -> DataFrame:
    """Rows carry ``__bucket``, ascending with ``order``; number them from 1.

    A bucket's offset is the size of the buckets before it.  The offsets are one
    row for a bucket, so their number is fixed and they may be broadcast.
    """
    sizes = df.groupBy("__bucket").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__bucket", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__bucket").orderBy(*order)
    return (
        df.withColumn(rank, F.row_number().over(inside))
        .join(F.broadcast(offsets), "__bucket")
        .withColumn(rank, (F.col(rank) + F.col("__offset")).cast("long"))
        .drop("__bucket", "__offset")
    )


def shuffled_key(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(f":{seed}")).cast("binary"))


def _ranks(df: DataFrame, key: str, order: list[Column], rank: str, bucket_rows: int, **parts: Column) -> DataFrame:
    """``df`` with the rank of its unique key; only keys are ordered, and joined back."""
    ranked = rank_rows(df.select(key, *[c.alias(n) for n, c in parts.items()]), order, rank, bucket_rows)
    return df.join(ranked.select(key, rank), key)


def rank_shuffled(df: DataFrame, key: str, seed: int, rank: str = "rank", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Number rows from 1 in the order of md5(key:seed), then key; keys are unique."""
    return _ranks(df, key, [F.col("__hash"), F.col(key)], rank, bucket_rows, __hash=shuffled_key(key, seed))


def rank_ordered(df: DataFrame, key: str, rank: str = "rank", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Number rows from 1 in the order of a unique key."""
    return _ranks(df, key, [F.col(key)], rank, bucket_rows)


def nth_key(keys: DataFrame, key: str, n: int, bins: int = 1000, settled: int = 10_000) -> tuple | None:
    """The n-th smallest value of a numeric key, n from 1, and how many keys are smaller; None beyond the end.

    Histograms over ever narrower ranges lead to the value; the driver sees ``bins``
    counts a round, and in the end at most ``settled`` rows or one value.
    """
    low, high, total = keys.agg(F.min(key), F.max(key), F.count(key)).first()
    if n > total:
        return None
    before = 0
    while True:
        inside = keys.filter(F.col(key).between(low, high))
        if low == high:
            return low, before
        width = (high - low) / bins
        if total <= settled or width <= 0 or low + width == low:
            counts = inside.groupBy(key).count().orderBy(key)
            for value, many in counts.collect() if total <= settled else counts.toLocalIterator():
                if before + many >= n:
                    return value, before
                before += many
        place = F.least(F.floor((F.col(key) - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
        sums = inside.groupBy(place.alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
        for r in sorted(sums.collect()):
            if before + r["n"] >= n:
                low, high, total = r["lo"], r["hi"], r["n"]
                break
            before += r["n"]


def kth_shuffled(df: DataFrame, key: str, seed: int, k: int):
    """Hash and key of the k-th row in hashed order, k from 1.

    Counts by leading hash digits, a fixed number of rows, tell the bucket the
    row is in; only that bucket is sorted.
    """
    keyed = df.select(key, shuffled_key(key, seed).alias("__hash")).withColumn(
        "__bucket", F.substring("__hash", 1, HASH_DIGITS))
    seen = 0
    for bucket, n in sorted(keyed.groupBy("__bucket").count().collect()):
        if seen + n >= k:
            row = keyed.filter(F.col("__bucket") == bucket).orderBy("__hash", key).offset(k - seen - 1).first()
            return row["__hash"], row[key]
        seen += n
    raise ValueError(f"fewer than {k} rows")

"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.session import BROADCAST_BYTES, BROADCAST_ROWS, HOT_KEYS


def value_bytes(df: DataFrame) -> Column:
    """About the bytes of a row's values."""
    def size(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind in ("string", "binary"):
            return F.coalesce(F.octet_length(c), F.lit(0))
        if kind.startswith(("array<string", "array<binary", "struct", "map", "array<array", "array<struct")):
            return F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        return F.coalesce(F.size(c), F.lit(0)) * 8 if kind.startswith("array") else F.lit(8)

    total = F.lit(0).cast("long")
    for name, kind in df.dtypes:
        total = total + size(name, kind)
    return total


def lookup(left: DataFrame, table: DataFrame, key: str, weight: str, how: str = "inner",
           broadcast_rows: int = BROADCAST_ROWS, hot_keys: int = HOT_KEYS) -> DataFrame:
    """Join ``left`` to ``table``, which has one row for a key.

    ``weight`` is a column of ``table`` that says how often the key is expected
    in ``left``.  A table of checked small size is broadcast.  A larger one is
    split: keys above 1/hot_keys of the total weight, at most ``hot_keys`` of
    them, are broadcast and never shuffled; the others have few rows each and
    are joined by a shuffle.  The result is the same either way.
    """
    size, total, held = table.agg(F.count(F.lit(1)), F.sum(weight), F.sum(value_bytes(table))).first()
    if size <= broadcast_rows and (held or 0) <= BROADCAST_BYTES:
        return left.join(F.broadcast(table), key, how)
    is_hot = F.coalesce(F.col(weight), F.lit(0)) * hot_keys > F.lit(total)
    hot, cold = table.filter(is_hot), table.filter(~is_hot)
    hot_list = F.broadcast(hot.select(key))
    return (
        left.join(F.broadcast(hot), key, "inner")
        .unionByName(left.join(hot_list, key, "left_anti").join(cold, key, how))
    )


def pick(df: DataFrame, ids: DataFrame, key: str, broadcast_rows: int = BROADCAST_ROWS,
         how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` whose key is in ``ids``.

    A short list of ids, its length checked, is broadcast so that the wide table
    is not shuffled; a long one goes through a shuffle.
    """
    ids = ids.select(key)
    n, held = ids.agg(F.count(F.lit(1)), F.sum(value_bytes(ids))).first()
    if n <= broadcast_rows and (held or 0) <= BROADCAST_BYTES:
        ids = F.broadcast(ids)
    return df.join(ids, key, how)


def leave_out(df: DataFrame, ids: DataFrame, key: str, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Rows of ``df`` whose key is not in ``ids``; otherwise like ``pick``."""
    return pick(df, ids, key, broadcast_rows, "left_anti")


def join_by_count(left: DataFrame, right: DataFrame, key: str, counts: DataFrame,
                  rows_per_task: int = 1_000_000) -> DataFrame:
    """Inner join where ``counts(key, n)`` gives the rows ``left`` has for a key.

    Left rows of a key with more than ``rows_per_task`` rows are dealt out over
    several salts, and the matching right rows are repeated once for each salt.
    ``right`` must hold a bounded number of rows for a key.
    """
    hot = counts.filter(F.col("n") > rows_per_task).select(
        key, F.ceil(F.col("n") / rows_per_task).cast("int").alias("__salts"))
    # Every hot key has more than rows_per_task rows, which bounds their number.
    n_hot = hot.count()
    if n_hot == 0:
        return left.join(right, key)
    spread = F.broadcast(hot) if n_hot <= BROADCAST_ROWS else hot
    salts = F.coalesce(F.col("__salts"), F.lit(1))
    row = F.pmod(F.xxhash64(*left.columns), salts.cast("long")).cast("int")
    dealt = left.join(spread, key, "left").withColumn("__salt", row).drop("__salts")
    copies = (
        right.join(spread, key, "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("__salts")
    )
    return dealt.join(copies, [key, "__salt"]).drop("__salt")

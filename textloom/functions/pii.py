"""Masking of e-mail addresses, phone numbers and IPv4 addresses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom import fixed

# kind -> (pattern, mask, cheap test that a match is possible at all)
_KINDS = {
    "email": (fixed.EMAIL, fixed.EMAIL_MASK, lambda c: F.contains(c, F.lit("@"))),
    "phone": (fixed.PHONE, fixed.PHONE_MASK, lambda c: c.rlike(r"\p{Nd}{4}")),
    "ip": (fixed.IP, fixed.IP_MASK, lambda c: c.rlike(r"\p{Nd}\.\p{Nd}")),
}


def mask(c: Column, kind: str) -> Column:
    pattern, placeholder, possible = _KINDS[kind]
    return F.when(possible(c), F.regexp_replace(c, pattern, placeholder)).otherwise(c)


def count_matches(c: Column, kind: str) -> Column:
    pattern, _, possible = _KINDS[kind]
    return F.when(possible(c), F.regexp_count(c, F.lit(pattern))).otherwise(0)


def mask_column(df: DataFrame, kind: str, text: str = "text", count: str | None = None) -> DataFrame:
    """Replace ``text`` by its masked form and add the number of matches."""
    return df.withColumns({text: mask(F.col(text), kind),
                           count or f"{kind}s": count_matches(F.col(text), kind)})


def mask_pii(df: DataFrame, text: str = "text") -> DataFrame:
    """E-mail, then phone, then IP, each on the result of the one before."""
    for kind in _KINDS:
        df = mask_column(df, kind, text)
    return df


def mask_text(df: DataFrame, text: str = "text") -> DataFrame:
    """``mask_pii`` for callers that do not want the counts."""
    for kind in _KINDS:
        df = df.withColumn(text, mask(F.col(text), kind))
    return df


def pii_report(df: DataFrame, by: str, text: str = "text") -> DataFrame:
    """Matches of each kind and documents touched, for every value of ``by``."""
    counted = mask_pii(df.select(by, text), text).drop(text)
    touched = (F.col("emails") + F.col("phones") + F.col("ips")) > 0
    return counted.groupBy(by).agg(
        F.count(F.lit(1)).alias("docs"),
        F.count(F.when(touched, 1)).alias("docs_with_pii"),
        *[F.sum(k).cast("long").alias(k) for k in ("emails", "phones", "ips")],
    )

"""HTML to plain text as column expressions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from textloom.functions import charsets, html_scan


@F.pandas_udf(StringType())
def html_to_text(pages: pd.Series) -> pd.Series:
    """Text of pages, a line feed for every block tag, references read."""
    return pages.map(html_scan.page_text, na_action="ignore")


@F.pandas_udf(StringType())
def decode_entities(texts: pd.Series) -> pd.Series:
    return texts.map(html_scan.references, na_action="ignore")


def clean_blanks(c: Column) -> Column:
    c = F.regexp_replace(c, r"[ \t\r\f\x0b]+", " ")
    return F.regexp_replace(F.regexp_replace(c, r" ?\n[ \n]*", "\n"), r"\A[ \n]+|[ \n]+\z", "")


def extract_text(df, html: str = "html", text: str = "text"):
    """Add the plain text of ``html`` and drop the page source."""
    return df.withColumn(text, clean_blanks(html_to_text(F.col(html)))).drop(html)


@F.pandas_udf(StringType())
def _by_codec(pages: pd.Series, declared: pd.Series) -> pd.Series:
    return pd.Series([None if p is None else charsets.decode(bytes(p), c) for p, c in zip(pages, declared)], dtype=object)


def decode_html(c: Column) -> Column:
    """Bytes to text by the charset declared before the body, bad bytes replaced.

    A byte-order mark goes before the declaration.  Pages that declare nothing, or
    nothing known, are UTF-8 if their bytes are valid; the others' charset is told from
    their bytes (``charsets.detect``).  Valid UTF-8 that declares nothing else stays in
    the JVM; the Arrow function is handed only the others.
    """
    head = F.split(F.decode(c, "ISO-8859-1"), "(?i)<body\\b", 2)[0]
    meta = r"(?is)<meta\b[^>]*?charset\s*=\s*[\"']?\s*([a-z0-9_:.-]+)"
    declared = F.lower(F.regexp_extract(F.regexp_replace(head, r"(?s)<!--.*?-->", ""), meta, 1))
    marked = F.substring(F.hex(F.substring(c, 1, 3)), 1, 6).rlike("^(EFBBBF|FFFE|FEFF)")
    text = c.cast("string")
    named = declared.isin(*charsets.PAGE_CHARSETS) & ~declared.isin(*[k for k, v in charsets.PAGE_CHARSETS.items() if v == "utf-8"])
    plain = ~marked & ~named & F.is_valid_utf8(text)
    return F.when(plain, text).otherwise(_by_codec(F.when(~plain, c), declared))

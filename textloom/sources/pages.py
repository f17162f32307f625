"""Crawled pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from textloom.functions.html import decode_html
from textloom.operators.lookup import pick
from textloom.session import materialize
from textloom.sources.lines import trim_urls


def fetch_pages(urls: DataFrame, pages: DataFrame) -> DataFrame:
    """The page of each listed URL; a URL without a page counts as a failed fetch.

    Of several captures of a URL the one with the smallest ``page_id`` is taken.
    Reads a table of crawled pages in place of the network.  When the URL list is
    short its length is checked and it is broadcast, so page sources stay put.
    """
    if isinstance(pages.schema["html"].dataType, BinaryType):
        pages = pages.withColumn("html", decode_html(F.col("html")))
    asked = trim_urls(urls)
    # Only urls and ids are grouped; sources are neither sorted nor, for a short list, shuffled.
    ids = pick(pages.select("url", "page_id"), asked, "url").groupBy("url", "page_id").agg(F.count(F.lit(1)).alias("n"))
    first = materialize(ids.groupBy("url").agg(F.min(F.struct("page_id", "n")).alias("x")).select(
        F.struct("url", "x.page_id").alias("__page"), "x.n"), "captures")
    known = pages.withColumn("__page", F.struct("url", "page_id"))
    got = pick(known, first.filter("n = 1"), "__page")
    again = first.filter("n > 1")
    if not again.isEmpty():
        got = got.unionByName(pick(known, again, "__page").dropDuplicates(["__page"]))
    return asked.join(got.drop("__page"), "url")

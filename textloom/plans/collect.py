"""From a URL list and crawled pages to labelled samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.functions import text as T
from textloom.functions.html import extract_text
from textloom.functions.pii import mask_text
from textloom.operators.keep import keep
from textloom.operators.quality import keep_quality
from textloom.operators.ranking import nth_key
from textloom.operators.safety import NaiveBayes, gate_label_only, score_harmful
from textloom.session import materialize
from textloom.sources.lines import labelled, trim_urls
from textloom.sources.pages import fetch_pages


# URLs judged in the first step, for each sample asked for and at least, and how steps grow.
STEP_PER_SAMPLE, FIRST_STEP, STEP_GROWTH = 4, 1000, 4


def top_n(df: DataFrame, n: int, key: str) -> DataFrame:
    """The first n rows by a numeric key; of rows that tie for the last places, any.

    The key of the n-th row is found first (``nth_key``), the rows are then a filter:
    nothing is sorted, and no task holds them all.  ``df`` is read several times.
    Rows without a key are left out.
    """
    found = nth_key(df.select(key), key, n) if n > 0 else (None, 0)
    if found is None:
        return df.filter(F.col(key).isNotNull())
    last, before = found
    tied = df.filter(F.col(key) == last)
    if before + tied.count() > n:
        tied = tied.limit(n - before)
    return df.filter(F.col(key) < last).unionByName(tied)


def page_samples(pages: DataFrame, model: NaiveBayes, key: str = "url_rank") -> DataFrame:
    """Flattened, long enough, well formed, harmless, masked text of pages.

    The text goes with its normalised form until the gate, since the models are
    fit on normalised text.
    """
    flat = extract_text(pages).withColumn("text", T.flatten_lines(F.col("text")))
    good = keep_quality(keep(flat, T.long_enough(F.col("text"))))
    scored = score_harmful(good.withColumn("__normal", T.normalize_text(F.col("text"))), model, "__normal", key)
    return mask_text(gate_label_only(scored).select(*good.columns))


def collect_samples(urls: DataFrame, pages: DataFrame, model: NaiveBayes,
                    max_samples: int | None = None) -> DataFrame:
    """``url_rank, url, text`` of the first ``max_samples`` URLs, by rank, that pass.

    ``text`` is a labelled line.  Use ``write_lines`` to store it.  With a number of
    samples, URLs are judged in growing ranges of their rank until enough have passed.
    """
    def judged(some: DataFrame) -> DataFrame:
        return page_samples(fetch_pages(some, pages), model).select("url_rank", "url", "text")

    if max_samples is None:
        return labelled(judged(urls))
    asked = materialize(trim_urls(urls).select("url_rank", "url"), "urls")
    step, rest, parts, found = max(FIRST_STEP, STEP_PER_SAMPLE * max_samples), asked, [], 0
    while True:
        # The next URLs by rank; later ones are not fetched unless samples are missing.
        last = nth_key(rest.select("url_rank"), "url_rank", step)
        some = rest if last is None else rest.filter(F.col("url_rank") <= last[0])
        parts.append(materialize(judged(some), "samples"))
        found += parts[-1].count()
        if last is None or found >= max_samples:
            break
        rest, step = asked.filter(F.col("url_rank") > last[0]), step * STEP_GROWTH
    samples = parts[0]
    for p in parts[1:]:
        samples = samples.unionByName(p)
    return labelled(top_n(samples, max_samples, "url_rank"))

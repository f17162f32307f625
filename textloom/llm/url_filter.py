"""Operator 13: URL filters by a blocked Bloom filter and an exact hash join, in DataFrame functions only.

A list entry is a host and a path; it fits the URLs of the host and of all its
subdomains whose path starts with that path.  An entry's canonical URL is host
followed by path.  A URL asks for those canonical URLs that could fit it: one for
each ending of its host at a label and each beginning of its path, of the label
counts and path lengths that the list has.  Each question hashes to one block of a
Bloom filter.  Questions whose bits are all set are possible hits; an exact join
with the list removes the false ones, and the longest entry that is left decides.

The blocks are a table of at most ``MAX_BLOCKS`` rows, so they may be broadcast,
and questions are answered where the URLs lie.  A longer list sets more bits a block
and lets more false hits through to the exact join; results are the same.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.lookup import lookup
from textloom.session import materialize

# 64-bit words of a block, bits that a key sets in each, list entries a block is meant for.
WORDS, BITS, ENTRIES = 4, 2, 16
MAX_BLOCKS = 1 << 18
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def canonical(url: Column) -> tuple[Column, Column]:
    """Host and path of a URL, both empty for null and for a URL without ``://``."""
    at = F.coalesce(F.locate("://", url), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    return ascii_lower(host), F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)


def labels_of(host: Column) -> Column:
    return F.size(F.split(host, r"\.", -1))


# --- the filter -----------------------------------------------------------------------


def _bits(key: Column) -> list[Column]:
    """For each word of the block, the bits that a key sets: six bits of its hash choose one."""
    h = F.xxhash64(key)
    words = []
    for w in range(WORDS):
        word = F.lit(0).cast("long")
        for b in range(BITS):
            at = F.shiftright(h, 6 * (BITS * w + b)).bitwiseAND(F.lit(63)).cast("int")
            word = word.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), at))
        words.append(word)
    return words


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(1), key), F.lit(blocks).cast("long"))


def bloom(entries: DataFrame, blocks: int) -> DataFrame:
    """``block, w0, w1, …``: the blocks in which the ``key`` of an entry sets bits."""
    words = [w.alias(f"w{i}") for i, w in enumerate(_bits(F.col("key")))]
    return entries.select(_block(F.col("key"), blocks).alias("block"), *words).groupBy("block").agg(
        *[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def possible(asked: DataFrame, filter_blocks: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``asked`` whose ``key`` may be in the list: no miss, some false hits."""
    meets = F.lit(True)
    for i, word in enumerate(_bits(F.col("key"))):
        meets = meets & (F.col(f"w{i}").bitwiseAND(word) == word)
    # At most MAX_BLOCKS rows of WORDS + 1 longs.
    hit = asked.withColumn("block", _block(F.col("key"), blocks)).join(F.broadcast(filter_blocks), "block").filter(meets)
    return hit.select(*asked.columns)


# --- questions and verdicts -----------------------------------------------------------


def listed(rules: DataFrame) -> DataFrame:
    """``key, rule_host, verdict`` of rules (host, path, verdict): one row for an entry.

    Hosts are lower-cased; entries without a host fit nothing and go; of entries that
    say both, block holds.
    """
    host, path = ascii_lower(F.col("host")), F.coalesce("path", F.lit(""))
    rows = rules.filter("host <> '' AND verdict IS NOT NULL").select(host.alias("rule_host"), path.alias("rule_path"), "verdict")
    return rows.groupBy(F.struct("rule_host", "rule_path").alias("key")).agg(F.max("verdict").alias("verdict"))


def _questions(urls: DataFrame, shapes: list[tuple[int, int]]) -> DataFrame:
    """``host, path, key``: the canonical entries that could fit a URL, by label count and path length."""
    asked = F.array(*[F.struct(F.lit(a).alias("labels"), F.lit(n).alias("chars")) for a, n in shapes])
    fitting = F.filter(asked, lambda s: (s["labels"] <= F.col("__labels")) & (s["chars"] <= F.col("__chars")))
    one = F.explode(fitting).alias("s")
    rows = urls.withColumn("__labels", labels_of(F.col("host"))).withColumn("__chars", F.length("path"))
    ending = F.array_join(F.slice(F.split("host", r"\.", -1), -F.col("s.labels"), F.col("s.labels")), ".")
    return rows.select("host", "path", one).select(
        "host", "path", F.struct(ending.alias("rule_host"), F.substring(F.col("path"), F.lit(1), F.col("s.chars")).alias("rule_path")).alias("key"))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url: str = "url",
          max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """``pages`` with host, path, rule and verdict of each row's URL.

    ``rules`` has host, path and verdict (allow or block).  The longest rule that
    fits decides, measured as host plus path, ties to the longer host.  A URL that no
    rule fits has a null rule and the verdict ``default``; so has a null one, one
    without ``://``, and one whose path is empty where every rule asks for ``/``.
    Repeated rows get repeated results, an empty table or an empty list is fine, and
    columns named host, path, rule or verdict are replaced.
    """
    host, path = canonical(F.col(url))
    out = pages.drop("host", "path", "rule", "verdict").withColumn("host", host).withColumn("path", path)
    entries = materialize(listed(rules), "url-rules")
    shape = entries.groupBy(labels_of(F.col("key.rule_host")).alias("labels"), F.length("key.rule_path").alias("chars")).count()
    # As many rows as the list has label counts and path lengths.
    shapes = sorted((r["labels"], r["chars"], r["count"]) for r in shape.collect())
    none = F.lit(None).cast("string")
    if not shapes:
        return out.withColumn("rule", none).withColumn("verdict", F.lit(default))
    blocks = min(max_blocks, 1 + sum(n for _, _, n in shapes) // ENTRIES)
    asked = _questions(out.select("host", "path"), [(a, n) for a, n, _ in shapes])
    hits = possible(asked, bloom(entries, blocks), blocks)
    # Equal questions of many pages are one row, so a common host is no hot key of the join.
    wanted = hits.groupBy("key").agg(F.count(F.lit(1)).alias("asked"))
    found = materialize(wanted.join(entries, "key"), "url-found")
    size = F.length("key.rule_host") + F.length("key.rule_path")
    best = F.max(F.struct(size.alias("size"), F.length("key.rule_host").alias("n"), F.concat("key.rule_host", "key.rule_path").alias("rule"),
                          "verdict")).alias("best")
    fits = lookup(hits, found, "key", "asked")
    urls = fits.groupBy(F.struct("host", "path").alias("__url")).agg(best, F.count(F.lit(1)).alias("__n"))
    decided = materialize(urls.select("__url", "best.rule", "best.verdict", "__n"), "url-verdicts")
    judged = lookup(out.withColumn("__url", F.struct("host", "path")), decided, "__url", "__n", "left")
    return judged.drop("__url", "__n").withColumn("verdict", F.coalesce("verdict", F.lit(default)))

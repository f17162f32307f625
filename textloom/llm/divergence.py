"""Operator 11: divergence between the sources of a language, by run-length columns.

Each (lang, source) group is a column of counts over the language's vocabulary.
Terms with equal counts in all groups become one row with a length, rows are put in
the order of their counts, and the order is cut into blocks of bounded size.  In a
block every group's column is run-length encoded; for a pair of groups the run
boundaries are intersected, and each piece adds f of its two counts times its
length.  All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textloom.operators.lookup import lookup
from textloom.session import materialize

# A term must be in so many documents of its language.
MIN_DOCS = 10
TOP_TERMS = 10
# Shares are whole numbers of this unit.
UNIT = 1_000_000_000
# Terms a task holds before it passes their counts on.
HELD_TERMS = 300_000
# Counts of one block, by which their number is chosen.
BLOCK_CELLS = 500_000

# Bytes of a term stay, A-Z in lower case; all others become spaces.
_BYTES = bytes(c if c > 127 or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))


def terms(text: bytes) -> list[bytes]:
    return text.translate(_BYTES).split()


def term_counts(docs: DataFrame) -> DataFrame:
    """``lang, term, source, n, docs``: occurrences and documents, one row or more for each group and term.

    A task adds up what it reads until it holds ``HELD_TERMS`` counts, so common
    terms are few rows.
    """
    def passed(n: dict, seen: dict) -> pa.RecordBatch:
        groups = [(g, list(c)) for g, c in n.items()]
        cells = [((g[0], t, g[1]), n[g][t], seen[g][t]) for g, found in groups for t in found]
        keys = [pa.array([k[i] for k, _, _ in cells], pa.binary()).cast(pa.string()) for i in range(3)]
        return pa.RecordBatch.from_arrays(
            [*keys, pa.array([a for _, a, _ in cells], pa.int64()), pa.array([d for _, _, d in cells], pa.int64())],
            ["lang", "term", "source", "n", "docs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen, held = {}, {}, 0
        for b in batches:
            langs, sources, texts = (b.column(c).cast(pa.binary()) for c in ("lang", "source", "text"))
            for lang, source, text in zip(langs.to_pylist(), sources.to_pylist(), texts):
                g = lang, source
                if g not in n:
                    n[g], seen[g] = Counter(), Counter()
                found = terms(text.as_py())
                held -= len(n[g])
                n[g].update(found)
                seen[g].update(set(found))
                held += len(n[g])
                if held > HELD_TERMS:
                    yield passed(n, seen)
                    n, seen, held = {}, {}, 0
        if n:
            yield passed(n, seen)

    return docs.select("lang", "source", "text").mapInArrow(run, "lang string, term string, source string, n long, docs long")


def vocabulary(counts: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``lang, term, total, cells``: the kept terms with their counts, ``cells`` by source."""
    # Both sums are over the same partitioning, so the counts move once.
    each = counts.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    cells = F.array_sort(F.collect_list(F.struct("source", "n"))).alias("cells")
    kept = each.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), cells)
    return kept.filter(F.col("docs") >= min_docs).drop("docs")


def groups(docs: DataFrame, words: DataFrame) -> DataFrame:
    """``lang, source, n, v, lang_n``: sums over the kept terms of every occurring group and of its language."""
    sums = words.select("lang", F.explode("cells").alias("c")).groupBy("lang", "c.source").agg(F.sum("c.n").alias("n"))
    langs = words.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    zero = {"n": 0, "v": 0, "lang_n": 0}
    return docs.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(langs, "lang", "left").fillna(zero)


def share(count: Column, total: Column, v: Column) -> Column:
    """1 + floor(UNIT * (count + 2) / (total + 2 v)), exact for any counts."""
    over = F.lit(UNIT).cast("decimal(10,0)") * (count + 2).cast("decimal(19,0)")
    return 1 + F.call_function("div", over, (total + 2 * v).cast("decimal(19,0)"))


# --- run-length columns ---------------------------------------------------------------


def shares(counts: np.ndarray, total: int, v: int) -> np.ndarray:
    """``share`` of many counts; each distinct one is computed once, in Python's whole numbers."""
    distinct, at = np.unique(counts, return_inverse=True)
    return np.array([1 + UNIT * (int(c) + 2) // (total + 2 * v) for c in distinct], np.int64)[at]


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


def runs(begin: np.ndarray, stop: np.ndarray, n: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and count of the runs of a column of ``size`` places, from its cells in ascending order; zero elsewhere."""
    # Each cell, then the zeros up to the next one, which may be none.
    at = np.r_[0, np.c_[begin, stop].ravel()]
    value = np.r_[0, np.c_[n, np.zeros_like(n)].ravel()]
    real = np.diff(np.r_[at, size]) > 0
    at, value = at[real], value[real]
    first = np.r_[True, value[1:] != value[:-1]] if len(value) else real[:0]
    return at[first], value[first]


def pair_sum(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], size: int) -> int:
    """The sum of f over all places of two columns whose runs carry shares."""
    bounds = np.union1d(a[0], b[0])
    p, q = (shares_[np.searchsorted(at, bounds, "right") - 1] for at, shares_ in (a, b))
    return int((distance(p, q) * np.diff(np.r_[bounds, size])).sum())


def block_pairs(key, rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """The pairs' sums over one block: ``rows`` has begin, stop, source and n, ``known`` the language's groups."""
    columns, size = [], int(rows["stop"].max())
    rows = rows.sort_values("begin")
    cells = dict(list(rows.groupby("source", sort=False)))
    empty = rows.iloc[:0]
    for g in known.sort_values("source").itertuples():
        own = cells.get(g.source, empty)
        at, n = runs(*(own[c].to_numpy(np.int64) for c in ("begin", "stop", "n")), size)
        columns.append((g.source, at, shares(n, g.n, g.v)))
    out = [(key[0], x[0], y[0], pair_sum(x[1:], y[1:], size)) for i, x in enumerate(columns) for y in columns[i + 1:]]
    return pd.DataFrame(out, columns=["lang", "source", "item", "value"])


def pair_sums(words: DataFrame, known: DataFrame, block_cells: int = BLOCK_CELLS) -> DataFrame:
    """``lang, source, item, value`` for the pairs of a language's groups, source before item."""
    alike = materialize(words.groupBy("lang", "cells").agg(F.count(F.lit(1)).alias("length")), "alike-terms")
    n_cells = alike.agg(F.sum(F.size("cells"))).first()[0] or 0
    blocks = 1 + n_cells // block_cells
    ordered = alike.repartitionByRange(blocks, "lang", "cells").sortWithinPartitions("lang", "cells")
    laid = materialize(ordered.withColumn("block", F.spark_partition_id()), "vocabulary-order")
    order = Window.partitionBy("lang", "block").orderBy("cells")
    stop = F.sum("length").over(order)
    cells = laid.withColumn("stop", stop).withColumn("begin", F.col("stop") - F.col("length")).select(
        "lang", "block", "begin", "stop", F.explode("cells").alias("c")).select("lang", "block", "begin", "stop", "c.*")
    of_blocks = laid.select("lang", "block").distinct().join(known.select("lang", "source", "n", "v"), "lang").select(
        F.col("lang").alias("of_lang"), F.col("block").alias("of_block"), "source", "n", "v")
    sums = cells.groupBy("lang", "block").cogroup(of_blocks.groupBy("of_lang", "of_block")).applyInPandas(
        block_pairs, "lang string, source string, item string, value long")
    return sums.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


# --- the audit ------------------------------------------------------------------------


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank`` for ``docs`` (text, lang, source; null: empty).

    Part ``pair``: every other source of the language with the sum of f over its
    kept terms, 0 without any.  Part ``term``: the group's terms whose share is above
    the language's, the ``top`` with the highest f.  Each row is a document, repeated
    rows too; ties go to the smaller item in UTF-8; a group without terms takes part
    in pairs, a single source has none; an empty table gives no rows.  Other columns
    are not looked at.
    """
    filled = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    words = materialize(vocabulary(term_counts(filled), min_docs), "vocabulary")
    known = materialize(groups(filled, words), "groups")
    sums = pair_sums(words, known)
    both = sums.unionByName(sums.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value"))
    # The result has a row for each pair of sources of a language.
    own = known.select("lang", "source")
    pairs = own.join(own.withColumnRenamed("source", "item"), "lang").filter("source <> item").join(
        both, ["lang", "source", "item"], "left").fillna({"value": 0})
    place = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = pairs.withColumn("rank", F.row_number().over(place))

    cells = words.select("lang", "term", "total", F.explode("cells").alias("c")).select(
        F.struct("lang", "c.source").alias("g"), "term", "total", "c.n")
    held = cells.groupBy("g").agg(F.count(F.lit(1)).alias("terms"))
    sizes = known.select(F.struct("lang", "source").alias("g"), F.col("n").alias("group_n"), "v", "lang_n").join(held, "g")
    p, q = share(F.col("n"), F.col("group_n"), F.col("v")), share(F.col("total"), F.col("lang_n"), F.col("v"))
    found = lookup(cells, sizes, "g", "terms").select("g", "term", p.alias("p"), q.alias("q")).filter("p > q")
    value = F.call_function("div", (F.col("p") - F.col("q")) * (F.col("p") - F.col("q")), F.col("p") + F.col("q"))
    telling = found.select("g.lang", "g.source", F.col("term").alias("item"), value.alias("value"))
    # Spark keeps the best of each task before it shuffles them.
    best = telling.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= top)
    columns = ["lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"]
    return ranked.select(*columns).unionByName(best.select(*columns[:2], F.lit("term").alias("part"), *columns[3:]))

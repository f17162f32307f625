"""Operator 3: nearest neighbours by inner product with multiprobe p-stable hashing.

Vectors get one more component that makes their lengths equal, so that the
largest inner product is the smallest Euclidean distance.  A table cuts random
projections into slots of a width; a bucket is a tuple of slots.  A query visits
its own bucket and perturbed ones, most likely first: a perturbation's score is
the sum of squared distances of the query to the slot borders it crosses.  The
candidates of all tables are merged and ranked by the exact inner product.

Equal vectors are one entry with its smallest ids, which is all a query can
return of them.  Buckets are dealt out over tasks in slices of bounded size, and
each slice keeps its best rows for each query, so no task gathers a group.  A
query first visits its own bucket of each table: the score of its k-th best
there is a bound, and the perturbed buckets keep only rows that reach it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.session import materialize


@dataclass(frozen=True)
class Settings:
    tables: int = 6
    functions: int = 6           # projections of a table
    width: float = 0.0           # of a slot in lengths of the longest vector; 0: fitted
    probes: int = 0              # buckets a query visits in a table; 0: fitted
    sample: int = 4000           # vectors the two are fitted on, at most
    sample_queries: int = 100
    recall: float = 0.97         # asked for on the sample
    slice_rows: int = 20_000     # index rows of a bucket in one slice
    group_rows: int = 40_000     # index rows of a task's group, on average
    query_rows: int = 20_000     # queries that meet a group at a time, on average
    seed: int = 11


DEFAULT = Settings()


@dataclass(frozen=True)
class Index:
    """Projections of all tables, their offsets, the slot width, and the scale of the vectors."""

    a: np.ndarray                # tables x functions x (components + 1)
    b: np.ndarray                # tables x functions
    width: float
    probes: int
    longest: float

    def lifted(self, x: np.ndarray, query: bool) -> np.ndarray:
        """Vectors with the added component: candidates all get length one, queries as well."""
        if query:
            norm = np.linalg.norm(x, axis=1, keepdims=True)
            return np.hstack([x / np.where(norm > 0, norm, 1), np.zeros((len(x), 1))])
        x = x / self.longest
        return np.hstack([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1, keepdims=True)))])

    def slots(self, x: np.ndarray, table: int) -> np.ndarray:
        """Projections in slot widths; whole parts are the slots."""
        return x @ self.a[table].T / self.width + self.b[table]


def bucket_keys(slots: np.ndarray) -> np.ndarray:
    """One long for each row of slots."""
    key = np.zeros(slots.shape[:-1], np.uint64)
    for k in range(slots.shape[-1]):
        key = (key ^ slots[..., k].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def perturbations(functions: int) -> np.ndarray:
    """All buckets at most one slot away in every function: steps of -1, 0 or 1, one row a bucket."""
    return np.array(list(product((0, -1, 1), repeat=functions)), np.int64)


def probed(slots: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in the order and key of the ``n`` buckets that each query visits, most likely first."""
    low = np.floor(slots)
    part, steps = slots - low, perturbations(slots.shape[1])
    # Squared distances to the borders crossed, summed over the steps of a perturbation.
    cost = part ** 2 @ (steps == -1).T + (1 - part) ** 2 @ (steps == 1).T
    order = np.argsort(cost, axis=1, kind="stable")[:, :n]
    keys = bucket_keys(low[:, None, :] + steps[order])
    rows, places = np.indices(order.shape)
    return rows.ravel(), places.ravel(), keys.ravel()


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: vectors with an id and finite components, not all zero, as doubles."""
    ok = (F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
          & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
          & F.exists("v", lambda x: x != 0))
    return vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("v")).filter(F.coalesce(ok, F.lit(False)))


def of_one_length(rows: DataFrame) -> DataFrame:
    """The vectors of the most frequent length, of equally frequent ones the shortest."""
    size = F.size("v")
    common = rows.groupBy(size.alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.filter(size == (common["n"] if common else 0))


def fit(entries: DataFrame, k: int, s: Settings) -> Index | None:
    """Width and probes fitted on a bounded sample, so that ``recall`` is met there."""
    some = entries.orderBy(F.xxhash64("v")).limit(s.sample).select("v").collect()
    if not some:
        return None
    longest = entries.agg(F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)))).first()[0]
    x = np.array([r.v for r in some])
    rng = np.random.default_rng(s.seed)
    a = rng.standard_normal((s.tables, s.functions, x.shape[1] + 1))
    b = rng.random((s.tables, s.functions))
    queries = x[:s.sample_queries]
    exact = queries @ x.T
    k = min(k, len(x))
    best = np.argsort(-exact, axis=1, kind="stable")[:, :k]
    widths = [s.width] if s.width else [1.0, 1.5, 2.0, 4.0]
    most = s.probes or 3 ** s.functions
    found = []
    while widths:
        width = widths.pop(0)
        index = Index(a, b, width, most, float(longest))
        own, other = index.lifted(queries, True), index.lifted(x, False)
        # The place in the visiting order at which a query first meets a candidate.
        first = np.full(exact.shape, most)
        for t in range(s.tables):
            u, inverse = np.unique(bucket_keys(np.floor(index.slots(other, t))), return_inverse=True)
            row, place, key = probed(index.slots(own, t), most)
            at = np.minimum(np.searchsorted(u, key), len(u) - 1)
            hit = u[at] == key
            order = np.full((len(own), len(u)), most)
            order[row[hit], at[hit]] = place[hit]
            first = np.minimum(first, order[:, inverse])
        met = np.sort(np.take_along_axis(first, best, 1).ravel())
        needed = int(met[int(np.ceil(s.recall * len(met))) - 1]) + 1
        if s.probes or needed <= most:
            probes = s.probes or needed
            found.append(((first < probes).mean() * len(x) + probes * s.tables, width, probes))
        if not widths and not found:
            # Wide enough, all rows share a bucket.
            widths.append(2 * width)
    # The cheapest that meets the recall.
    _, width, probes = min(found)
    return Index(a, b, width, probes, float(longest))


def search(vectors: DataFrame, is_query, k: int = 20, s: Settings = DEFAULT) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found to each query, its own row left out.

    ``vectors(vec_id, embedding)``; ``is_query`` is a condition on ``vec_id``.
    Vectors that are null, zero or hold null or non-finite components take no part,
    nor do those of another length than most have.  A query has ``k`` rows, or all
    other vectors if they are fewer: one that met too few looks at every bucket.
    Equal scores go to the smaller id; repeated rows of an id count once; an empty
    table gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = materialize(of_one_length(usable(vectors).dropDuplicates(["vec_id"])), "vectors")
    # The smallest k + 1 ids of equal vectors are all that one of them can return; the first names them.
    entries = materialize(smallest_ids(rows, k + 1).withColumn("entry", F.col("ids")[0]), "entries")
    index = fit(entries, k + 1, s)
    schema = "query_id long, rank int, vec_id long, score double"
    if index is None:
        return spark.createDataFrame([], schema)
    asked = materialize(
        rows.filter(is_query).groupBy("v").agg(F.min("vec_id").alias("query")), "queries")
    pairs = _nearest(entries, asked, index, k + 1, s).groupBy("query", "entry").agg(F.max("score").alias("score"))
    # Back to ids: each query of equal vectors leaves itself out.
    listed = pairs.join(entries.select("entry", "ids"), "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    best = _best(listed, k + 1)
    per_query = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "v").join(asked.select("v", "query"), "v")
    top = per_query.select("query_id", "query").join(best, "query")
    return top.select("query_id", F.posexplode(F.slice(F.filter(
        "found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("pos", "x")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


def smallest_ids(rows: DataFrame, k: int) -> DataFrame:
    """``v, ids``: distinct vectors with the ``k`` smallest ids of each, merged in two steps."""
    part = F.pmod(F.xxhash64("vec_id"), F.lit(64))
    first = rows.groupBy("v", part.alias("part")).agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k).alias("ids"))
    return first.groupBy("v").agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, k).alias("ids"))


def _best(listed: DataFrame, k: int) -> DataFrame:
    """``query, found``: the best ``k`` of each query, in order."""
    pair = F.struct((-F.col("score")).alias("minus"), "vec_id")
    part = F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("part")
    first = listed.groupBy("query", part).agg(F.slice(F.array_sort(F.collect_set(pair)), 1, k).alias("x"))
    best = first.groupBy("query").agg(F.slice(F.array_sort(F.flatten(F.collect_list("x"))), 1, k).alias("x"))
    return best.select("query", F.transform("x", lambda p: F.struct(p["vec_id"].alias("vec_id"), (-p["minus"]).alias("score"))).alias("found"))


def _nearest(entries: DataFrame, asked: DataFrame, index: Index, k: int, s: Settings) -> DataFrame:
    """``query, entry, score``: candidates of all tables, the best ``k`` entries of each query and slice.

    Rows below the ``k``-th best score of the query's own buckets are left out.
    """
    n_tables = s.tables

    def to_buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column(1))
            if len(x):
                lifted = index.lifted(x, False)
                keys = [bucket_keys(np.floor(index.slots(lifted, t))) for t in range(n_tables)]
                yield from _spread(batch, np.stack(keys, 1))

    def _spread(batch: pa.RecordBatch, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        for t in range(n_tables):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), t, np.int32)), pa.array(np.ascontiguousarray(keys[:, t])), batch.column(0), batch.column(1)],
                ["tab", "bucket", "entry", "v"])

    def to_probes(own: bool):
        """The queries' own buckets, or the perturbed ones."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 256):
                    part = batch.slice(at, 256)
                    x = index.lifted(_matrix(part.column(1)), True)
                    for t in range(n_tables):
                        row, place, key = probed(index.slots(x, t), 1 if own else index.probes)
                        left = own | (place > 0)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(left.sum(), t, np.int32)), pa.array(key[left]), part.column(0).take(pa.array(row[left]))],
                            ["tab", "bucket", "query"])
        return run

    placed = materialize(entries.select("entry", "v").mapInArrow(
        to_buckets, "tab int, bucket long, entry long, v array<double>"), "buckets")
    sizes = materialize(placed.groupBy("tab", "bucket").agg(F.count(F.lit(1)).alias("n")), "bucket-sizes")
    slices = F.ceil(F.col("n") / s.slice_rows).cast("int")
    groups = int(max(1, (sizes.agg(F.sum("n")).first()[0] or 0) // s.group_rows + 1)) * 4
    key = ["tab", "bucket", "slice"]
    where = F.pmod(F.xxhash64(*key), F.lit(groups)).cast("int").alias("grp")
    cut = sizes.select("tab", "bucket", slices.alias("slices"))
    left = placed.join(cut.filter("slices > 1"), ["tab", "bucket"], "left").withColumn(
        "slice", F.when(F.col("slices") > 1, F.pmod(F.xxhash64("entry"), F.col("slices"))).otherwise(0).cast("int"))

    # A group meets the queries block by block, with its bounded rows repeated for each block.
    blocks = max(1, -(-asked.count() // s.query_rows))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("blk")
    repeated = left.select(where, *key, "entry", "v").withColumn("blk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def met(right: DataFrame) -> DataFrame:
        return repeated.groupBy("grp", "blk").cogroup(right.groupBy("grp", "blk")).applyInPandas(
            lambda a, b: _rank_group(a, b, k), "query long, entry long, score double")

    def visit(own: bool, asking: DataFrame) -> DataFrame:
        probes = asking.select("query", "v").mapInArrow(to_probes(own), "tab int, bucket long, query long")
        # A query goes to a group once, with the list of its buckets there.
        return met(
            probes.join(cut, ["tab", "bucket"]).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
            .select(where, "query", F.struct(*key).alias("key")).groupBy("grp", "query").agg(F.collect_list("key").alias("keys"))
            .join(asking, "query").withColumn("blk", block)
        )

    first = materialize(visit(True, asked.withColumn("bound", F.lit(float("-inf")))), "own-buckets")
    scores = first.groupBy("query", "entry").agg(F.max("score").alias("score")).groupBy("query").agg(
        F.sort_array(F.collect_list("score"), asc=False).alias("x"))
    # A sum may differ in its last digits from one block to another; the bound leaves room for that.
    kth = F.try_element_at("x", F.lit(k))
    bounds = scores.select("query", (kth - F.abs(kth) * 1e-9).alias("bound"))
    bounded = asked.join(bounds, "query", "left").fillna(float("-inf"), ["bound"])
    found = materialize(first.unionByName(visit(False, bounded)), "met")
    # Queries that met fewer entries than they could look at all buckets of one table.
    least = min(k, entries.count())
    counts = found.groupBy("query").agg(F.count_distinct("entry").alias("n"))
    short = materialize(asked.join(counts, "query", "left").filter(F.coalesce("n", F.lit(0)) < least).select("query", "v"), "short")
    if short.isEmpty():
        return found
    none = F.expr("CAST(NULL AS array<struct<tab:int,bucket:bigint,slice:int>>)").alias("keys")
    everywhere = short.select(F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("grp"), "query", none, "v",
                              F.lit(float("-inf")).alias("bound"), block)
    return found.unionByName(met(everywhere))


def _matrix(column: pa.Array) -> np.ndarray:
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1) if n else np.empty((0, 0))


def _top(query: np.ndarray, entry: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The ``k`` best entries of each query, equal scores by entry."""
    order = np.lexsort((entry, -score, query))
    query, entry, score = query[order], entry[order], score[order]
    again = np.r_[False, (query[1:] == query[:-1]) & (entry[1:] == entry[:-1])]
    query, entry, score = query[~again], entry[~again], score[~again]
    begin = np.maximum.accumulate(np.where(np.r_[True, query[1:] != query[:-1]], np.arange(len(query)), 0))
    keep = np.arange(len(query)) - begin < k
    return query[keep], entry[keep], score[keep]


def _rank_group(index_rows: pd.DataFrame, probe_rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Exact inner products within the buckets of a group, the best ``k`` of each query that reach its bound."""
    empty = pd.DataFrame({"query": np.empty(0, np.int64), "entry": np.empty(0, np.int64), "score": np.empty(0)})
    if index_rows.empty or probe_rows.empty:
        return empty
    held = index_rows.groupby(["tab", "bucket", "slice"], sort=False).indices
    entry, vectors = index_rows["entry"].to_numpy(), np.stack(index_rows["v"].to_numpy())
    query, asked = probe_rows["query"].to_numpy(), np.stack(probe_rows["v"].to_numpy())
    bound = probe_rows["bound"].to_numpy()[:, None]
    visits: dict[tuple, list[int]] = {}
    of_first = [key for key in held if key[0] == 0]
    for i, keys in enumerate(probe_rows["keys"]):
        # Without a list a query visits all buckets of the first table.
        for key in of_first if keys is None else ((x["tab"], x["bucket"], x["slice"]) for x in keys):
            visits.setdefault(key, []).append(i)
    out = []
    for key, rows in visits.items():
        if key not in held:
            continue
        x, e = vectors[held[key]], entry[held[key]]
        for at in range(0, len(rows), 128):
            some = np.array(rows[at:at + 128])
            score = asked[some] @ x.T
            least = -np.partition(-score, k - 1, axis=1)[:, k - 1:k] if score.shape[1] > k else np.full((len(some), 1), -np.inf)
            # Sums of a block may differ in their last digits; those that are kept are added up in one order.
            with np.errstate(invalid="ignore"):
                r, c = np.nonzero(score >= np.maximum(least - np.abs(least) * 1e-9, bound[some]))
            for piece in range(0, len(r), 20_000):
                p, q = r[piece:piece + 20_000], c[piece:piece + 20_000]
                out.append(_top(some[p], e[q], (asked[some[p]] * x[q]).sum(axis=1), k))
        if sum(len(q) for q, _, _ in out) > 2_000_000:
            out = [_top(*(np.concatenate(x) for x in zip(*out)), k)]
    if not out:
        return empty
    q, e, score = _top(*(np.concatenate(x) for x in zip(*out)), k)
    return pd.DataFrame({"query": query[q], "entry": e, "score": score})

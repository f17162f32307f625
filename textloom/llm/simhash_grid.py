"""Operator 4: SimHash near-duplicates through a grid over segment popcounts.

A fingerprint is mapped to the bit counts of its segments.  The Manhattan distance
of two such vectors is never above the Hamming distance of the fingerprints, so
a range join on the vectors finds all links.  The grid has unit cells: every
fingerprint enters its own cell and those one step away, and two vectors at a
distance of at most two meet in one of these.  Cells are met by equality of one
long.  Where more than two fingerprints meet, they are entered again with
segments of one bit; whoever shares such a cell differs from it by one bit at
most, so it holds at most 65 fingerprints, all linked.  Thus no cell grows with
the data, no cell lists its pairs, and every candidate is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.operators.components import connected_components
from textloom.operators.lookup import lookup, pick
from textloom.session import materialize

SEED = 42
SHINGLE = 3
BITS = 64


# --- fingerprints ---------------------------------------------------------------------


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The SimHash of all word shingles, repeats included; zero without words."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words]).tolist()
    stops = (ends - 1).tolist()
    k = min(shingle, len(words))
    xxh = xxhash.xxh64_intdigest
    total, n = np.zeros(BITS, np.int64), len(words) - k + 1
    for at in range(0, n, 65536):
        some = zip(starts[at:min(n, at + 65536)], stops[at + k - 1:at + k - 1 + 65536])
        h = np.array([xxh(joined[a:b], SEED) for a, b in some], "<u8")
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp`` of every whole text, the 64 bits as a signed long; repeated rows stay."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fp long")


# --- grid -----------------------------------------------------------------------------


def nibble_counts(fp: Column) -> Column:
    """The bit counts of the 16 segments of four bits, each in its own four bits."""
    ones = F.lit(0x1111111111111111)
    first, *rest = [F.shiftrightunsigned(fp, k).bitwiseAND(ones) for k in range(4)]
    for r in rest:
        first = first + r
    return first


def unit_cells(fp: Column) -> Column:
    """The cell of a fingerprint's segment counts and all cells one step away."""
    own = nibble_counts(fp)
    steps = []
    for i in range(16):
        one = F.shiftleft(F.lit(1).cast("long"), 4 * i)
        up = F.shiftrightunsigned(own, 4 * i).bitwiseAND(F.lit(15).cast("long"))
        steps += [F.when(up < 4, own + one), F.when(up > 0, own - one)]
    return F.array_compact(F.array(own, *steps))


def bit_cells(fp: Column) -> Column:
    """The same for segments of one bit: the fingerprint and those one bit away."""
    ones = [F.shiftleft(F.lit(1).cast("long"), i) for i in range(BITS)]
    return F.array(fp, *[fp.bitwiseXOR(one) for one in ones])


def _differ(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """``a, b``: verified links of distinct fingerprints ``fps(fp)`` that connect all within ``max_bits``.

    Not every link is listed: fingerprints that share a crowded cell are linked
    to the smallest there.  ``max_bits`` is at most two, the reach of two unit steps.
    """
    if not 0 <= max_bits <= 2:
        raise ValueError("two unit cells reach two bits")
    placed = fps.select("fp", F.explode(unit_cells(F.col("fp"))).alias("cell"))
    met = materialize(
        placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        .filter("n > 1"), "grid-cells")
    two = met.filter("n = 2").select("a", "b").distinct()
    crowd = pick(placed, met.filter("n > 2"), "cell").select("fp").distinct()
    near = (
        crowd.select("fp", F.explode(bit_cells(F.col("fp"))).alias("cell"))
        .groupBy("cell").agg(F.collect_list("fp").alias("fps")).filter(F.size("fps") > 1)
    )
    if max_bits == 2:
        star = near.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")
    else:
        # Within a cell only the fingerprint that names it is one bit from the others.
        star = near.select(F.col("cell").alias("a"), F.explode("fps").alias("b")).filter(
            F.array_contains("fps", F.col("a")) & (F.col("a") != F.col("b")))
    return two.unionByName(star).filter(_differ("a", "b") <= max_bits).distinct()


def classes(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = 2) -> DataFrame:
    """``doc_id, fp, component_id``: the smallest document id reachable over links, for every row.

    Null and empty texts have fingerprint zero and link like any other.  Equal
    fingerprints are one node, so copies are grouped before any join.  Repeated
    rows give repeated results.  Rows without doc_id don't take part and are not
    returned; an empty table gives no rows; other columns are ignored.
    """
    docs = docs.filter("doc_id IS NOT NULL")
    fps = materialize(fingerprints(docs, shingle), "fingerprints")
    nodes = materialize(
        fps.groupBy("fp").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n")), "nodes")
    found = materialize(links(nodes.select("fp"), max_bits), "links")
    # A node is named by its smallest document, so that a component's smallest node is the answer.
    ids = nodes.select("fp", "node")
    ends = (
        found.join(ids.select(F.col("fp").alias("a"), F.col("node").alias("i")), "a")
        .join(ids.select(F.col("fp").alias("b"), F.col("node").alias("j")), "b").select("i", "j")
    )
    comp = connected_components(ends)
    labels = materialize(
        nodes.join(comp, "node", "left").select("fp", "n", F.coalesce("component", "node").alias("component_id")), "labels")
    return lookup(fps, labels, "fp", "n").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = 2) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its class; rows without an id stay."""
    out = classes(docs, shingle, max_bits)
    lost = materialize(out.filter("doc_id <> component_id").select(F.col("doc_id")).distinct(), "lost")
    return pick(docs, lost, "doc_id", how="left_anti")

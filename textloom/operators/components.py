"""Connected components of an edge table by alternating star contractions.

The method is the one of Kiveris et al., "Connected Components in MapReduce and
Beyond" (2014): every step replaces edges by edges to the smallest neighbour,
large-star for larger neighbours and small-star for the node and its smaller
ones, until only stars are left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textloom.operators.lookup import join_by_count
from textloom.session import materialize


def _star(edges: DataFrame, rows_per_task: int) -> DataFrame:
    """Point the neighbours of each ``u``, and ``u``, at the smallest of them all.

    The minimum and the count come from one partially aggregated grouping.  A
    node with very many neighbours has its edges dealt out over several tasks
    when the minimum is joined back.
    """
    low = edges.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("n"))
    low = low.withColumn("low", F.least("low", "u"))
    return join_by_count(edges, low.select("u", "low"), "u", low.select("u", "n"), rows_per_task)


def connected_components(edges: DataFrame, a: str = "i", b: str = "j",
                         rows_per_task: int = 1_000_000) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``; the component is its smallest node."""
    # Edges run from the larger to the smaller end.
    edges = materialize(
        edges.filter(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = materialize(
            _star(both, rows_per_task).filter(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("low").alias("v")).distinct(), "large-star")
        tied = _star(large, rows_per_task)
        edges = materialize(
            tied.select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(tied.select("u", F.col("low").alias("v")))
            .filter(F.col("u") != F.col("v")).distinct(), "small-star")
        # Only stars are left when no node has two parents and no parent has one.
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("children")).first()
        if state.n == state.children:
            parents = edges.select(F.col("v").alias("u")).distinct()
            if edges.select("u").join(parents, "u", "left_semi").isEmpty():
                roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
                return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)

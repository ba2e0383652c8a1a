"""Connected components of an edge table by alternating large-star and small-star steps.

Each step joins every node to the smallest node that it knows: the large-star step links all larger
neighbours of a node to its smallest neighbour, the small-star step its smaller ones. Edges end as
stars around the smallest node of each component, after a number of rounds that is logarithmic in
the component's size. The loop ends when a round changes nothing, which is the only way out.

A node's neighbours are never gathered: the smallest is a map-side combined ``min`` and the edges
are joined to it, on a join whose hot keys adaptive execution can split. Every step is written by
``checkpoint()`` to the shared folder, so lineage stays short and lost executors cost one step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    # edges run from the larger node u to the smaller node v
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(low.select("u", F.col("m").alias("v"))).distinct()


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, label) of every node in ``edges``: label is the smallest node of its component."""
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct().checkpoint()
    alone = edges.where(F.col(a) == F.col(b)).select(F.col(a).alias("node")).distinct()
    mark = None
    while True:
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
        e = _small_star(_large_star(e)).checkpoint()
    linked = e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    roots = e.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("label"))
    rest = alone.join(linked, "node", "left_anti").join(roots, "node", "left_anti").select("node", F.col("node").alias("label"))
    return linked.unionAll(roots).unionAll(rest)

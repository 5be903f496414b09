"""Connected components of a graph given as edges between long ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.llm.staging import staged


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.xxhash64("u", "v") % 1_000_003).cast("decimal(38,0)")).alias("h")
    ).first()
    return row.n, row.h


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of an edge (u, v); root is the component's smallest node.

    Alternating large and small star operations (Kiveris et al., "Connected Components in MapReduce
    and Beyond"): every round hangs nodes below smaller neighbours until only stars around the
    smallest node remain, after O(log^2 n) rounds. Minima are combined before the shuffle, each round
    is written to the shared folder, and only its row count and checksum reach the driver.
    Self-loops, repeated edges and an empty graph are allowed.
    """
    edges = staged(edges.select("u", "v").filter("u != v").distinct(), "cc-edges")
    seen = _signature(edges)
    if not seen[0]:
        return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
        down = staged(down, "cc-large")
        lowest = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = staged(
            small.unionByName(lowest.select("u", F.col("m").alias("v"))).filter("u != v").distinct(), "cc-small"
        )
        now = _signature(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )

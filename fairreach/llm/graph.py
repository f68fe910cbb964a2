"""Connected components of an edge table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fairreach.session import checkpoint_root


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of the two-column edge table; root is the component's smallest node.

    Each round hangs every node's larger neighbours, then its smaller ones, below its smallest
    neighbour. The tree depth falls by a constant factor a round, so the rounds grow with the logarithm
    of the longest chain. Smallest neighbours are an aggregate with map-side combine; the joins back have one row a node on
    one side, so a node with very many edges is split by the adaptive skew join. A round ends in
    ``checkpoint()``, so lineage stays short and a lost executor costs one round. Edges with a null end
    and loops are left out; an empty table gives no rows.
    """
    checkpoint_root(edges.sparkSession)
    a, b = (F.col(c) for c in edges.columns[:2])
    links = edges.where(a.isNotNull() & b.isNotNull() & (a != b))
    links = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct().checkpoint()
    seen = None
    while (now := _signature(links)) != seen and now[0]:
        seen = now
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = small.union(lowest.select("u", F.col("m").alias("v"))).where("u <> v").distinct().checkpoint()
    below = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return below.union(links.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _signature(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]

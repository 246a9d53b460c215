"""Connected components of a large graph, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fiscalmill.llm.common import stored


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang neighbours on the smallest one: of larger nodes (large star) or of smaller ones (small star)."""
    if large:
        ends = edges.union(edges.select("v", "u"))
        least = ends.groupBy("u").agg(F.min("v").alias("w")).select(F.col("u").alias("k"), F.least("u", "w").alias("m"))
        moved = ends.where("v > u").join(least, F.col("u") == F.col("k")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("k"), "m")
        hung = edges.join(least, F.col("u") == F.col("k"))
        moved = hung.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select(F.col("k").alias("u"), F.col("m").alias("v")))
    return moved.where("u > v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node of the component, for each node of ``edges`` (u long, v long) but the roots.

    Every round is written to the shared folder, so no lineage grows; a round
    combines map-side and joins on unique keys. It ends when every node hangs on
    a root directly, after about log(longest path) rounds.
    """
    edges = stored(
        edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct(), "edges"
    )
    before = None
    while True:
        after = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if after == before or not after["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before, edges = after, stored(_stars(_stars(edges, True), False), "edges")

"""Connected components of a graph in a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it reaches, for all ends of ``edges`` (u, v).

    Each round gives a node the smallest root among its neighbours and then that root's own
    root. Roots only get smaller, so it ends; chains shorten by half or more in a round. The
    smallest root is taken in each task before the shuffle, so a node with very many edges
    brings one row per task. Every round is stored.
    """
    both = stored(edges.select("u", "v").union(edges.select(F.col("v"), F.col("u"))).filter("u <> v").distinct())
    roots = stored(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("root")))
    while True:
        near = (
            both.join(roots.withColumnsRenamed({"node": "v", "root": "r"}), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("r").alias("near"))
        )
        hooked = roots.join(near, "node").select("node", F.col("root").alias("old"), F.least("root", "near").alias("root"))
        jumps = hooked.select(F.col("node").alias("root"), F.col("root").alias("next"))
        moved = stored(hooked.join(jumps, "root").select("node", "old", F.col("next").alias("root")))
        roots = moved.select("node", "root")
        if moved.filter("root <> old").isEmpty():
            return roots

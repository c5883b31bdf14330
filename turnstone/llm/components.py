"""Connected components of a link table, by alternating star rounds.

Each round only takes minima over neighbours (pre-aggregated) and joins them back, so
no node's neighbours are gathered in one task; links are written to the shared folder
after each round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstone.llm._shared import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """node, root (the component's smallest node) for every node of ``links`` (a, b)."""
    edges = scratch.save(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges-0")
    before, k = None, 0
    while True:
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == before or state["n"] == 0:
            break
        before, k = state, k + 1
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = scratch.save(large.where("a <> b").distinct(), f"large-{k}")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.greatest("b", "m").alias("x"), "m", "a")
        small = small.select(F.col("x").alias("a"), F.col("m").alias("b")).union(least.select("a", F.col("m").alias("b")))
        edges = scratch.save(small.where("a <> b").distinct(), f"edges-{k}")
        scratch.drop(f"large-{k}", f"edges-{k - 1}")
    return edges.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node").union(edges.select("b", "b").distinct())

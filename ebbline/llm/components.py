"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``: the smallest node reachable, itself included.

    Alternates large-star and small-star steps: neighbours are hung under the smallest node known, so a component
    of any diameter becomes one star in a number of rounds that grows with its logarithm. Each step is a grouped
    minimum, combined in each task, and a join whose many-row side adaptive execution splits where one node has
    many links. Every round is written to the shared folder; only two numbers reach the driver. Links with a null
    end, or to itself, join nothing.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, before = written(edges, "edges"), None
    while True:
        both = edges.union(edges.select("v", "u"))
        nearest = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
        large = both.join(nearest, F.col("u") == F.col("x")).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least.select(F.col("u").alias("x"), "m"), F.col("u") == F.col("x"))
        hung = joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = written(hung.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    roots = edges.select(F.col("v").alias("node")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )

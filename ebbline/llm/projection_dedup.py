"""Near-duplicate vectors by counting collisions in many one-dimensional projections."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import ship, written
from ebbline.llm.components import components
from ebbline.llm.verify import Links, compared, links_of, paired_blocks

THRESHOLD = 0.93
PROJECTIONS = 64
#: A pair at the threshold is missed with at most this probability.
MISS = 1e-6
BLOCK_VECTORS = 1_024


def least_collisions(projections: int, miss: float) -> int:
    """The largest count that a pair at the threshold reaches but for ``miss``. Windows are as wide to either side
    as the threshold's distance, so such a pair collides in each Gaussian projection with the probability that a
    normal value lies within one deviation; nearer pairs collide more often."""
    p, below = math.erf(1 / math.sqrt(2)), 0.0
    for count in range(projections + 1):
        below += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if below > miss:
            return count
    return projections


@lru_cache
def directions(dimensions: int, projections: int) -> np.ndarray:
    return np.random.default_rng(20_240_601).standard_normal((dimensions, projections))


def collisions(queries: np.ndarray, targets: np.ndarray, width: float) -> np.ndarray:
    """For each query and target, in how many projections the target lies in the query's window.

    Each projection of the targets is sorted; a query's window is then a range of ranks."""
    counts = np.zeros((len(queries), len(targets)), np.uint8)
    for k in range(queries.shape[1]):
        order = np.argsort(targets[:, k], kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        line = targets[order, k]
        low = np.searchsorted(line, queries[:, k] - width, "left").astype(np.uint32)
        high = np.searchsorted(line, queries[:, k] + width, "right").astype(np.uint32)
        counts += (rank[None, :] - low[:, None]) < (high - low)[:, None]  # unsigned: below low wraps around
    return counts


def block_cosines(
    side: np.ndarray, node: np.ndarray, weight: np.ndarray, values: list, threshold: float, projections: int, least: int
) -> Links:
    """Links of cosine ``threshold`` or more in a pair of blocks, among pairs with ``least`` collisions."""
    vectors = np.array(values, np.float64)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    projected = (vectors / norms[:, None]) @ directions(vectors.shape[1], projections)
    rows = np.flatnonzero(side == 0)
    columns = rows if (side == 0).all() else np.flatnonzero(side == 1)
    width = math.sqrt(2 - 2 * threshold) * (1 + 1e-9)
    at_row, at_column = np.nonzero(collisions(projected[rows], projected[columns], width) >= least)
    linked = np.zeros((len(rows), len(columns)), bool)
    for k in range(0, len(at_row), 65_536):
        a, b = rows[at_row[k : k + 65_536]], columns[at_column[k : k + 65_536]]
        cosine = (vectors[a] * vectors[b]).sum(axis=1) / (norms[a] * norms[b])
        linked[at_row[k : k + 65_536], at_column[k : k + 65_536]] = (cosine >= threshold) & (a != b)
    return links_of(linked, rows, columns, node, weight)


def near_vectors(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    projections: int = PROJECTIONS,
    miss: float = MISS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """``(id, n_links, component_id, kept)`` for every row: how many other rows of its label reach ``threshold`` in
    cosine, and the smallest id that such links lead to.

    Copies under one label go on as one node with their number as weight. A label's vectors are cut by their value
    along one unit direction into cells that only neighbours can match across, and by a hash into blocks of bounded
    size. For a pair of blocks the projections of one are sorted and each vector of the other opens a window in each;
    pairs that meet in as many windows as the threshold's distance calls for are verified in double precision. A
    group returns counts and enough links to stay connected, not its pairs.

    Vectors that are null, zero, or hold null or non-finite components, and rows with a null label or id link with
    nothing; vectors of different length never link. Repeated rows are copies.
    """
    ship(vectors.sparkSession)
    least = least_collisions(projections, miss)
    v = F.col("vector")
    rows = vectors.select(
        vectors[id_column].alias("id"), vectors[label_column].alias("label"), vectors[vector_column].cast("array<double>").alias("vector")
    )
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    usable = rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & v.isNotNull() & (F.size("vector") > 0) & finite)
    largest = F.array_max(F.transform(v, lambda x: F.abs(x)))  # so that squares neither overflow nor vanish
    usable = usable.withColumn("vector", F.transform(v, lambda x: x / largest))
    usable = usable.withColumn("hash", F.xxhash64("vector"))
    usable = written(usable, "vectors")
    nodes = usable.groupBy("label", "hash", "vector").agg(F.min("id").alias("node"), F.count("*").alias("weight"))
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda total, x: total + x * x))
    along = F.aggregate(v, F.lit(0.0), lambda total, x: total + x) / F.sqrt(F.size("vector").cast("double"))
    cell = F.floor(along / norm / (math.sqrt(2 - 2 * threshold) * (1 + 1e-9))).cast("int")
    nodes = nodes.withColumn("size", cell).withColumn("component", F.xxhash64("label", F.size("vector")))
    nodes = written(nodes, "vector-nodes")
    def compare(side, node, weight, values):
        return block_cosines(side, node, weight, values, threshold, projections, least)

    found = written(compared(paired_blocks(nodes, F.lit(1), BLOCK_VECTORS), "vector", compare), "links")
    counts = found.where("not link").groupBy(F.col("node").alias("n")).agg(F.sum("n").alias("links"))
    parts = components(found.where("link").select(F.col("node").alias("a"), F.col("other").alias("b")))
    named = nodes.select("label", "hash", "vector", "node", "weight")
    named = named.join(counts, F.col("node") == F.col("n"), "left").join(
        parts.withColumnRenamed("node", "m").withColumnRenamed("component", "part"), F.col("node") == F.col("m"), "left"
    )
    named = named.select(
        F.col("label").alias("of_label"), F.col("hash").alias("of_hash"), F.col("vector").alias("of_vector"),
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("part", "node").alias("component_id"),
    )
    same = (F.col("label") == F.col("of_label")) & (F.col("hash") == F.col("of_hash")) & (F.col("vector") == F.col("of_vector"))
    linked = usable.select("id", "label", "hash", "vector").join(named, same).select("id", "n_links", "component_id")
    linked = linked.groupBy(F.col("id").alias("of_id")).agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = rows.select("id").join(linked, F.col("id") == F.col("of_id"), "left")
    component = F.coalesce("component_id", "id")
    return out.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )

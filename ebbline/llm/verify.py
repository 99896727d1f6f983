"""From candidate keys to verified links of shingle sets, without a pair ever becoming a row."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import ship, written
from ebbline.llm.components import components

#: Shingles that one side of a compared pair of blocks holds, about, and how many a row counts for besides its own:
#: blocks of short sets are bounded by their rows, whose pairs are one matrix.
BLOCK_SHINGLES = 500_000
ROW_SHINGLES = 400
#: A pair of blocks, and what its comparison gives.
GROUP = ("component", "s1", "b1", "s2", "b2")
LINKS = "node long, n long, other long, link boolean"


def candidate_components(keys: DataFrame) -> DataFrame:
    """``(node, component)`` of nodes that share a key with another node, directly or through others.

    ``keys(key, node)``: each group is hung under its smallest node, so a key with many nodes gives as many links
    and no pair. Keys with one node give none.
    """
    least = keys.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
    least = least.select(F.col("key").alias("of_key"), "a")
    links = keys.join(least, F.col("key") == F.col("of_key")).where("node <> a").select("a", F.col("node").alias("b"))
    return components(links)


Links = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def links_of(linked: np.ndarray, rows: np.ndarray, columns: np.ndarray, node: np.ndarray, weight: np.ndarray) -> Links:
    """``(node, n, other, link)`` of one group: per linked node the weight of its partners (``link`` false), and links
    that keep the linked connected.

    ``linked`` holds rows against columns, both indices into ``node``; equal ``rows`` and ``columns`` mean one block.
    """
    if not linked.any():
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(bool)
    inside = rows is columns
    partners = linked @ weight[columns]
    counted = node[rows] if inside else np.concatenate([node[rows], node[columns]])
    n = partners if inside else np.concatenate([partners, linked.T @ weight[rows]])
    counted, n = counted[n > 0], n[n > 0]
    # Each round hangs every row under its smallest linked label; rows and columns share labels until none changes.
    label_r, label_c, most = rows.astype(np.int32), columns.astype(np.int32), np.int32(len(node))
    while True:
        new_c = np.minimum(label_c, np.where(linked, label_r[:, None], most).min(axis=0))
        if inside:
            label_r = np.minimum(label_r, new_c)
        new_r = np.minimum(label_r, np.where(linked, new_c[None, :], most).min(axis=1))
        if inside:
            new_c = new_r
        if (new_r == label_r).all() and (new_c == label_c).all():
            break
        label_r, label_c = new_r, new_c
    labels, members = (label_r, rows) if inside else (np.concatenate([label_r, label_c]), np.concatenate([rows, columns]))
    hung = labels != members
    ends, roots = node[members[hung]], node[labels[hung]]
    zero = np.zeros(len(ends), np.int64)
    return (
        np.concatenate([counted, ends]),
        np.concatenate([n, zero]),
        np.concatenate([np.zeros(len(counted), np.int64), roots]),
        np.repeat([False, True], [len(counted), len(ends)]),
    )


def block_links(side: np.ndarray, node: np.ndarray, weight: np.ndarray, shingles: list[bytes], threshold: float) -> Links:
    """Links of similarity ``threshold`` or more between the two sides of a pair of blocks, or inside one block, as
    ``links_of`` gives them; ``shingles`` holds a sorted set for each node."""
    sets = [np.frombuffer(x, np.uint64) for x in shingles]
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    shared = np.zeros(len(flat), bool)
    if len(flat) > 1:
        same = flat[1:] == flat[:-1]
        shared[1:] |= same
        shared[:-1] |= same
    flat, owner = flat[shared], owner[shared]
    column = np.cumsum(np.diff(flat, prepend=flat[:1]) != 0) if len(flat) else np.zeros(0, np.int64)
    inside = (side == 0).all()
    rows = np.flatnonzero(side == 0)
    columns = rows if inside else np.flatnonzero(side == 1)
    common = np.zeros((len(rows), len(columns)), np.float32)
    place = np.zeros(len(sets), np.int64)
    place[rows] = np.arange(len(rows))
    if not inside:
        place[columns] = np.arange(len(columns))
    left, right = side[owner] == 0, side[owner] == (0 if inside else 1)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):  # by slices of shared shingles
        a, b = np.searchsorted(column, [low, low + 4096])
        dense = [np.zeros((len(x), 4096), np.float32) for x in (rows, columns)]
        for matrix, mask in zip(dense, (left, right), strict=True):
            at = np.flatnonzero(mask[a:b]) + a
            matrix[place[owner[at]], column[at] - low] = 1
        common += dense[0] @ dense[1].T
    union = sizes[rows][:, None] + sizes[columns][None, :] - common
    linked = common >= np.ceil(threshold * union - 1e-6)
    if inside:
        np.fill_diagonal(linked, False)
    return links_of(linked, rows, columns, node, weight)


def compared(placed: DataFrame, payload: str, compare: Callable[..., Links]) -> DataFrame:
    """``LINKS`` rows of ``compare(side, node, weight, payload)`` for each ``GROUP`` of ``placed``.

    Groups lie side by side in their partitions and are read one behind the other, so a task holds one group at a
    time and many small groups cost little more than their rows. A group of bounded blocks is never split.
    """
    names = ["node", "n", "other", "link"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def result(found: list[Links]) -> pa.RecordBatch:
            columns = (np.concatenate(c) for c in zip(*found, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

        def links(parts: list[tuple], one: bool) -> Links | None:
            side, node, weight = (np.concatenate([p[k] for p in parts]) for k in range(3))
            if len(side) < 2 or not one and side.min() == side.max():
                return None
            return compare(side, node, weight, [x for p in parts for x in p[3]])

        held, key = [], None
        for batch in batches:
            keys = np.stack([c.to_numpy() for c in batch.columns[: len(GROUP)]], axis=1)
            side, node, weight = (c.to_numpy(zero_copy_only=False) for c in batch.columns[len(GROUP) : len(GROUP) + 3])
            values = batch.column(len(GROUP) + 3).to_pylist()
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            found = []
            for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(keys)], strict=True):
                own = tuple(keys[low].tolist())
                if own != key and held:
                    found.append(links(held, key[1:3] == key[3:5]))
                    held = []
                key = own
                held.append((side[low:high].astype(np.int64), node[low:high], weight[low:high], values[low:high]))
            found = [x for x in found if x is not None]
            if found:
                yield result(found)
        if held and (last := links(held, key[1:3] == key[3:5])) is not None:
            yield result([last])

    rows = placed.select(*GROUP, "side", "node", "weight", payload)
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(run, LINKS)


def paired_blocks(members: DataFrame, amount: Column, per_block: int) -> DataFrame:
    """``members`` once for each pair of blocks they take part in: ``GROUP`` names the pair, ``side`` 0 or 1 the block.

    Rows of a ``component`` can only match those whose ``size`` differs by one at most. A size class is cut by a
    hash of the node into blocks that hold about ``per_block`` of ``amount`` each.
    """
    blocks = members.groupBy("component", "size").agg(F.sum(amount).alias("all"))
    blocks = blocks.select("component", F.struct("size", F.ceil(F.col("all") / per_block).alias("n")).alias("of"))
    blocks = blocks.groupBy(F.col("component").alias("c")).agg(F.map_from_entries(F.collect_list("of")).alias("blocks_of"))
    placed = members.join(blocks, F.col("component") == F.col("c"))
    own, size = F.col("block"), F.col("size")

    def count(size):
        return F.coalesce(F.try_element_at("blocks_of", size), F.lit(0)).cast("int")

    def many(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def pair(side, s1, b1, s2, b2):
        return F.struct(F.lit(side).alias("side"), s1.alias("s1"), b1.alias("b1"), s2.alias("s2"), b2.alias("b2"))

    placed = placed.withColumn("block", F.pmod(F.xxhash64("node"), F.greatest(count(size), F.lit(1))).cast("int"))
    groups = F.concat(
        F.transform(
            many(count(size)),
            lambda j: F.when(j >= own, pair(0, size, own, size, j)).otherwise(pair(1, size, j, size, own)),
        ),
        F.transform(many(count(size + 1)), lambda j: pair(0, size, own, size + 1, j)),
        F.transform(many(count(size - 1)), lambda j: pair(1, size - 1, j, size, own)),
    )
    return placed.withColumn("group", F.explode(groups)).select(*members.columns, "group.*")


def verified_links(
    members: DataFrame, threshold: float, payload: str = "shingles", sets_of: Callable[[list], list[bytes]] = list
) -> tuple[DataFrame, DataFrame]:
    """``(node, n_links)`` and ``(a, b)``: how many rows each node is linked with, and links that keep the linked
    connected, for all pairs of nodes in one candidate component with Jaccard similarity ``threshold`` or more.

    ``members(node, component, weight, n_shingles, shingles)`` has one row per distinct set; a ``payload`` other than the
    sets themselves is what ``sets_of`` takes them from in the task that compares them. A component is cut by
    set size into classes of which only neighbours can reach the threshold, a class by a hash of the node into
    blocks of bounded size; each pair of blocks is one group of at most two blocks, so no group grows with the
    component. What a group returns grows with its nodes, not with their pairs.
    """
    ship(members.sparkSession)
    members = written(
        members.withColumn("size", F.floor(F.log("n_shingles") / -math.log(threshold)).cast("int")), "candidates"
    )
    placed = paired_blocks(members, F.col("n_shingles") + ROW_SHINGLES, BLOCK_SHINGLES)
    found = compared(placed, payload, lambda side, node, weight, held: block_links(side, node, weight, sets_of(held), threshold))
    found = written(found, "links")
    counts = found.where("not link").groupBy("node").agg(F.sum("n").alias("n_links"))
    return counts, found.where("link").select(F.col("node").alias("a"), F.col("other").alias("b"))


def batches_of(texts: list[str], chars: int = 500_000) -> Iterator[slice]:
    """Slices of ``texts`` with about ``chars`` characters each."""
    start, size = 0, 0
    for stop, text in enumerate(texts, 1):
        size += len(text)
        if size >= chars or stop == len(texts):
            yield slice(start, stop)
            start, size = stop, 0

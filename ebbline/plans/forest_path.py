"""Many classifying trees grown together, for tables whose single fits would take a Spark job for each level of each forest.

Rows lie in blocks of binned features. Where a tree has at most ``NODE_ROWS`` rows, those it drew go to one task, which
grows it whole; larger nodes are split by counts that tasks add up per feature and bin, until their parts are that small.
So some trees of any forests take one job, and one more per level of large nodes. What a tree draws follows from the seed,
its number and the place of a row or node, so the first trees of a forest are the smaller forest, and a tree cut at a
level is the tree of that depth: the points of a grid that differ in trees and depth alone are scored on the same trees.

Splits are those of Spark's trees for two classes: ``maxBins`` bins, thresholds by Spark's rule from at most
``boosted_path.SPLIT_ROWS`` rows, the first of equal gains, sibling leaves of one class joined. Draws of rows and features
have Spark's distributions, but not its random numbers.
"""

import heapq
import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.plans.boosted_path import BLOCK_ROWS, PARTITION_ROWS, thresholds_of_rows
from ebbline.plans.logistic_path import NOBODY
from ebbline.sources.scratch import materialize, scratch_path
from ebbline.sources.workers import ship_code

#: Rows from which forests are grown here. Single fits of fewer rows take Spark's own trees.
LEAST_ROWS = 10_000
#: Rows of a node that one task grows, and rows of all trees that are grown at once, which bound what the driver holds.
NODE_ROWS = 1 << 19
ROWS_AT_ONCE = 1 << 23
TREES_AT_ONCE = 240
_CELLS = 1 << 20  # counts held at once while a task grows nodes
_CHUNK = 1 << 15  # rows counted at once
_EPSILON = 2.0**-52


@dataclass(frozen=True)
class Forest:
    """``trees`` trees of at most ``depth`` levels of splits on the rows that are not in the fold ``held_out``."""

    trees: int = 20
    depth: int = 5
    least_rows: int = 1
    impurity: str = "gini"
    every_feature: bool = False
    bootstrap: bool = True
    seed: int = 42
    bins: int = 32
    held_out: int = NOBODY


@dataclass(frozen=True)
class Tree:
    """Nodes in arrays, the root first: feature (-1 in a leaf), last bin that goes left, left child (the right one is the
    next), share of label 1, level, gain, rows."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    value: np.ndarray
    level: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    def columns(self) -> list[np.ndarray]:
        return [getattr(self, name) for name in self.__dataclass_fields__]

    def cut(self, depth: int) -> "Tree":
        """The tree of that depth, with sibling leaves of one class joined from the ground up."""
        leaf = (self.feature < 0) | (self.level >= depth)
        one = self.value > 0.5
        for level in range(min(depth, int(self.level.max()) + 1) - 1, -1, -1):
            at = np.flatnonzero((self.level == level) & ~leaf)
            a = self.left[at]
            leaf[at[leaf[a] & leaf[a + 1] & (one[a] == one[a + 1])]] = True
        return replace(self, feature=np.where(leaf, -1, self.feature))

    def nodes_of(self, bins: np.ndarray) -> np.ndarray:
        """The node each row of ``bins`` ends in."""
        node = np.zeros(len(bins), np.int64)
        rows = np.flatnonzero(self.feature[node] >= 0)
        while len(rows):
            at = node[rows]
            node[rows] = self.left[at] + (bins[rows, self.feature[at]] > self.split[at])
            rows = rows[self.feature[node[rows]] >= 0]
        return node

    def importance(self, width: int) -> np.ndarray:
        inner = self.feature >= 0
        total = np.bincount(self.feature[inner], self.gain[inner] * self.rows[inner], width)
        return total / total.sum() if total.sum() > 0 else total


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64 bits of 64 bits."""
    x = (x + np.uint64(0x9E3779B97F4A7C15)).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _root(forest: Forest, tree: int) -> int:
    """The place of a tree's root, from which those of its nodes follow."""
    return int(_mixed(_mixed(np.array([forest.seed & (2**64 - 1)], np.uint64)) + np.uint64(tree))[0])


def _children(places: np.ndarray) -> np.ndarray:
    """``[node, side]``"""
    return _mixed(places[:, None] * np.uint64(2) + np.arange(2, dtype=np.uint64))


def _features(places: np.ndarray, width: int, forest: Forest) -> np.ndarray:
    """Features each node chooses from, ascending: all, or as many as the root of their number, rounded up."""
    size = width if forest.every_feature else int(np.ceil(np.sqrt(width)))
    if size >= width:
        return np.broadcast_to(np.arange(width), (len(places), width))
    drawn = _mixed(places[:, None] ^ _mixed(np.arange(width, dtype=np.uint64)))
    return np.sort(np.argpartition(drawn, size - 1, axis=1)[:, :size], axis=1)


def counted(bins: np.ndarray, rows: np.ndarray, ones: np.ndarray, slot: np.ndarray, features: np.ndarray, size: int) -> np.ndarray:
    """``[(rows, ones), slot, feature, bin]``: how often rows were drawn, and those of label 1."""
    slots, many = features.shape
    cells = np.zeros((2, slots * many * size))
    for low in range(0, len(slot), _CHUNK):
        own = slot[low : low + _CHUNK]
        place = np.take_along_axis(bins[low : low + _CHUNK], features[own], axis=1) + (own[:, None] * many + np.arange(many)) * size
        for sums, weights in zip(cells, (rows, ones), strict=True):
            sums += np.bincount(place.ravel(), np.repeat(weights[low : low + _CHUNK], many), len(sums))
    return cells.reshape(2, slots, many, size)


def impurity_of(kind: str, rows: np.ndarray, ones: np.ndarray) -> np.ndarray:
    safe = np.where(rows > 0, rows, 1)
    none, one = (rows - ones) / safe, ones / safe
    if kind == "gini":
        return np.where(rows > 0, 1 - none * none - one * one, 0.0)
    entropy = 0.0
    for share in (none, one):
        entropy = entropy - share * np.log(np.where(share > 0, share, 1)) / np.log(2)
    return entropy


def best_splits(cells: np.ndarray, features: np.ndarray, forest: Forest) -> tuple[np.ndarray, ...]:
    """Per node ``(feature, bin, gain, rows, ones)`` of the best split, the last two ``[node, side]``; no gain, no split."""
    left = np.cumsum(cells, axis=3)
    total = left[:, :, :1, -1:]
    left = left[..., :-1]
    right = total - left
    sides = [s[0] / total[0] * impurity_of(forest.impurity, *s) for s in (left, right)]
    gain = impurity_of(forest.impurity, *total) - sides[0] - sides[1]
    allowed = (left[0] >= max(forest.least_rows, 1)) & (right[0] >= max(forest.least_rows, 1))
    gain = np.where(allowed, gain, -np.inf).reshape(len(gain), -1)
    at, node = np.argmax(gain, axis=1), np.arange(len(gain))
    place, split = np.divmod(at, cells.shape[3] - 1)
    rows, ones = (np.stack([s[k][node, place, split] for s in (left, right)], axis=1) for k in range(2))
    return features[node, place], split, np.maximum(gain[node, at], 0), rows, ones


class _Growing:
    """Nodes of a tree while it grows; children are added in pairs."""

    def __init__(self, rows: float, ones: float, level: int):
        self.parts = [self._leaves(np.array([rows]), np.array([ones]), level)]
        self.size = 1

    @staticmethod
    def _leaves(rows: np.ndarray, ones: np.ndarray, level: int) -> list[np.ndarray]:
        n, value = len(rows), ones / np.where(rows > 0, rows, 1)
        kinds = (np.int32, np.int32, np.int32)
        return [np.full(n, -1, np.int32), *(np.zeros(n, k) for k in kinds[1:]), value, np.full(n, level, np.int16), np.zeros(n), rows]

    def tree(self) -> Tree:
        return Tree(*(np.concatenate(column) for column in zip(*self.parts, strict=True)))


def grown(bins: np.ndarray, rows: np.ndarray, label: np.ndarray, place: int, level: int, forest: Forest) -> Tree:
    """The tree below a node, from its rows ``[row, feature]`` and how often each was drawn."""
    rows = rows.astype(np.float64)
    ones = rows * label
    width = bins.shape[1]
    growing = _Growing(rows.sum(), ones.sum(), level)
    places, slot = np.array([place], np.uint64), np.zeros(len(rows), np.int64)
    whole = impurity_of(forest.impurity, np.array([rows.sum()]), np.array([ones.sum()]))
    opened = np.arange(1) if len(rows) and width and abs(whole[0]) >= _EPSILON else np.arange(0)  # nodes of the last level
    while len(opened) and level < forest.depth:
        features = _features(places, width, forest)
        step = max(1, _CELLS // (features.shape[1] * forest.bins))
        bounds = np.searchsorted(slot, np.arange(len(opened) + 1))  # rows lie by node
        found = []
        for low in range(0, len(opened), step):
            part = slice(bounds[low], bounds[min(low + step, len(opened))])
            own = features[low : low + step]
            found.append(best_splits(counted(bins[part], rows[part], ones[part], slot[part] - low, own, forest.bins), own, forest))
        feature, split, gain, side_rows, side_ones = (np.concatenate(f) for f in zip(*found, strict=True))
        divided = np.flatnonzero(gain > 0)
        last = growing.parts[-1]
        at = opened[divided]
        first_child = growing.size + 2 * np.arange(len(divided))
        last[0][at], last[1][at], last[2][at], last[5][at] = feature[divided], split[divided], first_child, gain[divided]
        level += 1
        child_rows, child_ones = side_rows[divided].ravel(), side_ones[divided].ravel()
        growing.parts.append(_Growing._leaves(child_rows, child_ones, level))
        growing.size += len(child_rows)
        child = np.flatnonzero(np.abs(impurity_of(forest.impurity, child_rows, child_ones)) >= _EPSILON)
        new = np.full((len(opened), 2), -1)
        new[divided] = np.arange(2 * len(divided)).reshape(-1, 2)
        renumbered = np.full(2 * len(divided) + 1, -1)  # the last one for rows of leaves
        renumbered[child] = np.arange(len(child))
        goes_right = bins[np.arange(len(slot)), feature[slot]] > split[slot]
        next_slot = renumbered[new[slot, goes_right.astype(np.int64)]]
        kept = np.flatnonzero(next_slot >= 0)
        kept = kept[np.argsort(next_slot[kept], kind="stable")]
        bins, rows, ones, slot = bins[kept], rows[kept], ones[kept], next_slot[kept]
        places = _children(places[divided]).ravel()[child]
        opened = child
    return growing.tree()


@dataclass
class Block:
    """Rows of the training table: labels, folds, bins by held-out fold, and votes for label 1 of the rows that a forest
    holds out, by forest and depth."""

    number: int
    label: np.ndarray
    fold: np.ndarray
    bins: Mapping[int, np.ndarray]
    votes: Mapping[tuple[int, int], np.ndarray]

    def drawn(self, forest: Forest, tree: int) -> np.ndarray:
        """How often the tree draws each row."""
        if forest.bootstrap:
            rows = np.random.default_rng([forest.seed & (2**64 - 1), tree, self.number]).poisson(1.0, len(self.label))
        else:
            rows = np.ones(len(self.label), np.int64)
        return np.where(self.fold == forest.held_out, 0, rows).astype(np.uint8)


Member = tuple[Forest, int]  # a tree by its number


@dataclass
class Rows:
    """The training rows as blocks, their number and the thresholds by the fold that a forest holds out."""

    state: RDD
    counts: Mapping[int, int]
    thresholds: Mapping[int, list[np.ndarray]]

    @property
    def width(self) -> int:
        return len(next(iter(self.thresholds.values())))

    @property
    def at_once(self) -> int:
        """Trees that are grown at once."""
        return max(1, min(TREES_AT_ONCE, ROWS_AT_ONCE // max(self.counts.values())))


def _blocks(train: DataFrame, names: Sequence[str], thresholds: Mapping[int, list[np.ndarray]]) -> RDD:
    fold, label, features = names

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(low, BLOCK_ROWS)
                y = part.column(0).to_numpy(zero_copy_only=False).astype("<f8")
                f = part.column(1).to_numpy(zero_copy_only=False).astype("<i4")
                x = part.column(2).flatten().to_numpy(zero_copy_only=False).astype("<f8")
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (y, f, x)], ["label", "fold", "x"])

    def binned(rows: Iterator) -> Iterator[Block]:
        for k, row in enumerate(rows):
            y, f = np.frombuffer(row.label, "<f8"), np.frombuffer(row.fold, "<i4")
            x = np.frombuffer(row.x, "<f8").reshape(len(y), -1)
            bins = {held_out: binned_rows(x, of) for held_out, of in thresholds.items()}
            yield Block(TaskContext.get().partitionId() << 32 | k, y == 1, f, bins, {})

    rows = train.select(F.col(label).alias("label"), F.col(fold).cast("int").alias("fold"), vector_to_array(features).alias("x"))
    return rows.mapInArrow(packed, "label binary, fold binary, x binary").rdd.mapPartitions(binned)


def binned_rows(x: np.ndarray, thresholds: Sequence[np.ndarray]) -> np.ndarray:
    """``[row, feature]``"""
    kind = np.min_scalar_type(max(map(len, thresholds), default=0))
    bins = np.empty((len(x), len(thresholds)), kind)
    for i, of in enumerate(thresholds):
        bins[:, i] = np.searchsorted(of, x[:, i])
    return bins


def grow(rows: Rows, members: Sequence[Member]) -> list[Tree]:
    """The trees of ``members``, uncut."""
    state, wide, width = rows.state, rows.width, rows.state.context.defaultParallelism
    # A root counts as all rows until those that it drew are known.
    trees = {i: _Growing(rows.counts[forest.held_out], 0, 0).tree() for i, (forest, _) in enumerate(members)}
    opened = {i: [(0, _root(*member))] for i, member in enumerate(members)}
    small: list[tuple[int, int, int]] = []  # tree, node, place
    while True:
        large: dict[int, list[tuple[int, int]]] = {}
        for i, nodes in opened.items():
            for node, place in nodes:
                if trees[i].rows[node] > NODE_ROWS:
                    large.setdefault(i, []).append((node, place))
                else:
                    small.append((i, node, place))
        if not large:
            break
        now = {i: (trees[i], nodes) for i, nodes in large.items()}

        def sums(blocks: Iterator[Block], now=now) -> Iterator[tuple]:
            added: dict[int, np.ndarray] = {}
            for block in blocks:
                for i, (tree, nodes) in now.items():
                    forest, number = members[i]
                    bins, drawn = block.bins[forest.held_out], block.drawn(forest, number)
                    slot = _slots(tree, [node for node, _ in nodes], bins)
                    own = np.flatnonzero((slot >= 0) & (drawn > 0))
                    features = _features(np.array([place for _, place in nodes], np.uint64), bins.shape[1], forest)
                    times = drawn[own].astype(np.float64)
                    cells = counted(bins[own], times, times * block.label[own], slot[own], features, forest.bins)
                    added[i] = added[i] + cells if i in added else cells
            for i, cells in added.items():
                for k, (node, _) in enumerate(now[i][1]):
                    yield (i, node), cells[:, k : k + 1]

        def chosen(item: tuple, now=now) -> tuple:
            (i, node), cells = item
            place = np.array([dict(now[i][1])[node]], np.uint64)
            return i, node, [v[0] for v in best_splits(cells, _features(place, wide, members[i][0]), members[i][0])]

        found = state.mapPartitions(sums).reduceByKey(np.add, min(width, sum(map(len, large.values())))).map(chosen).collect()
        opened = {i: [] for i in large}
        places = {(i, node): place for i, nodes in large.items() for node, place in nodes}
        for i, node, (feature, split, gain, side_rows, side_ones) in sorted(found, key=lambda f: f[:2]):
            tree, child = trees[i], len(trees[i].feature)
            tree.rows[node], tree.value[node] = side_rows.sum(), side_ones.sum() / max(side_rows.sum(), 1)
            if not gain > 0 or tree.level[node] >= members[i][0].depth:
                continue
            leaves = _Growing._leaves(side_rows, side_ones, int(tree.level[node]) + 1)
            trees[i] = tree = Tree(*(np.concatenate(c) for c in zip(tree.columns(), leaves, strict=True)))
            tree.feature[node], tree.split[node], tree.left[node], tree.gain[node] = feature, split, child, gain
            impure = np.abs(impurity_of(members[i][0].impurity, side_rows, side_ones)) >= _EPSILON
            for side, place in enumerate(_children(np.array([places[i, node]], np.uint64))[0].tolist()):
                if impure[side] and tree.level[child] < members[i][0].depth:
                    opened[i].append((child + side, place))
    if not small:
        return [trees[i] for i in range(len(members))]
    ends: dict[int, list[int]] = {}  # small nodes of each tree, as places in ``small``
    for k, (i, _, _) in enumerate(small):
        ends.setdefault(i, []).append(k)
    first = {i: trees[i] for i in ends}
    size = [int(trees[i].rows[node]) for i, node, _ in small]
    parts = min(len(small), max(width, -(-sum(size) // NODE_ROWS)))
    loads, task_of = [(0, p) for p in range(parts)], {}
    for k in sorted(range(len(small)), key=lambda k: -size[k]):  # the largest first, each to the task with the fewest rows
        load, p = heapq.heappop(loads)
        task_of[k] = p
        heapq.heappush(loads, (load + size[k], p))

    def dealt(blocks: Iterator[Block]) -> Iterator[tuple]:
        for block in blocks:
            for i, tree in first.items():
                forest, number = members[i]
                bins, drawn = block.bins[forest.held_out], block.drawn(forest, number)
                slot = _slots(tree, [small[k][1] for k in ends[i]], bins)
                own = np.flatnonzero((slot >= 0) & (drawn > 0))
                own = own[np.argsort(slot[own], kind="stable")]
                for part in np.split(own, np.flatnonzero(np.diff(slot[own])) + 1) if len(own) else []:
                    yield ends[i][slot[part[0]]], (block.number, bins[part], drawn[part], block.label[part])

    def below(item: tuple) -> tuple[int, Tree]:
        k, pieces = item
        _, bins, drawn, label = zip(*sorted(pieces, key=lambda p: p[0]), strict=True)
        i, node, place = small[k]
        tree = grown(np.concatenate(bins), np.concatenate(drawn), np.concatenate(label), place, int(first[i].level[node]), members[i][0])
        return k, tree

    found = state.mapPartitions(dealt).groupByKey(parts, lambda k: task_of[k]).map(below).collect()  # one tree per small node
    for k, tree in sorted(found, key=lambda f: f[0]):
        trees[small[k][0]] = _grafted(trees[small[k][0]], small[k][1], tree)
    return [trees[i] for i in range(len(members))]


def _slots(tree: Tree, nodes: Sequence[int], bins: np.ndarray) -> np.ndarray:
    """The place in ``nodes`` of each row's node, -1 for others."""
    of_node = np.full(len(tree.feature), -1, np.int64)
    of_node[list(nodes)] = np.arange(len(nodes))
    return of_node[tree.nodes_of(bins)]


def _grafted(tree: Tree, node: int, below: Tree) -> Tree:
    """``tree`` with ``below`` in the place of the leaf ``node``."""
    shifted = replace(below, left=np.where(below.feature >= 0, below.left + len(tree.feature) - 1, 0))
    columns = []
    for column, lower in zip(tree.columns(), shifted.columns(), strict=True):
        column = column.copy()
        column[node] = lower[0]
        columns.append(np.concatenate([column, lower[1:]]))
    return Tree(*columns)


def blocks_of(train: DataFrame, held: Sequence[int], bins: int, fold: str | None = None, label: str = "label", features: str = "scaled_features") -> Rows:
    """The rows of ``train`` as persisted blocks. Without a fold column all rows belong to one that nobody holds out."""
    spark = train.sparkSession
    ship_code(spark)
    if fold is None:
        train, fold = train.withColumn("_fold", F.lit(0)), "_fold"
    counts = {r[fold]: r["count"] for r in train.groupBy(fold).count().collect()}  # one row per fold
    rows = {h: sum(n for f, n in counts.items() if f != h) for h in held}
    if not all(rows.values()):
        raise ValueError("a forest has no training rows")
    order = [F.xxhash64(vector_to_array(features))]
    thresholds = {h: thresholds_of_rows(train.where(F.col(fold) != h), features, order, bins) for h in held}
    parts = max(1, min(spark.sparkContext.defaultParallelism, -(-sum(counts.values()) // PARTITION_ROWS)))
    state = _blocks(train.select(fold, label, features).repartition(parts), (fold, label, features), thresholds)
    return Rows(state.persist(StorageLevel.MEMORY_AND_DISK), rows, thresholds)


class Parted:
    """A forest kept as parts of few trees in the scratch folder, so that the driver holds one part and not the forest.

    Every tree votes with the class shares of its leaf, as in Spark's own forest. Asked for predictions, each part writes
    its votes for all rows, and Spark adds them up per row.
    """

    def __init__(self, paths: Sequence[str]):
        self.paths = list(paths)

    def votes(self, path: str, rows: DataFrame) -> DataFrame:
        """``rows`` with ``_raw``: what the trees of a part add up to, by label."""
        raise NotImplementedError

    def transform(self, df: DataFrame) -> DataFrame:
        spark = df.sparkSession
        rows = materialize(df.withColumn("_row", F.monotonically_increasing_id()), "forest-rows")
        votes = scratch_path(spark, "forest-votes")
        for i, path in enumerate(self.paths):
            self.votes(path, rows).select("_row", F.lit(i).alias("_part"), "_raw").write.mode("append").parquet(votes)
        cast = spark.read.schema("_row long, _part int, _raw array<double>").parquet(votes)
        # Added in the order of the parts, so that equal votes stay equal.
        listed = F.transform(F.sort_array(F.collect_list(F.struct("_part", "_raw"))), lambda v: v["_raw"])
        sums = F.reduce(F.slice("_votes", 2, len(self.paths)), F.col("_votes")[0], lambda a, b: F.zip_with(a, b, lambda x, y: x + y))
        added = cast.groupBy("_row").agg(listed.alias("_votes")).select("_row", sums.alias("_sums"))
        total = F.aggregate("_sums", F.lit(0.0), lambda a, b: a + b)
        scored = rows.join(added, "_row").withColumn("probability", array_to_vector(F.transform("_sums", lambda v: v / total)))
        first = F.array_position("_sums", F.array_max("_sums")) - 1
        return scored.withColumn("prediction", first.cast("double")).drop("_row", "_sums")


class GrownForest(Parted):
    """Trees of this module."""

    def __init__(self, paths: Sequence[str], thresholds: Sequence[np.ndarray], features: str):
        super().__init__(paths)
        self.thresholds, self.features = list(thresholds), features

    def trees(self, spark: SparkSession, path: str) -> list[Tree]:
        rows = spark.read.schema("tree int, packed binary").parquet(path).collect()  # the trees of one part
        return [pickle.loads(r.packed) for r in sorted(rows, key=lambda r: r.tree)]

    @property
    def featureImportances(self) -> DenseVector:
        spark, width = SparkSession.active(), len(self.thresholds)
        total = sum(sum(t.importance(width) for t in self.trees(spark, path)) for path in self.paths)
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def votes(self, path: str, rows: DataFrame) -> DataFrame:
        spark = rows.sparkSession
        ship_code(spark)
        shared = spark.sparkContext.broadcast((self.trees(spark, path), self.thresholds))

        @F.arrow_udf("array<double>")
        def raw(x: pa.Array) -> pa.Array:
            trees, thresholds = shared.value
            bins = binned_rows(x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), len(thresholds)), thresholds)
            ones = sum((t.value[t.nodes_of(bins)] for t in trees), np.zeros(len(x)))
            both = np.stack([len(trees) - ones, ones], axis=1)
            return pa.ListArray.from_arrays(np.arange(0, both.size + 1, 2, dtype=np.int32), both.ravel())

        return rows.withColumn("_raw", raw(vector_to_array(self.features)))


def fit(rows: Rows, spark: SparkSession, forest: Forest, features: str = "scaled_features") -> GrownForest:
    """One forest, grown and written in parts."""
    paths = []
    for low in range(0, forest.trees, rows.at_once):
        members = [(forest, t) for t in range(low, min(forest.trees, low + rows.at_once))]
        trees = grow(rows, members)
        packed = pa.table(
            {"tree": pa.array([t for _, t in members], pa.int32()), "packed": pa.array([pickle.dumps(t.cut(forest.depth)) for t in trees], pa.binary())}
        )
        paths.append(scratch_path(spark, "grown-trees"))
        spark.createDataFrame(packed).coalesce(1).write.parquet(paths[-1])
    return GrownForest(paths, rows.thresholds[forest.held_out], features)


def many(train: DataFrame) -> bool:
    """Whether ``train`` has rows enough to be grown here."""
    return train.limit(LEAST_ROWS).count() == LEAST_ROWS


def fit_alone(train: DataFrame, forest: Forest) -> GrownForest:
    rows = blocks_of(train, [NOBODY], forest.bins)
    try:
        return fit(rows, train.sparkSession, forest)
    finally:
        rows.state.unpersist()


def held_out_scores(rows: Rows, spark: SparkSession, problems: Sequence[Forest]) -> DataFrame:
    """``(problem, label, probability)``: every row that a problem holds out, scored by its forest.

    Problems that differ in trees and depth alone share their trees, those of the deepest and largest of them."""
    groups: dict[Forest, list[int]] = {}
    for i, p in enumerate(problems):
        groups.setdefault(replace(p, trees=0, depth=0), []).append(i)
    whole = [
        (replace(f, trees=max(problems[i].trees for i in own), depth=max(problems[i].depth for i in own)), own) for f, own in groups.items()
    ]
    state, stale, scored, low = rows.state, [], [], 0
    for length in sorted({p.trees for p in problems}):
        members = [(g, t) for g, (f, _) in enumerate(whole) for t in range(low, min(length, f.trees))]
        for start in range(0, len(members), rows.at_once):
            part = members[start : start + rows.at_once]
            trees = grow(rows, [(whole[g][0], t) for g, t in part])
            shared = spark.sparkContext.broadcast([(g, t) for (g, _), t in zip(part, trees, strict=True)])
            before, state = state, state.map(_voter(shared, [f for f, _ in whole], [sorted({problems[i].depth for i in own}) for _, own in whole]))
            state = state.persist(StorageLevel.MEMORY_AND_DISK)
            state.count()
            if before is not rows.state:
                stale.append(before)
        ended = [(i, g, p.depth) for g, (_, own) in enumerate(whole) for i in own if (p := problems[i]).trees == length]
        scored.append(materialize(_scored(spark, state, ended, [f for f, _ in whole], length), "forest-scores"))
        low = length
    for old in (*stale, state):
        old.unpersist()
    found = scored[0]
    for more in scored[1:]:
        found = found.unionByName(more)
    return found


def _voter(shared, forests: Sequence[Forest], depths: Sequence[Sequence[int]]) -> Callable[[Block], Block]:
    def add(block: Block) -> Block:
        votes = dict(block.votes)
        for g, tree in shared.value:
            own = block.fold == forests[g].held_out
            bins = block.bins[forests[g].held_out][own]
            for depth in depths[g]:
                cut = tree.cut(depth)
                votes[g, depth] = votes.get((g, depth), 0.0) + cut.value[cut.nodes_of(bins)]
        return replace(block, votes=votes)

    return add


def _scored(spark: SparkSession, state: RDD, ended: Sequence[tuple[int, int, int]], forests: Sequence[Forest], length: int) -> DataFrame:
    def rows(block: Block) -> Iterator[tuple]:
        for i, g, depth in ended:
            own = block.fold == forests[g].held_out
            if own.any():
                yield i, block.label[own].astype(float).tolist(), (block.votes[g, depth] / length).tolist()

    listed = spark.createDataFrame(state.flatMap(rows), "problem int, label array<double>, probability array<double>")
    return listed.select("problem", F.explode(F.arrays_zip("label", "probability")).alias("r")).select("problem", "r.label", "r.probability")

"""Many fits of boosted trees in shared rounds over the rows.

A grid search boosts the same rows for each step, depth and fold, and a fit of its own runs a Spark job for each level of
each of its trees. Here one round grows the next tree of every (step, depth, fold). Rows lie in blocks of binned features
with a margin per problem. While a node has more than ``NODE_ROWS`` rows, tasks add up its counts, sums and squares per
feature and bin, Spark adds up the tasks, and a task picks the split. The rows of a smaller node, binned, go to one task,
which grows everything below it. So a round takes as many jobs as the largest tree has levels of large nodes, and one.

Trees are those of ``GBTClassifier`` without sampling: variance as impurity, ``maxBins`` bins, the first tree fits the
labels -1 and 1 with weight 1, others the gradient of the log loss with the step as weight. Thresholds come from at most
``SPLIT_ROWS`` training rows, as in Spark's trees, which draw theirs by chance; up to that number they are the same.
"""

from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, TaskContext
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline.plans.logistic_path import NOBODY
from ebbline.sources.scratch import materialize
from ebbline.sources.workers import ship_code

#: Rows that thresholds are taken from, rows of a node that one task grows, rows per block, least rows per partition.
SPLIT_ROWS = 10_000
NODE_ROWS = 8_192
BLOCK_ROWS = 16_384
PARTITION_ROWS = 5_000
#: Rounds until margins are taken from the last cut in one step, so that no lineage grows with the rounds.
CUT_EVERY = 20
_CELLS = 1 << 20  # histogram cells held at once while a task grows nodes
_EPSILON = 2.0**-52


@dataclass(frozen=True)
class Problem:
    """``rounds`` trees of at most ``depth`` levels of splits, on all rows that are not in the fold ``held_out``."""

    step: float = 0.1
    depth: int = 5
    rounds: int = 20
    held_out: int = NOBODY


@dataclass(frozen=True)
class Rules:
    """What a split must keep to."""

    bins: int = 32
    least_rows: int = 1
    least_gain: float = 0.0


class Tree:
    """Nodes in arrays, the root first: feature (-1 in a leaf), last bin that goes left, children, mean, gain, rows."""

    NAMES = ("feature", "split", "left", "right", "value", "gain", "rows")
    KINDS = (np.int32, np.int32, np.int32, np.int32, np.float64, np.float64, np.int64)

    def __init__(self, nodes: Sequence[Sequence]):
        columns = zip(*nodes, strict=True) if len(nodes) else ([] for _ in self.NAMES)
        for name, kind, column in zip(self.NAMES, self.KINDS, columns, strict=True):
            setattr(self, name, np.array(column, kind))

    def leaves(self, goes_left: Callable[[np.ndarray, np.ndarray], np.ndarray], n: int) -> np.ndarray:
        """The node each of ``n`` rows ends in; ``goes_left(rows, nodes)`` tells where rows at inner nodes go."""
        node = np.zeros(n, np.int32)
        rows = np.flatnonzero(self.feature[node] >= 0)
        while len(rows):
            at = node[rows]
            node[rows] = np.where(goes_left(rows, at), self.left[at], self.right[at])
            rows = rows[self.feature[node[rows]] >= 0]
        return node

    def of_bins(self, bins: np.ndarray) -> np.ndarray:
        return self.leaves(lambda rows, at: bins[self.feature[at], rows] <= self.split[at], bins.shape[1])


def thresholds_of(values: np.ndarray, bins: int) -> np.ndarray:
    """At most ``bins - 1`` thresholds between the values of a column, by Spark's rule."""
    value, count = np.unique(values, return_counts=True)
    most = min(bins, len(values)) - 1
    middle = (value[:-1] + value[1:]) / 2
    if len(middle) <= most:
        return middle
    stride, total, target, found = len(values) / (most + 1), np.cumsum(count), len(values) / (most + 1), []
    for i in range(len(middle)):
        if abs(total[i] - target) < abs(total[i + 1] - target):
            found.append(middle[i])
            target += stride
    return np.array(found)


def _impurity(count, total, square):
    safe = np.where(count > 0, count, 1)
    return np.where(count > 0, (square - total * total / safe) / safe, 0.0)


def histogram(bins: np.ndarray, target: np.ndarray, slot: np.ndarray, slots: int, size: int) -> np.ndarray:
    """``[slot, feature, bin, (count, sum, square)]`` of the rows, whose node is ``slot``."""
    width = len(bins)
    cells = np.zeros((3, slots * width * size))
    for low in range(0, len(target), NODE_ROWS):
        part = slice(low, low + NODE_ROWS)
        place = ((slot[part] * width + np.arange(width)[:, None]) * size + bins[:, part]).ravel()
        wanted = np.tile(target[part], width)
        for sums, weights in zip(cells, (None, wanted, wanted * wanted), strict=True):
            sums += np.bincount(place, weights, minlength=len(sums))
    return cells.reshape(3, slots, width, size)


def best_splits(cells: np.ndarray, many: np.ndarray, impurity: np.ndarray, rules: Rules) -> list[tuple | None]:
    """Per node the best ``(feature, bin, gain, left, right)`` with ``(rows, mean, impurity)`` of both sides, or None.

    ``many`` is the number of thresholds of each feature; the first of equal gains wins, features in order. An
    ``impurity`` that is not a number is taken from the sums."""
    if not many.any():
        return [None] * len(impurity)
    sums = np.cumsum(cells, axis=3)
    left = sums[..., :-1]
    right = sums[..., -1:] - left
    all_rows = sums[0, ..., -1:]
    inner = [_impurity(*side) for side in (left, right)]
    used = int(np.argmax(many > 0))
    own = _impurity(*(left[:, :, used, 0] + right[:, :, used, 0]))
    impurity = np.where(np.isnan(impurity), own, impurity)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = impurity[:, None, None] - left[0] / all_rows * inner[0] - right[0] / all_rows * inner[1]
    valid = (left[0] >= rules.least_rows) & (right[0] >= rules.least_rows) & (gain >= rules.least_gain)
    valid &= np.arange(gain.shape[2]) < many[:, None]
    gain = np.where(valid, gain, -np.inf).reshape(len(gain), -1)
    found: list[tuple | None] = []
    for k, at in enumerate(np.argmax(gain, axis=1)):
        if not gain[k, at] > 0:
            found.append(None)
            continue
        feature, split = divmod(int(at), left.shape[3])
        sides = [
            (int(s[0, k, feature, split]), float(s[1, k, feature, split] / s[0, k, feature, split]), float(i[k, feature, split]))
            for s, i in ((left, inner[0]), (right, inner[1]))
        ]
        found.append((feature, split, float(gain[k, at]), *sides))
    return found


def _leaf(rows: int, mean: float) -> list:
    return [-1, 0, 0, 0, mean, 0.0, rows]


def _split(nodes: list[list], node: int, found: tuple, levels: int) -> list[tuple[int, float, int]]:
    """Give the leaf ``node`` two children; ``(child, impurity, levels left)`` of those that may be split further."""
    feature, split, gain, *sides = found
    nodes[node][:4] = feature, split, len(nodes), len(nodes) + 1
    nodes[node][5] = gain
    opened = []
    for rows, mean, impurity in sides:
        if levels > 1 and abs(impurity) >= _EPSILON:
            opened.append((len(nodes), impurity, levels - 1))
        nodes.append(_leaf(rows, mean))
    return opened


def grown(
    bins: np.ndarray, target: np.ndarray, impurity: float, levels: int, many: np.ndarray, rules: Rules
) -> Tree:
    """The tree of a node from its rows."""
    count = len(target)
    nodes = [_leaf(count, float(np.sum(target)) / count if count else 0.0)]
    opened = [(0, impurity)] if count and levels and len(many) else []
    slot = np.zeros(count, np.int64)
    while opened:
        step = max(1, _CELLS // (len(many) * rules.bins))
        if len(opened) > step:  # rows by node, so that a part of the nodes is a slice
            order = np.argsort(slot, kind="stable")
            bins, target, slot = bins[:, order], target[order], slot[order]
        after, new_slot = [], np.full(len(slot), -1, np.int64)
        for low in range(0, len(opened), step):
            part = opened[low : low + step]
            rows = slice(*np.searchsorted(slot, [low, low + len(part)])) if len(opened) > step else slice(None)
            cells = histogram(bins[:, rows], target[rows], slot[rows] - low, len(part), rules.bins)
            chosen = best_splits(cells, many, np.array([i for _, i in part]), rules)
            feature, split, next_slot = np.zeros(len(part), np.int64), np.zeros(len(part), np.int64), np.full((len(part), 2), -1)
            for k, ((node, _), found) in enumerate(zip(part, chosen, strict=True)):
                if found is None:
                    continue
                feature[k], split[k] = found[:2]
                for child, inner, _ in _split(nodes, node, found, levels):
                    next_slot[k, child - nodes[node][2]] = len(after)
                    after.append((child, inner))
            own = slot[rows] - low
            goes_right = bins[:, rows][feature[own], np.arange(len(own))] > split[own]
            new_slot[rows] = next_slot[own, goes_right.astype(np.int64)]
        kept = np.flatnonzero(new_slot >= 0)
        bins, target, slot = bins[:, kept], target[kept], new_slot[kept]
        opened, levels = after, levels - 1
    return Tree(nodes)


@dataclass
class Block:
    """Rows of the training table: labels -1 and 1, folds, bins by held-out fold, margins by problem."""

    number: int
    label: np.ndarray
    fold: np.ndarray
    bins: Mapping[int, np.ndarray]
    margin: np.ndarray

    def target(self, problem: int, first: bool) -> np.ndarray:
        """What the next tree fits."""
        if first:
            return self.label
        return 4.0 * self.label / (1.0 + np.exp(2.0 * self.label * self.margin[problem]))

    def plus(self, problems: Sequence[Problem], rounds: Sequence[Mapping[int, Tree]], start: int) -> "Block":
        """With the trees of the rounds from ``start`` on added to the margins."""
        margin = self.margin.copy()
        for r, trees in enumerate(rounds, start):
            for i, tree in trees.items():
                weight = problems[i].step if r else 1.0
                margin[i] += weight * tree.value[tree.of_bins(self.bins[problems[i].held_out])]
        return Block(self.number, self.label, self.fold, self.bins, margin)


def _blocks(train: DataFrame, names: Sequence[str], thresholds: Mapping[int, list[np.ndarray]], problems: int) -> RDD:
    """The rows as persisted blocks."""
    fold, label, features = names

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ["label", "fold", "x"]
        for batch in batches:
            for low in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(low, BLOCK_ROWS)
                y = part.column(0).to_numpy(zero_copy_only=False).astype("<f8")
                f = part.column(1).to_numpy(zero_copy_only=False).astype("<i4")
                x = part.column(2).flatten().to_numpy(zero_copy_only=False).astype("<f8")
                yield pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in (y, f, x)], columns)

    def binned(rows: Iterator) -> Iterator[Block]:
        for k, row in enumerate(rows):
            y, f = np.frombuffer(row.label, "<f8"), np.frombuffer(row.fold, "<i4")
            x = np.frombuffer(row.x, "<f8").reshape(len(y), -1)
            bins = {
                held_out: np.array([np.searchsorted(t, x[:, i]) for i, t in enumerate(of)], np.min_scalar_type(max(map(len, of), default=0)))
                for held_out, of in thresholds.items()
            }
            yield Block(TaskContext.get().partitionId() << 32 | k, 2 * y - 1, f, bins, np.zeros((problems, len(y))))

    rows = train.select(F.col(label).alias("label"), F.col(fold).alias("fold"), vector_to_array(features).alias("x"))
    return rows.mapInArrow(packed, "label binary, fold binary, x binary").rdd.mapPartitions(binned)


def _thresholds(train: DataFrame, held_out: int, names: Sequence[str], key: str, bins: int) -> list[np.ndarray]:
    fold, _, features = names
    return thresholds_of_rows(train.where(F.col(fold) != held_out), features, [F.xxhash64(F.col(key)), F.col(key)], bins)


def thresholds_of_rows(rows: DataFrame, features: str, order: Sequence[Column], bins: int) -> list[np.ndarray]:
    """Thresholds of each column, from the first ``SPLIT_ROWS`` rows by ``order`` where there are more."""
    if rows.limit(SPLIT_ROWS + 1).count() > SPLIT_ROWS:
        rows = rows.orderBy(*order).limit(SPLIT_ROWS)
    x = rows.select(vector_to_array(features).alias("x")).toArrow().column(0).combine_chunks()  # SPLIT_ROWS rows at most
    table = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1) if len(x) else np.zeros((0, 0))
    return [thresholds_of(column, bins) for column in table.T]


def _round(
    state: RDD, problems: Sequence[Problem], first: bool, active: Sequence[int], many: Mapping[int, np.ndarray], rules: Rules, rows: Mapping[int, int]
) -> dict[int, Tree]:
    """The next tree of each active problem. ``rows`` are the training rows by held-out fold."""
    width = state.context.defaultParallelism
    trees = {i: [_leaf(rows[problems[i].held_out], 0.0)] for i in active}
    opened = {i: [(0, np.nan, problems[i].depth)] for i in active}
    small: dict[int, list[tuple[int, float, int]]] = {i: [] for i in active}
    while True:
        large: dict[int, list] = {}
        for i, nodes in opened.items():
            for entry in nodes:
                if trees[i][entry[0]][6] > NODE_ROWS:
                    large.setdefault(i, []).append(entry)
                else:
                    small[i].append(entry)
        if not large:
            break
        now = {i: (Tree(trees[i]), {node: k for k, (node, _, _) in enumerate(nodes)}) for i, nodes in large.items()}
        known = {(i, node): impurity for i, nodes in large.items() for node, impurity, _ in nodes}

        def sums(blocks: Iterator[Block], now=now) -> Iterator[tuple]:
            added, number = {}, None
            for block in blocks:
                number = block.number if number is None else number
                for i, (tree, slots) in now.items():
                    bins = block.bins[problems[i].held_out]
                    slot = _slots(tree, slots, bins)
                    own = np.flatnonzero((slot >= 0) & (block.fold != problems[i].held_out))
                    cells = histogram(bins[:, own], block.target(i, first)[own], slot[own], len(slots), rules.bins)
                    added[i] = added[i] + cells if i in added else cells
            for i, cells in added.items():
                for node, k in now[i][1].items():
                    yield (i, node), (number, cells[:, k])

        def chosen(item: tuple, known=known) -> tuple:
            (i, node), parts = item
            cells = sum(c for _, c in sorted(parts, key=lambda p: p[0]))[:, None]
            count, total, _ = cells[:, 0, 0].sum(axis=1)
            split = best_splits(cells, many[problems[i].held_out], np.array([known[i, node]]), rules)[0]
            return i, node, float(total / count), split

        found = state.mapPartitions(sums).groupByKey(min(width, len(known))).map(chosen).collect()  # one row per large node
        levels = {(i, node): level for i, nodes in large.items() for node, _, level in nodes}
        opened = {i: [] for i in active}
        for i, node, mean, split in sorted(found, key=lambda f: f[:2]):
            trees[i][node][4] = mean
            if split is not None and levels[i, node]:
                opened[i] += _split(trees[i], node, split, levels[i, node])
    wanted = {i: nodes for i, nodes in small.items() if nodes}
    if not wanted:
        return {i: Tree(nodes) for i, nodes in trees.items()}
    now = {i: (Tree(trees[i]), {node: k for k, (node, _, _) in enumerate(nodes)}) for i, nodes in wanted.items()}

    def dealt(blocks: Iterator[Block]) -> Iterator[tuple]:
        for block in blocks:
            for i, (tree, slots) in now.items():
                bins = block.bins[problems[i].held_out]
                slot = _slots(tree, slots, bins)
                own = np.flatnonzero((slot >= 0) & (block.fold != problems[i].held_out))
                own = own[np.argsort(slot[own], kind="stable")]
                target = block.target(i, first)
                for part in np.split(own, np.flatnonzero(np.diff(slot[own])) + 1) if len(own) else []:
                    yield (i, int(slot[part[0]])), (block.number, bins[:, part], target[part])

    def below(item: tuple) -> tuple:
        (i, k), parts = item
        _, bins, target = zip(*sorted(parts, key=lambda p: p[0]), strict=True)
        _, impurity, levels = wanted[i][k]
        tree = grown(np.concatenate(bins, axis=1), np.concatenate(target), impurity, levels, many[problems[i].held_out], rules)
        return i, k, tree

    size = sum(trees[i][node][6] * len(many[problems[i].held_out]) for i, nodes in wanted.items() for node, _, _ in nodes)
    parts = max(min(width, sum(map(len, wanted.values()))), size >> 26)
    for i, k, tree in sorted(state.mapPartitions(dealt).groupByKey(parts).map(below).collect(), key=lambda f: f[:2]):
        _graft(trees[i], wanted[i][k][0], tree)
    return {i: Tree(nodes) for i, nodes in trees.items()}


def _slots(tree: Tree, slots: Mapping[int, int], bins: np.ndarray) -> np.ndarray:
    """The slot of each row's node, -1 for nodes without one."""
    of_node = np.full(len(tree.feature), -1, np.int64)
    of_node[list(slots)] = list(slots.values())
    return of_node[tree.of_bins(bins)]


def _graft(nodes: list[list], node: int, tree: Tree) -> None:
    """Put ``tree`` in the place of the leaf ``node``."""
    shift = len(nodes) - 1
    rows = [list(row) for row in zip(*(getattr(tree, name).tolist() for name in Tree.NAMES), strict=True)]
    for row in rows:
        if row[0] >= 0:
            row[2], row[3] = row[2] + shift, row[3] + shift
    nodes[node][:] = rows[0]
    nodes.extend(rows[1:])


@dataclass(frozen=True)
class BoostedTrees:
    """The first trees of a fit, scored like ``GBTClassificationModel``."""

    trees: Sequence[Tree]
    step: float
    thresholds: Sequence[np.ndarray]
    features_column: str = "scaled_features"

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def treeWeights(self) -> list[float]:
        return [self.step if i else 1.0 for i in range(len(self.trees))]

    @property
    def featureImportances(self) -> DenseVector:
        """Gain times rows of each feature's splits, adding up to 1."""
        total = np.zeros(len(self.thresholds))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner] * tree.rows[inner])
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def margins(self, x: np.ndarray) -> np.ndarray:
        margin = np.zeros(len(x))
        bins = np.array([np.searchsorted(t, x[:, i]) for i, t in enumerate(self.thresholds)]).reshape(-1, len(x))
        for tree, weight in zip(self.trees, self.treeWeights, strict=True):
            margin += weight * tree.value[tree.of_bins(bins)]
        return margin

    def transform(self, df: DataFrame) -> DataFrame:
        ship_code(df.sparkSession)
        width, shared = len(self.thresholds), df.sparkSession.sparkContext.broadcast(self)

        @F.arrow_udf("double")
        def margin(x: pa.Array) -> pa.Array:
            rows = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), width)
            return pa.array(shared.value.margins(rows))

        likely = 1 / (1 + F.exp(-2 * F.col("_margin")))
        scored = df.withColumn("_margin", margin(vector_to_array(self.features_column)))
        scored = scored.withColumn("probability", array_to_vector(F.array(1 - likely, likely)))
        return scored.withColumn("prediction", (F.col("_margin") > 0).cast("double")).drop("_margin")


def fit_path(
    train: DataFrame,
    problems: Sequence[Problem],
    lengths: Sequence[int],
    key: str,
    fold: str = "fold",
    label: str = "label",
    features: str = "scaled_features",
    rules: Rules = Rules(),
) -> tuple[DataFrame, list[BoostedTrees | None]]:
    """Held-out scores and models of all problems.

    ``(problem, length, label, probability)``: every row that a problem holds out, scored by its first ``length`` trees,
    for each of ``lengths`` that it has. Models are those of problems that hold out nothing, None for the others.
    """
    spark = train.sparkSession
    ship_code(spark)
    names = (fold, label, features)
    counts = {r[fold]: r["count"] for r in train.groupBy(fold).count().collect()}  # one row per fold
    held = sorted({p.held_out for p in problems})
    rows = {h: sum(n for f, n in counts.items() if f != h) for h in held}
    if not all(rows.values()):
        raise ValueError("a problem has no training rows")
    thresholds = {h: _thresholds(train, h, names, key, rules.bins) for h in held}
    many = {h: np.array([len(t) for t in of], np.int64) for h, of in thresholds.items()}
    parts = min(spark.sparkContext.defaultParallelism, -(-sum(counts.values()) // PARTITION_ROWS))
    dealt = train.repartition(parts, key).sortWithinPartitions(key) if parts > 1 else train.coalesce(1)
    base = _blocks(dealt, names, thresholds, len(problems)).persist(StorageLevel.MEMORY_AND_DISK)
    kept: dict[int, list[Tree]] = {i: [] for i, p in enumerate(problems) if p.held_out == NOBODY}
    state, cut, since, stale, scored = base, base, [], [], None
    for r in range(max(p.rounds for p in problems)):
        active = [i for i, p in enumerate(problems) if r < p.rounds]
        trees = _round(state, problems, r == 0, active, many, rules, rows)
        for old in stale:
            old.unpersist()
        for i in kept:
            if i in trees:
                kept[i].append(trees[i])
        since.append(trees)
        if len(since) == CUT_EVERY:
            stale = [cut] if state is cut else [cut, state]
            state = cut = cut.map(_adder(problems, since, r + 1 - CUT_EVERY)).persist(StorageLevel.MEMORY_AND_DISK)
            since = []
        else:
            stale = [] if state is cut else [state]
            state = state.map(_adder(problems, [trees], r)).persist(StorageLevel.MEMORY_AND_DISK)
        if r + 1 in lengths:
            part = materialize(_held_out(spark, state, problems, r + 1), "boosted-scores")
            scored = part if scored is None else scored.unionByName(part)
    for old in (*stale, cut, state):
        old.unpersist()
    models = [
        BoostedTrees(kept[i], p.step, thresholds[NOBODY], features) if i in kept else None for i, p in enumerate(problems)
    ]
    return scored, models


def _adder(problems: Sequence[Problem], rounds: Sequence[Mapping[int, Tree]], start: int) -> Callable[[Block], Block]:
    rounds = list(rounds)
    return lambda block: block.plus(problems, rounds, start)


def _held_out(spark: SparkSession, state: RDD, problems: Sequence[Problem], length: int) -> DataFrame:
    def rows(block: Block) -> Iterator[tuple]:
        for i, p in enumerate(problems):
            own = block.fold == p.held_out
            if p.rounds >= length and own.any():
                likely = 1.0 / (1.0 + np.exp(-2.0 * block.margin[i][own]))
                yield i, length, ((block.label[own] + 1) / 2).tolist(), likely.tolist()

    listed = spark.createDataFrame(
        state.flatMap(rows), "problem int, length int, label array<double>, probability array<double>"
    )
    each = listed.select("problem", "length", F.explode(F.arrays_zip("label", "probability")).alias("r"))
    return each.select("problem", "length", "r.label", "r.probability")

"""Whole grid searches: shared work between grid points, parallel fits, and results that outlive the driver.

Five ways to fit a grid. Logistic plans solve all points and folds in shared passes (``logistic_path``). Boosted plans
fit the most rounds only, once for each of the other parameters: the first rounds of a longer fit are the shorter fit.
Where the estimator neither samples nor weighs, all these fits grow in shared rounds (``boosted_path``); else they are
fits of their own. Forests of many rows grow together, and points that differ in trees and depth alone share their trees
(``forest_path``). Other plans fit point by point. All but the logistic ones write every finished (fit, fold) as one row
to a state folder; a search that is started again on the same rows goes on where the last one stopped. Shared rounds end
together, so what they leave behind when stopped is nothing.
"""

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from ebbline.functions import safe_ratio
from ebbline.operators.metrics import threshold_table
from ebbline.operators.transform import stratified_folds
from ebbline.plans import boosted_path, forest_path, logistic_path
from ebbline.sources.scratch import materialize, scratch_path
from ebbline.sources.workers import ship_code

FOLD = "fold"
#: Rows per partition of the training table: fits are many small jobs, so few rows are not spread over many tasks.
PARTITION_ROWS = 50_000


@dataclass(frozen=True)
class Searched:
    """Scores of a grid (points x folds, in the order of ``points``) and the best point's model of all rows."""

    points: Sequence[Mapping[str, object]]
    scores: np.ndarray
    bestModel: object

    @property
    def avgMetrics(self) -> list[float]:
        return self.scores.mean(axis=1).tolist()

    @property
    def stdMetrics(self) -> list[float]:
        return self.scores.std(axis=1).tolist()

    @property
    def best(self) -> Mapping[str, object]:
        """The point with the highest mean score, the first one on ties."""
        return self.points[int(np.argmax(self.scores.mean(axis=1)))]


def grid_points(grid: Mapping[str, Sequence]) -> list[dict]:
    """Every combination of the grid's values, the last name varying fastest."""
    points: list[dict] = [{}]
    for name, values in grid.items():
        points = [point | {name: value} for point in points for value in values]
    return points


def in_partitions(df: DataFrame) -> DataFrame:
    """``df`` dealt out so that a partition has ``PARTITION_ROWS`` rows at most. Reads it once to count them."""
    return df.repartition(max(1, -(-df.count() // PARTITION_ROWS)))


def with_folds(train: DataFrame, key: str, folds: int, stratified: bool = False) -> DataFrame:
    """``train`` with a fold number that depends on the key only, or that spreads each label evenly, as a table."""
    if stratified:
        folded = stratified_folds(train, key, "label", folds, FOLD)
    else:
        folded = train.withColumn(FOLD, F.pmod(F.xxhash64(F.col(key), F.lit(FOLD)), F.lit(folds)).cast("int"))
    return materialize(in_partitions(folded), "folds")


# Scores of hard predictions and of probabilities, by problem


def weighted_f1(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by.., score)``: F1 of both classes, weighted by their rows."""
    truth, guess = F.col("label") == 1, F.col("probability") > 0.5
    counts = scored.groupBy(*by).agg(
        F.count_if(truth & guess).alias("tp"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(~truth & ~guess).alias("tn"),
        F.count_if(truth & ~guess).alias("fn"),
    )
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))

    def f1(hit: Column) -> Column:
        return safe_ratio(2 * hit, 2 * hit + fp + fn)

    return counts.select(*by, safe_ratio((tp + fn) * f1(tp) + (tn + fp) * f1(tn), tp + fp + tn + fn).alias("score"))


def area(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by.., score)``: the exact area under the ROC curve, 0.5 where there is one label only."""
    scored = materialize(scored, "held-out")
    tp, pos, neg = F.col("tp"), F.col("pos"), F.col("neg")
    sums = threshold_table(scored, "label", "probability", by).groupBy(*by).agg(
        F.sum(neg * (tp - pos / 2)).alias("roc"), (F.sum(pos) * F.sum(neg)).alias("pairs")
    )
    return sums.select(*by, F.coalesce(F.try_divide("roc", "pairs"), F.lit(0.5)).alias("score"))


METRICS: Mapping[str, Callable[[DataFrame, Sequence[str]], DataFrame]] = {"f1": weighted_f1, "auc": area}


# Finished fits


class State:
    """Rows ``(fit, fold, scores)`` of finished fits in a folder, one small file each, or one for fits that end together.

    A fit's name is a digest of the estimator, its parameters, the fold rule, the metric and the rows, so that rows of
    another search or of other data are never taken for its own. Two drivers may write to one folder: both write the
    same scores under the same name.
    """

    SCHEMA = "fit string, fold int, scores array<double>"

    def __init__(self, spark: SparkSession, path: str, identity: Mapping[str, object]):
        self.spark, self.path, self.identity = spark, path, dict(identity)
        self.done: dict[tuple[str, int], list[float]] = {}
        try:
            found = spark.read.schema(self.SCHEMA).json(f"{path}/*/*.json")
            self.done = {(r.fit, r.fold): r.scores for r in found.collect()}  # one row per finished fit
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise

    def name(self, parameters: Mapping[str, object]) -> str:
        text = json.dumps([self.identity, parameters], sort_keys=True, default=str)
        return hashlib.sha256(text.encode()).hexdigest()[:32]

    def get(self, name: str, fold: int) -> list[float] | None:
        return self.done.get((name, fold))

    def put(self, name: str, fold: int, scores: Sequence[float]) -> None:
        self.put_all([(name, fold, list(scores))])

    def put_all(self, found: Sequence[tuple[str, int, list[float]]]) -> None:
        rows = self.spark.createDataFrame(found, self.SCHEMA).coalesce(1)
        # A new folder each time, so that a stopped writer leaves no half row under a name that is read.
        rows.write.json(f"{self.path}/{found[0][0]}-{found[0][1]}-{uuid.uuid4().hex}")
        self.done |= {(name, fold): scores for name, fold, scores in found}


def fingerprint(train: DataFrame) -> str:
    """Rows and a sum of row hashes, whatever their order."""
    columns = [vector_to_array(f.name) if isinstance(f.dataType, VectorUDT) else F.col(f.name) for f in train.schema]
    hashed = train.select(F.xxhash64(*columns).cast("decimal(20,0)").alias("h"))
    n, total = hashed.agg(F.count("*"), F.sum("h")).first()
    return f"{n}-{total}"


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model after ``rounds`` rounds: its first trees with their weights."""
    spark = SparkSession.active()
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    kept = min(rounds, model.getNumTrees)
    trees = gateway.new_array(jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, kept)
    weights = gateway.new_array(jvm.double, kept)
    for i, (tree, weight) in enumerate(zip(model._java_obj.trees()[:kept], model.treeWeights[:kept], strict=True)):
        trees[i], weights[i] = tree, weight
    shorter = GBTClassificationModel(jvm.org.apache.spark.ml.classification.GBTClassificationModel(model.uid, trees, weights))
    shorter.setFeaturesCol(model.getFeaturesCol()).setPredictionCol(model.getPredictionCol())
    return shorter.setProbabilityCol(model.getProbabilityCol()).setRawPredictionCol(model.getRawPredictionCol())


# Searches


def _fitted(estimator: Callable[[], object], parameters: Mapping[str, object], rows: DataFrame):
    made = estimator()
    return made.copy({made.getParam(name): value for name, value in parameters.items()}).fit(rows)


def _score(metric: str, model, rows: DataFrame) -> float:
    """A model's score by Spark's evaluators, on exact curves. The same figures as those of ``METRICS``."""
    if metric == "f1":
        evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName="f1")
    else:
        evaluator = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="probability", numBins=0)
    return evaluator.evaluate(model.transform(rows))


def run_parallel(tasks: Sequence[Callable[[], object]], parallelism: int, spark: SparkSession) -> list:
    """Results of the tasks, ``parallelism`` at a time, each a driver thread that starts its own Spark jobs."""

    def call(task):
        return task()

    # Wrapped one by one: tasks wrapped together would share one set of local properties, in which the end of one
    # query removes the execution id that another has just set.
    own = [inheritable_thread_target(spark)(task) for task in tasks]
    pool = ThreadPool(processes=max(1, min(parallelism, len(tasks))))
    try:
        return pool.map(call, own, chunksize=1)
    finally:
        pool.terminate()


def search_logistic(
    train: DataFrame, points: Sequence[Mapping[str, object]], folds: int, metric: str, features: str
) -> tuple[np.ndarray, list]:
    """Scores of all points on all folds, and each point's model of all rows, from shared passes."""
    names = {"regParam": "strength", "elasticNetParam": "mix", "maxIter": "max_iter"}
    problems = [
        logistic_path.Problem(**{names[k]: v for k, v in point.items()}, held_out=fold)
        for point in points
        for fold in (*range(folds), logistic_path.NOBODY)
    ]
    models = logistic_path.fit_path(train, problems, FOLD, "label", features)
    scored = logistic_path.held_out_scores(train, models, problems, FOLD, "label", features)
    found = {r.problem: r.score for r in METRICS[metric](scored, ["problem"]).collect()}  # one row per problem
    scores = np.array([[found.get(i * (folds + 1) + f, 0.0) for f in range(folds)] for i in range(len(points))])
    return scores, models[folds :: folds + 1]


def search_fits(
    estimator: Callable[[], object],
    train: DataFrame,
    points: Sequence[Mapping[str, object]],
    folds: int,
    metric: str,
    state: State,
    parallelism: int,
    rounds: str | None = None,
) -> np.ndarray:
    """Scores of all points on all folds. With ``rounds``, the name of a parameter that counts boosting rounds, points
    that differ in it alone are scored on one fit. Finished fits are read from ``state``, new ones are added to it."""
    groups: dict[str, tuple[dict, list[int]]] = {}
    for i, point in enumerate(points):
        others = {k: v for k, v in point.items() if k != rounds}
        groups.setdefault(state.name(others), (others, []))[1].append(i)
    scores = np.zeros((len(points), folds))

    def task(others: dict, members: list[int], fold: int):
        def run():
            lengths = sorted({points[i][rounds] for i in members}) if rounds else []
            name = state.name(others | {"lengths": lengths})
            found = state.get(name, fold)
            if found is None:
                longest = others | {rounds: lengths[-1]} if rounds else others
                model = _fitted(estimator, longest, train.filter(F.col(FOLD) != fold))
                models = [first_rounds(model, n) for n in lengths] if rounds else [model]
                found = [_score(metric, m, train.filter(F.col(FOLD) == fold)) for m in models]
                state.put(name, fold, found)
            for i in members:
                scores[i, fold] = found[lengths.index(points[i][rounds])] if rounds else found[0]

        return run

    tasks = [task(others, members, fold) for others, members in groups.values() for fold in range(folds)]
    run_parallel(tasks, parallelism, train.sparkSession)
    return scores


def shares_rounds(estimator, names: Sequence[str]) -> bool:
    """Whether fits of ``estimator`` that differ in ``names`` can grow in shared rounds: all rows and features, no weights."""
    if not isinstance(estimator, GBTClassifier) or not {"stepSize", "maxIter", "maxDepth"}.issuperset(names):
        return False
    plain = GBTClassifier()
    checked = ("subsamplingRate", "featureSubsetStrategy", "minWeightFractionPerNode", "lossType", "impurity")
    same = all(estimator.getOrDefault(name) == plain.getOrDefault(name) for name in checked)
    return same and not any(estimator.isDefined(name) for name in ("weightCol", "validationIndicatorCol", "thresholds"))


def search_boosted(
    estimator, train: DataFrame, points: Sequence[Mapping[str, object]], key: str, folds: int, metric: str, state: State
) -> tuple[np.ndarray, object]:
    """Scores of all points on all folds and the best point's model of all rows, from shared rounds.

    Folds that ``state`` has are not fitted again; new ones are added to it."""
    rules = boosted_path.Rules(estimator.getMaxBins(), estimator.getMinInstancesPerNode(), estimator.getMinInfoGain())
    whole = [
        {"stepSize": estimator.getStepSize(), "maxDepth": estimator.getMaxDepth(), "maxIter": estimator.getMaxIter()} | point
        for point in points
    ]
    longest: dict[tuple[float, int], int] = {}
    for p in whole:
        longest[p["stepSize"], p["maxDepth"]] = max(p["maxIter"], longest.get((p["stepSize"], p["maxDepth"]), 0))
    names = [state.name({"shared": p}) for p in whole]
    found = {(i, f): state.get(name, f)[0] for i, name in enumerate(names) for f in range(folds) if state.get(name, f)}
    todo = {(p["stepSize"], p["maxDepth"], f) for i, p in enumerate(whole) for f in range(folds) if (i, f) not in found}

    def fitted(problems: list[boosted_path.Problem], lengths: Sequence[int]):
        label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
        return boosted_path.fit_path(train, problems, lengths, key, FOLD, label, features, rules)

    problems = [boosted_path.Problem(s, d, longest[s, d], f) for s, d, f in sorted(todo)]
    models: dict[tuple, boosted_path.BoostedTrees] = {}
    if problems:
        ends = [boosted_path.Problem(s, d, n) for (s, d), n in longest.items()]
        scored, of_all = fitted(problems + ends, sorted({p["maxIter"] for p in whole}))
        models = {(p.step, p.depth): m for p, m in zip(ends, of_all[len(problems) :], strict=True)}
        rows = METRICS[metric](scored, ["problem", "length"]).collect()  # one row per problem and length
        new = {(problems[r.problem], r.length): r.score for r in rows}
        for i, p in enumerate(whole):
            s, d, n = p["stepSize"], p["maxDepth"], p["maxIter"]
            for f in range(folds):
                if (i, f) not in found:
                    found[i, f] = new.get((boosted_path.Problem(s, d, longest[s, d], f), n), 0.0)
        state.put_all([(names[i], f, [found[i, f]]) for i in range(len(points)) for f in range(folds)])
    scores = np.array([[found[i, f] for f in range(folds)] for i in range(len(points))])
    best = whole[int(np.argmax(scores.mean(axis=1)))]
    s, d, n = best["stepSize"], best["maxDepth"], best["maxIter"]
    if (s, d) not in models:
        models[s, d] = fitted([boosted_path.Problem(s, d, n)], [])[1][0]
    return scores, replace(models[s, d], trees=models[s, d].trees[:n])


def forest_of(estimator, point: Mapping[str, object], held_out: int) -> forest_path.Forest | None:
    """What a point asks for as a forest that can grow with others, None where it samples, weighs or stops otherwise."""
    made = estimator.copy({estimator.getParam(name): value for name, value in point.items()})
    plain = RandomForestClassifier()
    checked = ("subsamplingRate", "minInfoGain", "minWeightFractionPerNode", "bootstrap", "leafCol")
    same = all(made.getOrDefault(name) == plain.getOrDefault(name) for name in checked)
    weighted = any(made.isDefined(name) for name in ("weightCol", "thresholds"))
    features = {"auto": made.getNumTrees() == 1, "all": True, "sqrt": False}.get(made.getFeatureSubsetStrategy())
    if not same or weighted or features is None:
        return None
    return forest_path.Forest(
        made.getNumTrees(), made.getMaxDepth(), made.getMinInstancesPerNode(), made.getImpurity(), features,
        made.getNumTrees() > 1, made.getSeed(), made.getMaxBins(), held_out,
    )


def search_forests(
    estimator, train: DataFrame, points: Sequence[Mapping[str, object]], folds: int, metric: str, state: State
) -> tuple[np.ndarray, object]:
    """Scores of all points on all folds and the best point's model of all rows, from trees that grow together.

    Folds that ``state`` has are not fitted again; new ones are added to it."""
    names = [state.name({"grown": p}) for p in points]
    found = {(i, f): state.get(name, f)[0] for i, name in enumerate(names) for f in range(folds) if state.get(name, f)}
    problems = {(i, f): forest_of(estimator, p, f) for i, p in enumerate(points) for f in range(folds) if (i, f) not in found}
    asked = list(dict.fromkeys(problems.values()))
    held = sorted({p.held_out for p in asked})
    label, features = estimator.getLabelCol(), estimator.getFeaturesCol()
    rows = forest_path.blocks_of(train, [*held, forest_path.NOBODY], estimator.getMaxBins(), FOLD, label, features)
    try:
        if problems:
            scored = METRICS[metric](forest_path.held_out_scores(rows, train.sparkSession, asked), ["problem"])
            new = {asked[r.problem]: r.score for r in scored.collect()}  # one row per problem
            found |= {at: new.get(problem, 0.0) for at, problem in problems.items()}
            state.put_all([(names[i], f, [found[i, f]]) for i, f in problems])
        scores = np.array([[found[i, f] for f in range(folds)] for i in range(len(points))])
        best = forest_of(estimator, points[int(np.argmax(scores.mean(axis=1)))], forest_path.NOBODY)
        return scores, forest_path.fit(rows, train.sparkSession, best, features)
    finally:
        rows.state.unpersist()


def search(
    estimator: Callable[[], object],
    grid: Mapping[str, Sequence],
    train: DataFrame,
    key: str,
    folds: int = 3,
    metric: str = "f1",
    stratified: bool = False,
    rounds: str | None = None,
    shared: bool = False,
    parallelism: int = 4,
    state_path: str | None = None,
    alike: Callable[[Mapping[str, object]], Mapping[str, object]] | None = None,
) -> Searched:
    """Score every grid point on every fold and fit the best one to all rows.

    ``shared`` solves a logistic grid in shared passes; ``rounds`` names the parameter that counts boosting rounds.
    Folds follow the row's key, so a search that is started again sees the same ones. ``state_path``, a folder that
    survives the application, makes a search resumable; without it finished fits are kept for this search only.
    Points for which ``alike`` returns the same parameters ask for the same model and share its fits and scores.
    """
    spark = train.sparkSession
    ship_code(spark)
    points = grid_points(grid)
    folded = with_folds(train, key, folds, stratified)
    if shared:
        scores, models = search_logistic(folded, points, folds, metric, estimator().getFeaturesCol())
        return Searched(points, scores, models[int(np.argmax(scores.mean(axis=1)))])
    identity = {
        "estimator": type(estimator()).__name__,
        "defaults": {p.name: v for p, v in estimator().extractParamMap().items()},
        "folds": [folds, stratified],
        "metric": metric,
        "rows": fingerprint(folded),
    }
    state = State(spark, state_path or scratch_path(spark, "search"), identity)
    if rounds and shares_rounds(estimator(), list(grid)):
        return Searched(points, *search_boosted(estimator(), folded, points, key, folds, metric, state))
    if not rounds and isinstance(estimator(), RandomForestClassifier) and "maxBins" not in grid and forest_path.many(folded):
        if all(forest_of(estimator(), point, 0) for point in points):
            return Searched(points, *search_forests(estimator(), folded, points, folds, metric, state))
    asked = [alike(point) for point in points] if alike else points
    scores = search_fits(estimator, folded, asked, folds, metric, state, parallelism, rounds)
    best = points[int(np.argmax(scores.mean(axis=1)))]
    return Searched(points, scores, _fitted(estimator, best, folded))

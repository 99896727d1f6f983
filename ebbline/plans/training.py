"""Churn model training: preparation, parameter grids, cross-validation, scoring.

Training data is written once as a vector table before any grid search; models never see a
collected row. Grids run ``parallelism`` fits at a time.
"""

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from math import log

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    NaiveBayes,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ebbline.operators.metrics import score_metrics
from ebbline.operators.neighbours import knn_classify
from ebbline.operators.transform import assemble, stratified_folds, train_test_split
from ebbline.plans import forest_path
from ebbline.plans.search import Searched, in_partitions, run_parallel, search
from ebbline.schema import USER
from ebbline.sources.scratch import materialize, scratch_path
from ebbline.sources.workers import ship_code

LOG = logging.getLogger(__name__)
COLUMNS = {"labelCol": "label", "featuresCol": "scaled_features"}


@dataclass(frozen=True)
class Plan:
    """An estimator with its parameter grid, its fold rule and the metric that ranks the grid.

    ``rounds`` names the parameter that counts boosting rounds; ``shared`` marks logistic grids, which are fitted in
    shared passes; ``alike`` names what a point asks for, where several ways to write it give the same model.
    """

    estimator: Callable[[], object]
    grid: Mapping[str, Sequence] = field(default_factory=dict)
    folds: int = 3
    metric: str = "f1"
    stratified: bool = False
    rounds: str | None = None
    shared: bool = False
    alike: Callable[[Mapping], Mapping] | None = None


def same_forest(point: Mapping[str, object]) -> Mapping[str, object]:
    """The point by the features that its splits choose from: of several classifying trees "auto" is "sqrt"."""
    if point.get("featureSubsetStrategy") == "auto" and point.get("numTrees", 20) > 1:
        return {**point, "featureSubsetStrategy": "sqrt"}
    return point


# Estimators and grids of the training plans.
PLANS = {
    "logistic_regression": Plan(
        lambda: LogisticRegression(family="binomial", standardization=True, **COLUMNS),
        {"maxIter": [20, 40, 60], "regParam": [0.0, 0.1, 0.01, 0.001]},
        4,
        shared=True,
    ),
    "random_forest": Plan(
        lambda: RandomForestClassifier(seed=42, cacheNodeIds=True, **COLUMNS),
        {
            "numTrees": [10, 20, 30],
            "maxDepth": [10, 20, 30],
            "minInstancesPerNode": [1, 5],
            "featureSubsetStrategy": ["auto", "sqrt"],
            "impurity": ["gini", "entropy"],
        },
        4,
        alike=same_forest,
    ),
    "gradient_boost": Plan(
        lambda: GBTClassifier(seed=42, **COLUMNS),
        {"maxIter": [10, 20], "maxDepth": [10, 20]},
        3,
        rounds="maxIter",
    ),
    "glm": Plan(
        lambda: LogisticRegression(family="binomial", **COLUMNS),
        {
            "elasticNetParam": [0.0, 0.2, 0.4, 0.6, 0.8, 1.0],
            "regParam": [1e-5, 1e-4, 1e-3, 1e-2, 1e-1, 1.0],
        },
        metric="auc",
        shared=True,
    ),
    "gbm": Plan(
        lambda: GBTClassifier(seed=42, **COLUMNS),
        {"stepSize": [0.01, 0.1, 0.2], "maxIter": [50, 100, 200], "maxDepth": [3, 4, 5]},
        metric="auc",
        rounds="maxIter",
    ),
    "distributed_forest": Plan(
        lambda: RandomForestClassifier(seed=42, **COLUMNS),
        {
            "numTrees": [50, 100, 150],
            "maxDepth": [5, 10, 15],
            "minInstancesPerNode": [1, 5, 10],
            "subsamplingRate": [0.7, 0.8, 0.9],
            "featureSubsetStrategy": ["0.7", "0.8", "0.9"],
            "minInfoGain": [1e-4, 1e-3, 1e-2],
        },
        5,
        metric="auc",
        stratified=True,
    ),
}


def select_features(df: DataFrame, wanted: Sequence[str] | None = None) -> list[str]:
    """Wanted columns the table has, warning about the others; by default every numeric column, with a warning for
    each column that is not."""
    if wanted is None:
        numeric = [f.name for f in df.schema if isinstance(f.dataType, NumericType)]
        for name in df.columns:
            if name not in numeric:
                LOG.warning("column %s is not numeric and is no feature", name)
        return numeric
    for name in wanted:
        if name not in df.columns:
            LOG.warning("column %s is not in the table and cannot be used", name)
    return [name for name in wanted if name in df.columns]


@dataclass(frozen=True)
class Prepared:
    train: DataFrame
    test: DataFrame
    features: list[str]
    key: str = USER


def prepare(
    df: DataFrame,
    wanted: Sequence[str] | None = None,
    key: str = USER,
    test_percent: int = 20,
    random_seed: int | None = None,
) -> Prepared:
    """Assemble, split and min-max scale (fitted on the training side), written as two tables.

    Splits by key hash; with ``random_seed`` by ``randomSplit``, which depends on partitioning.
    """
    names = [c for c in select_features(df, wanted) if c not in (key, "label")]
    rows = assemble(df, names).select(key, F.col("label").cast("double").alias("label"), "features")
    if random_seed is None:
        train, test = train_test_split(rows, key, test_percent)
    else:
        share = test_percent / 100
        rows = materialize(rows, "assembled")
        test, train = rows.randomSplit([share, 1 - share], seed=random_seed)
    train = materialize(in_partitions(train), "train")
    scaler = MinMaxScaler(inputCol="features", outputCol="scaled_features").fit(train)
    return Prepared(
        materialize(scaler.transform(train), "train-scaled"),
        materialize(scaler.transform(test), "test-scaled"),
        names,
        key,
    )


def param_grid(estimator, values: Mapping[str, Sequence]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(estimator.getParam(name), options)
    return builder.build()


def cross_validate(
    estimator,
    grid: Mapping[str, Sequence],
    train: DataFrame,
    folds: int = 3,
    evaluator=None,
    parallelism: int = 4,
    stratified: bool = False,
    key: str = USER,
) -> CrossValidatorModel:
    """Grid search by weighted F1 unless another evaluator is given."""
    search = CrossValidator(
        estimator=Pipeline(stages=[estimator]),
        estimatorParamMaps=param_grid(estimator, grid),
        evaluator=evaluator or MulticlassClassificationEvaluator(labelCol="label"),
        numFolds=folds,
        parallelism=parallelism,
        seed=42,
    )
    if stratified:
        train = materialize(stratified_folds(train, key, "label", folds), "folds")
        search = search.setFoldCol("fold")
    return search.fit(train)


def cv_scores(model: CrossValidatorModel | Searched) -> DataFrame:
    """(parameters, mean_score, std_score) per grid point; as many rows as the grid has points."""
    if isinstance(model, Searched):
        points = model.points
    else:
        points = [{p.name: v for p, v in point.items()} for point in model.getEstimatorParamMaps()]
    rows = [
        (", ".join(f"{name}={v}" for name, v in sorted(point.items())), float(mean), float(std))
        for point, mean, std in zip(points, model.avgMetrics, model.stdMetrics)
    ]
    return SparkSession.active().createDataFrame(rows, "parameters string, mean_score double, std_score double")


def run_plan(
    name: str, train: DataFrame, grid: Mapping[str, Sequence] | None = None, key: str = USER, evaluator=None, **options
) -> Searched | CrossValidatorModel:
    """Grid search of a named plan by its own folds and metric, over its full grid unless another one is given.

    ``options`` go to ``search``; an ``evaluator`` of one's own goes through Spark's cross-validator instead.
    """
    plan = PLANS[name]
    grid = plan.grid if grid is None else grid
    options = {"folds": plan.folds, "stratified": plan.stratified} | options
    if evaluator is not None:
        return cross_validate(plan.estimator(), grid, train, evaluator=evaluator, key=key, **options)
    options = {"metric": plan.metric, "rounds": plan.rounds, "shared": plan.shared, "alike": plan.alike} | options
    return search(plan.estimator, grid, train, key, **options)


def area_evaluator() -> BinaryClassificationEvaluator:
    return BinaryClassificationEvaluator(labelCol="label", metricName="areaUnderROC")


def predictions(model, test: DataFrame, key: str = USER) -> DataFrame:
    """(key, label, prediction) and, if the model gives one, the probability of label 1."""
    scored = model.transform(test)
    columns = [key, F.col("label").cast("int").alias("label"), "prediction"]
    if "probability" in scored.columns:
        columns.append(vector_to_array("probability")[1].alias("probability"))
    return scored.select(*columns)


def with_balanced_weights(df: DataFrame, label: str = "label", name: str = "weight") -> DataFrame:
    """Weight n / (2 * rows of the row's class)."""
    counts = df.agg(
        F.struct(
            F.count("*").alias("n"), F.count_if(F.col(label) == 1).alias("ones")
        ).alias("counts")
    ).scalar()
    n, ones = counts.getField("n"), counts.getField("ones")
    of_class = F.when(F.col(label) == 1, ones).otherwise(n - ones)
    return df.withColumn(name, n / (2 * of_class))


def balanced_logistic(train: DataFrame, l1_ratio: float = 0.7, c: float = 1.0):
    """Elastic-net logistic regression on class-balanced weights."""
    weighted = materialize(with_balanced_weights(train), "weighted")
    estimator = LogisticRegression(
        weightCol="weight",
        elasticNetParam=l1_ratio,
        regParam=1.0 / (c * weighted.count()),
        standardization=False,
        maxIter=100,
        **COLUMNS,
    )
    return estimator.fit(weighted)


def linear_svc(train: DataFrame, c: float = 0.7):
    """Linear support vector classifier; the kernel form has no distributed solver."""
    reg = 1.0 / (c * train.count())
    return LinearSVC(regParam=reg, standardization=False, maxIter=100, **COLUMNS).fit(train)


class PartedForest(forest_path.Parted):
    """Parts that Spark's forest has fitted."""

    def votes(self, path: str, rows: DataFrame) -> DataFrame:
        part = RandomForestClassificationModel.load(path).setPredictionCol("").setProbabilityCol("")
        return part.setRawPredictionCol("_votes").transform(rows).withColumn("_raw", vector_to_array("_votes"))


def random_forest(train: DataFrame, trees: int = 300, depth: int = 25, part: int = 25, parallelism: int = 2) -> forest_path.Parted:
    """A forest fitted ``part`` trees at a time, each part by a seed of its own and with a bootstrap of all rows.

    Many rows are not fitted by Spark's forest, which takes jobs for each level of each part (``forest_path``)."""
    spark = train.sparkSession
    if forest_path.many(train):
        return forest_path.fit_alone(train, forest_path.Forest(trees, depth, every_feature=trees == 1, bootstrap=trees > 1))

    def task(start: int):
        def run() -> str:
            estimator = RandomForestClassifier(
                numTrees=min(part, trees - start), maxDepth=depth, cacheNodeIds=True, seed=42 + start, **COLUMNS
            )
            # A last part of one tree chooses among as many features as the others.
            path = scratch_path(spark, "forest-part")
            estimator.setFeatureSubsetStrategy("sqrt" if trees > 1 else "auto").fit(train).write().save(path)
            return path

        return run

    return PartedForest(run_parallel([task(start) for start in range(0, trees, part)], parallelism, spark))


def boosted_trees(train: DataFrame, rounds: int = 100, rate: float = 0.1, depth: int = 3):
    estimator = GBTClassifier(maxIter=rounds, stepSize=rate, maxDepth=depth, seed=42, **COLUMNS)
    return estimator.fit(train)


def decision_tree(train: DataFrame, depth: int = 30):
    if forest_path.many(train):
        return forest_path.fit_alone(train, forest_path.Forest(1, depth, every_feature=True, bootstrap=False))
    return DecisionTreeClassifier(maxDepth=depth, seed=42, **COLUMNS).fit(train)


def bagging(train: DataFrame, trees: int = 10, depth: int = 30):
    """Bootstrap trees that see every feature at each split."""
    if forest_path.many(train):
        return forest_path.fit_alone(train, forest_path.Forest(trees, depth, every_feature=True, bootstrap=trees > 1))
    estimator = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="all", bootstrap=True, seed=42,
        **COLUMNS,
    )
    return estimator.fit(train)


def naive_bayes(train: DataFrame):
    return NaiveBayes(modelType="gaussian", **COLUMNS).fit(train)


class BoostedModel:
    """Weighted vote of trees."""

    def __init__(self, trees: Sequence, weights: Sequence[float]):
        self.trees, self.weights = list(trees), list(weights)

    def transform(self, df: DataFrame) -> DataFrame:
        margin = F.lit(0.0)
        scored = df
        for i, (tree, weight) in enumerate(zip(self.trees, self.weights)):
            scored = tree.copy().setPredictionCol(f"_p{i}").setRawPredictionCol("").setProbabilityCol(
                ""
            ).transform(scored)
            margin = margin + weight * (2 * F.col(f"_p{i}") - 1)
        voted = scored.withColumn("prediction", (margin > 0).cast("double"))
        return voted.drop(*(f"_p{i}" for i in range(len(self.trees))))


def adaboost(
    train: DataFrame, rounds: int = 100, rate: float = 0.1, depth: int = 3, cut_every: int = 5
) -> BoostedModel:
    """Discrete two-class boosting over shallow trees.

    Row weights live in a table; their lineage is cut every ``cut_every`` rounds. Per round the
    driver sees one weighted error.
    """
    current = train.select("label", "scaled_features", F.lit(1.0).alias("w"))
    trees, weights = [], []
    for i in range(rounds):
        tree = DecisionTreeClassifier(maxDepth=depth, weightCol="w", seed=42 + i, **COLUMNS).fit(current)
        guess = tree.copy().setRawPredictionCol("").setProbabilityCol("").transform(current)
        miss = (F.col("prediction") != F.col("label")).cast("double")
        missed, total = guess.agg(F.sum(F.col("w") * miss), F.sum("w")).first()
        error = missed / total
        if error >= 0.5:
            break
        trees.append(tree)
        if error <= 0:
            weights.append(1.0)
            break
        alpha = rate * log((1 - error) / error)
        weights.append(alpha)
        # Scaled so that weights keep averaging one.
        grown = F.col("w") * F.exp(F.lit(alpha) * miss)
        scale = (total - missed + missed * (1 - error) ** rate / error**rate) / total
        current = guess.select("label", "scaled_features", (grown / scale).alias("w"))
        if (i + 1) % cut_every == 0:
            current = materialize(current, "boosting-weights")
    if not trees:
        raise ValueError("no tree beats chance on the training rows")
    return BoostedModel(trees, weights)


class RealBoostedModel:
    """Sum of half log odds of the trees' leaves."""

    def __init__(self, trees: Sequence, rate: float):
        self.trees, self.rate = list(trees), rate

    def transform(self, df: DataFrame) -> DataFrame:
        scored, margin = df, F.lit(0.0)
        for i, tree in enumerate(self.trees):
            scored = _half_log_odds(tree, scored, f"_h{i}")
            margin = margin + self.rate * F.col(f"_h{i}")
        likely = 1 / (1 + F.exp(-2 * margin))
        voted = scored.withColumn("probability", array_to_vector(F.array(1 - likely, likely)))
        voted = voted.withColumn("prediction", (margin > 0).cast("double"))
        return voted.drop(*(f"_h{i}" for i in range(len(self.trees))))


def _half_log_odds(tree, df: DataFrame, name: str, least: float = 2.0**-52) -> DataFrame:
    """``df`` with half the log odds of label 1 in the row's leaf."""
    scored = tree.copy().setPredictionCol("").setRawPredictionCol("").setProbabilityCol("_leaf").transform(df)
    likely = F.greatest(F.least(vector_to_array("_leaf")[1], F.lit(1 - least)), F.lit(least))
    return scored.withColumn(name, F.log(likely / (1 - likely)) / 2).drop("_leaf")


def real_adaboost(
    train: DataFrame, rounds: int = 100, rate: float = 0.1, depth: int = 3, cut_every: int = 5
) -> RealBoostedModel:
    """Two-class boosting on leaf probabilities instead of votes.

    A row's weight falls by how sure its leaf is of the right label and grows by how sure it is of the wrong one, so
    every round uses the margins and not only the errors. It ends with the first tree that makes no error. Row weights
    live in a table; every ``cut_every`` rounds it is written anew, with a mean weight of one, and the driver reads
    the rounds' errors, a handful of sums. In between, the rows of a round are kept until the next ones are, since a fit
    reads its rows several times and would run the trees before it each time.
    """
    current, trees = train.select("label", "scaled_features", F.lit(1.0).alias("w")), []
    side, kept = 2 * F.col("label") - 1, None
    for start in range(0, rounds, cut_every):
        length = min(cut_every, rounds - start)
        for i in range(length):
            kept, last = current.persist(), kept
            tree = DecisionTreeClassifier(maxDepth=depth, weightCol="w", seed=42 + start + i, **COLUMNS).fit(kept)
            trees.append(tree)
            if last is not None:
                last.unpersist()
            scored = _half_log_odds(tree, current, "_h")
            wrong = F.when(side * F.col("_h") <= 0, F.col("w")).otherwise(0.0).alias(f"_wrong{i}")
            moved = (F.col("w") * F.exp(-rate * side * F.col("_h"))).alias("w")
            current = scored.select("label", "scaled_features", moved, *(f"_wrong{j}" for j in range(i)), wrong)
        current = materialize(current, "boosting-weights")
        kept.unpersist()
        kept = None
        *missed, mean = current.agg(*(F.sum(f"_wrong{i}") for i in range(length)), F.avg("w")).first()
        if not all(missed):
            return RealBoostedModel(trees[: start + 1 + [bool(m) for m in missed].index(False)], rate)
        current = current.select("label", "scaled_features", (F.col("w") / mean).alias("w"))
    return RealBoostedModel(trees, rate)


class NeighbourModel:
    """Looks up the nearest training rows when asked for predictions."""

    def __init__(self, train: DataFrame, k: int, key: str = USER):
        self.train, self.k, self.key = train, k, key

    def transform(self, df: DataFrame) -> DataFrame:
        size = self.train.select(F.size(vector_to_array("scaled_features"))).first()[0]
        names = [f"x{i}" for i in range(size)]

        key = self.key

        def spread(rows: DataFrame) -> DataFrame:
            vector = rows.select(key, "label", vector_to_array("scaled_features").alias("v"))
            return vector.select(key, "label", *(F.col("v")[i].alias(n) for i, n in enumerate(names)))

        found = knn_classify(spread(self.train), spread(df), names, key, k=self.k)
        votes = found.select(key, F.col("prediction").cast("double").alias("prediction"))
        return df.join(votes, key)


def nearest_neighbours(train: DataFrame, k: int = 5, key: str = USER) -> NeighbourModel:
    return NeighbourModel(train, k, key)


# The model plan that is ranked by AUC.
MODEL_PLAN: dict[str, Callable] = {
    "LogisticRegression": balanced_logistic,
    "RandomForestClassifier": random_forest,
    "GradientBoostingClassifier": boosted_trees,
    "SupportVectorClassifier": linear_svc,
    "KNeighborsClassifier": nearest_neighbours,
    "DecisionTreeClassifier": decision_tree,
    "AdaBoostClassifier": real_adaboost,
    "BaggingClassifier": bagging,
    "Gaussian_Naive_Bayes": naive_bayes,
}


#: Models of many rounds or passes that follow one another, the longest first.
STARTED_FIRST = ("AdaBoostClassifier", "GradientBoostingClassifier", "SupportVectorClassifier")


def leaderboard(models: Mapping[str, Callable], prepared: Prepared, parallelism: int = 4) -> DataFrame:
    """Train the models, ``parallelism`` at a time, and rank them by AUC; all are scored in one aggregation.

    Those of many rounds start first, so that the others run beside them and none runs its rounds alone at the end."""
    order = sorted(models, key=lambda name: STARTED_FIRST.index(name) if name in STARTED_FIRST else len(STARTED_FIRST))
    tasks = [lambda fit=models[name]: fit(prepared.train) for name in order]
    fitted = dict(zip(order, run_parallel(tasks, parallelism, prepared.train.sparkSession), strict=True))
    scored = None
    for name in models:
        model = fitted[name]
        guesses = model.transform(prepared.test).select(F.lit(name).alias("model"), "label", "prediction")
        scored = guesses if scored is None else scored.unionByName(guesses)
    return score_metrics(scored, by=["model"]).orderBy(F.desc("AUC"), "model")


def feature_importance(model, features: Sequence[str]) -> DataFrame:
    """Absolute coefficient or tree importance per feature, ascending."""
    if isinstance(model, PipelineModel):
        model = model.stages[-1]
    if hasattr(model, "coefficientMatrix"):
        values = abs(model.coefficientMatrix.toArray()[0])
    elif hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    else:
        values = abs(model.coefficients.toArray())
    rows = [(name, float(value)) for name, value in zip(features, values)]
    return SparkSession.active().createDataFrame(rows, "feature string, importance double").orderBy(
        "importance", "feature"
    )


def _covariance(df: DataFrame, columns: Sequence[str]) -> np.ndarray:
    """Sample covariance of the distinct rows, nulls as 0, divided by population deviations.

    Tasks add up products of columns; the driver sees columns x columns numbers."""
    vectors = materialize(assemble(df.select(*columns).na.fill(0).distinct(), columns).select("features"), "vectors")
    scaler = StandardScaler(inputCol="features", outputCol="x", withMean=True).fit(vectors)
    scaled = MLUtils.convertVectorColumnsFromML(scaler.transform(vectors).select("x"), "x")
    n = vectors.count()
    return RowMatrix(scaled).computeCovariance().toArray() * (n / max(n - 1, 1))


def pca_variance(df: DataFrame, columns: Sequence[str], k: int | None = None) -> DataFrame:
    """(component, ratio): explained-variance ratio of the distinct rows, nulls as 0, columns standardized.

    Constant columns explain nothing; without any variance all ratios are 0."""
    values = np.linalg.eigvalsh(_covariance(df, columns))[::-1].clip(0)
    ratios = values / values.sum() if values.sum() > 0 else values
    rows = [(i + 1, float(v)) for i, v in enumerate(ratios[: k or len(columns)])]
    return SparkSession.active().createDataFrame(rows, "component int, ratio double")


def leading_variance(df: DataFrame, vector: str, k: int, passes: int = 8, extra: int = 8) -> DataFrame:
    """(component, ratio) of the first ``k`` components of wide vectors, without a columns x columns matrix.

    Subspace iteration: each pass multiplies the centred, standardized rows by ``k + extra`` directions and back, so
    a task holds columns x (k + extra) numbers. Ratios come from below and are close where the spectrum falls.
    """
    ship_code(df.sparkSession)
    rows = df.select(vector_to_array(vector).alias("x"))
    found = df.select(Summarizer.metrics("count", "mean", "std").summary(F.col(vector)).alias("m")).first().m
    mean, deviation = found.mean.toArray(), found.std.toArray()
    scale = np.where(deviation > 0, 1 / np.where(deviation > 0, deviation, 1), 0.0)
    width = len(mean)
    basis = np.linalg.qr(np.random.default_rng(42).normal(size=(width, min(width, k + extra))))[0]
    for _ in range(passes):
        product = _times_gram(rows, mean, scale, basis) / max(found["count"] - 1, 1)
        values = np.linalg.eigvalsh((basis.T @ product + product.T @ basis) / 2)[::-1]
        basis = np.linalg.qr(product)[0]
    total = float((scale > 0).sum())
    ratios = [(i + 1, float(v / total) if total else 0.0) for i, v in enumerate(values[:k])]
    return SparkSession.active().createDataFrame(ratios, "component int, ratio double")


def _times_gram(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """The Gram matrix of the standardized rows times ``basis``."""
    width, directions = basis.shape

    def run(batches):
        total = np.zeros((width, directions))
        for batch in batches:
            x = (batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) - mean) * scale
            total += x.T @ (x @ basis)
        lists = pa.ListArray.from_arrays(np.arange(0, total.size + 1, directions, dtype=np.int32), total.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), lists], ["column", "sums"])

    parts = rows.mapInArrow(run, "column int, sums array<double>")
    sums = parts.groupBy("column").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
    out = np.zeros((width, directions))
    for row in sums.collect():  # one row per column
        out[row.column] = row.sums
    return out


def covariance_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_1, column_2, covariance) of the standardized columns of the distinct rows, nulls as 0.

    Columns are divided by their population deviation, the covariance is the sample one, so that the diagonal is
    n / (n - 1)."""
    values = _covariance(df, columns)
    rows = [
        (a, b, float(values[i, j])) for i, a in enumerate(columns) for j, b in enumerate(columns)
    ]
    return SparkSession.active().createDataFrame(rows, "column_1 string, column_2 string, covariance double")

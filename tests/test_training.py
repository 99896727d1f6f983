"""Models on separable points and on the derived log."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ebbline.operators import metrics
from ebbline.plans import training as t


@pytest.fixture(scope="module")
def prepared(spark):
    """200 points in two well separated clouds."""
    rows = [
        (str(i), float(i % 2), (i % 2) * 4.0 + (i % 7) / 7, (i % 2) * 4.0 + (i % 11) / 11, 1.0)
        for i in range(200)
    ]
    df = spark.createDataFrame(rows, "userId string, label double, x double, y double, k double")
    return t.prepare(df, ["x", "y", "k", "absent"])


def auc(scored) -> float:
    return metrics.score_metrics(scored).first().AUC


def test_prepare(prepared):
    assert prepared.features == ["x", "y", "k"]
    train, test = (set(r.userId for r in side.collect()) for side in (prepared.train, prepared.test))
    assert not train & test and len(train | test) == 200 and 20 <= len(test) <= 60


def test_random_split_option(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("userId"), F.lit(1.0).alias("label"), F.rand(1).alias("x"))
    parts = t.prepare(df, random_seed=42)
    assert parts.train.count() + parts.test.count() == 100 and parts.features == ["x"]


@pytest.mark.parametrize(
    "fit",
    [
        t.balanced_logistic,
        t.linear_svc,
        t.naive_bayes,
        t.nearest_neighbours,
        t.decision_tree,
        t.bagging,
        lambda train: t.random_forest(train, trees=5, depth=5),
        lambda train: t.boosted_trees(train, rounds=3),
        lambda train: t.adaboost(train, rounds=3),
        lambda train: t.real_adaboost(train, rounds=3),
    ],
)
def test_models_separate_the_clouds(prepared, fit):
    assert auc(fit(prepared.train).transform(prepared.test)) == 1.0


def test_the_leaderboard_forest_never_holds_all_trees_on_the_driver(prepared, monkeypatch):
    """Parts of few trees are written one by one, and their votes add up to those of the whole forest."""
    asked = []
    real = t.RandomForestClassifier
    monkeypatch.setattr(t, "RandomForestClassifier", lambda **o: asked.append(o["numTrees"]) or real(**o))
    model = t.random_forest(prepared.train, trees=7, depth=2, part=3)
    assert sorted(asked) == [1, 3, 3] and len(model.paths) == 3
    expected: dict = {}
    for path in model.paths:
        part = t.RandomForestClassificationModel.load(path)
        for r in part.transform(prepared.test).collect():
            expected[r.userId] = expected.get(r.userId, 0) + r.rawPrediction.toArray()
    found = model.transform(prepared.test)
    assert found.count() == len(expected) == prepared.test.count()
    for r in found.collect():
        assert r.probability.toArray() == pytest.approx(expected[r.userId] / 7) and r.prediction == expected[r.userId].argmax()


def test_boosting_beats_one_tree(spark):
    """A ring inside a square needs more than one shallow cut."""
    rows = [
        (str(i), float((i * 37 % 101 - 50) ** 2 + (i * 53 % 97 - 48) ** 2 < 900), float(i * 37 % 101), float(i * 53 % 97))
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "userId string, label double, x double, y double")
    parts = t.prepare(df, ["x", "y"])
    one = t.adaboost(parts.train, rounds=1, depth=1)
    many = t.adaboost(parts.train, rounds=12, rate=1.0, depth=1, cut_every=4)
    assert len(many.trees) > 1
    assert auc(many.transform(parts.train)) > auc(one.transform(parts.train))
    real = t.real_adaboost(parts.train, rounds=12, rate=1.0, depth=1, cut_every=4)
    assert len(real.trees) == 12
    assert auc(real.transform(parts.train)) > auc(many.transform(parts.train))


def test_real_boosting_follows_its_formula(spark):
    """Weights and margins of every round, recomputed from the trees in plain Python."""
    rows = [(str(i), float(i % 5 < 2) if i % 7 else 1.0, Vectors.dense([float(i % 5), float(i % 3)])) for i in range(60)]
    train = spark.createDataFrame(rows, ["userId", "label", "scaled_features"]).coalesce(1)
    model = t.real_adaboost(train, rounds=3, rate=0.5, depth=1, cut_every=2)
    assert len(model.trees) == 3
    weights, margin = {r[0]: 1.0 for r in rows}, {r[0]: 0.0 for r in rows}
    for tree in model.trees:
        leaf = {r.userId: r.leaf for r in tree.copy().setLeafCol("leaf").transform(train).collect()}
        for value in set(leaf.values()):
            inside = [r for r in rows if leaf[r[0]] == value]
            ones = sum(weights[i] for i, y, _ in inside if y == 1) / sum(weights[i] for i, _, _ in inside)
            ones = min(max(ones, 2.0**-52), 1 - 2.0**-52)
            for i, y, _ in inside:
                half = math.log(ones / (1 - ones)) / 2
                margin[i] += 0.5 * half
                weights[i] *= math.exp(-0.5 * (2 * y - 1) * half)
    for r in model.transform(train).select("userId", vector_to_array("probability")[1].alias("p")).collect():
        assert r.p == pytest.approx(1 / (1 + math.exp(-2 * margin[r.userId])), abs=1e-9)


def test_rows_of_a_boosting_round_are_kept_for_its_fit(spark, monkeypatch):
    rows = [(float(i % 5 < 2) if i % 7 else 1.0, Vectors.dense([float(i % 5), float(i % 3)])) for i in range(60)]
    train = spark.createDataFrame(rows, ["label", "scaled_features"]).coalesce(1)
    seen = []
    real = t.DecisionTreeClassifier.fit
    monkeypatch.setattr(t.DecisionTreeClassifier, "fit", lambda self, df: seen.append((df, df.storageLevel.useMemory)) or real(self, df))
    t.real_adaboost(train, rounds=5, rate=0.5, depth=1, cut_every=3)
    assert [kept for _, kept in seen] == [True] * 5
    assert not any(df.storageLevel.useMemory for df, _ in seen)


def test_real_boosting_ends_with_a_tree_without_errors(prepared):
    assert len(t.real_adaboost(prepared.train, rounds=10, cut_every=3).trees) == 1


def test_grid_search(prepared):
    model = t.run_plan("logistic_regression", prepared.train, {"regParam": [0.0, 0.1]}, folds=2)
    scores = t.cv_scores(model).collect()
    assert {r.parameters for r in scores} == {"regParam=0.0", "regParam=0.1"}
    scored = t.predictions(model.bestModel, prepared.test)
    assert auc(scored) == 1.0 and scored.filter("probability between 0 and 1").count() == scored.count()
    ranked = t.feature_importance(model.bestModel, prepared.features).collect()
    assert ranked[0].feature == "k" and ranked[0].importance == 0.0


def test_stratified_grid_search(prepared):
    options = {"folds": 3, "stratified": True, "evaluator": t.area_evaluator()}
    model = t.run_plan("glm", prepared.train, {"regParam": [0.01]}, **options)
    assert model.avgMetrics[0] == pytest.approx(1.0)


def test_full_grids_have_the_stated_sizes():
    sizes = {name: len(t.param_grid(plan.estimator(), plan.grid)) for name, plan in t.PLANS.items()}
    assert sizes == {
        "logistic_regression": 12,
        "random_forest": 72,
        "gradient_boost": 4,
        "glm": 36,
        "gbm": 27,
        "distributed_forest": 729,
    }


def test_leaderboard(prepared):
    class Constant:
        def transform(self, df):
            return df.withColumn("prediction", F.lit(0.0))

    models = {"tree": t.decision_tree, "constant": lambda train: Constant()}
    rows = t.leaderboard(models, prepared).collect()
    assert [(r.model, r.AUC) for r in rows] == [("tree", 1.0), ("constant", 0.5)]


def test_balanced_weights(spark):
    df = spark.createDataFrame([(1.0,), (0.0,), (0.0,), (0.0,)], "label double")
    weights = {r.label: r.weight for r in t.with_balanced_weights(df).collect()}
    assert weights == {1.0: 2.0, 0.0: pytest.approx(2 / 3)}


def test_pca_ratios_sum_to_one(spark):
    df = spark.createDataFrame([(1.0, 2.0, 0.5), (2.0, 1.0, 0.1), (3.0, 5.0, 0.9), (4.0, 3.0, 0.2)], "a double, b double, c double")
    ratios = [r.ratio for r in t.pca_variance(df, ["a", "b", "c"]).orderBy("component").collect()]
    assert sum(ratios) == pytest.approx(1.0) and ratios == sorted(ratios, reverse=True)
    assert t.pca_variance(df, ["a", "b", "c"], k=2).count() == 2
    doubled = df.union(df).union(spark.createDataFrame([(None, 2.0, 0.5)], df.schema))
    filled = df.union(spark.createDataFrame([(0.0, 2.0, 0.5)], df.schema))
    assert t.pca_variance(doubled, ["a", "b", "c"]).collect() == t.pca_variance(filled, ["a", "b", "c"]).collect()


def test_leading_components_of_wide_vectors(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=(300, 3)) @ draw.normal(size=(3, 60)) + 0.1 * draw.normal(size=(300, 60))
    x[:, 7] = 4.0
    df = spark.createDataFrame([(Vectors.dense(r),) for r in x], ["v"])
    values = np.linalg.eigvalsh(np.corrcoef(np.delete(x, 7, axis=1).T))[::-1]
    got = [r.ratio for r in t.leading_variance(df, "v", 3).orderBy("component").collect()]
    assert got == pytest.approx(values[:3] / values.sum(), abs=1e-4)


def test_default_features_are_all_numeric_columns(spark, caplog):
    df = spark.createDataFrame([("a", 1, 2, 3.0, 4.0)], "userId string, label int, n long, x double, y float")
    assert t.select_features(df) == ["label", "n", "x", "y"]
    assert "userId" in caplog.text

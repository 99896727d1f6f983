"""Forests that grow together: against Spark's trees, against themselves cut into parts, and what they ask of the driver."""

from dataclasses import replace
from time import sleep

import numpy as np
import pytest
from pyspark.ml.classification import DecisionTreeClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ebbline.operators import metrics
from ebbline.plans import forest_path as fp
from ebbline.plans import search as s
from ebbline.plans import training as t
from ebbline.sources import workers


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """1,500 rows of six columns, one of them constant and one of few values, in three folds."""
    draw = np.random.default_rng(3)
    x = draw.normal(size=(1_500, 6))
    x[:, 4], x[:, 5] = 2.0, draw.integers(0, 3, len(x))
    y = (draw.random(len(x)) < 1 / (1 + np.exp(-3 * (x[:, 0] * x[:, 1] + x[:, 5] - 1)))).astype(float)
    data = [(str(i), float(y[i]), i % 3, Vectors.dense(x[i])) for i in range(len(x))]
    path = str(tmp_path_factory.mktemp("forests") / "rows")
    df = spark.createDataFrame(data, ["userId", "label", "fold", "scaled_features"])
    df.withColumn("fold", F.col("fold").cast("int")).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def likely(model, df) -> np.ndarray:
    """Probability and prediction of each row, by its id."""
    scored = model.transform(df).select("userId", vector_to_array("probability")[1].alias("p"), "prediction")
    return np.array([(r.p, r.prediction) for r in sorted(scored.collect(), key=lambda r: r.userId)])


@pytest.mark.parametrize("impurity,depth,least", [("gini", 30, 1), ("entropy", 6, 5), ("gini", 0, 1)])
def test_a_tree_of_all_rows_is_sparks(rows, impurity, depth, least):
    own = DecisionTreeClassifier(maxDepth=depth, impurity=impurity, minInstancesPerNode=least, **t.COLUMNS).fit(rows)
    grown = fp.fit_alone(rows, fp.Forest(1, depth, least, impurity, every_feature=True, bootstrap=False))
    apart = np.abs(likely(grown, rows) - likely(own, rows)).max(axis=1) > 1e-12
    # Equal gains of entropy differ by the rounding of logarithms, so that either may be chosen.
    assert apart.mean() <= (0.01 if impurity == "entropy" else 0)
    if impurity == "gini":
        assert grown.featureImportances.toArray() == pytest.approx(own.featureImportances.toArray(), abs=1e-9)


def test_large_nodes_are_split_by_all_tasks_into_the_same_trees(rows, monkeypatch):
    forest = fp.Forest(5, 12, least_rows=2)
    whole = likely(fp.fit_alone(rows, forest), rows)
    monkeypatch.setattr(fp, "NODE_ROWS", 150)
    monkeypatch.setattr(fp, "ROWS_AT_ONCE", 3_000)
    parted = fp.fit_alone(rows, forest)
    assert len(parted.paths) == 3 and likely(parted, rows) == pytest.approx(whole, abs=1e-12)


def test_points_share_the_trees_of_the_largest_forest(spark, rows):
    points = [fp.Forest(n, d, held_out=f) for n in (2, 5) for d in (3, 8) for f in (0, 2)]
    blocks = fp.blocks_of(rows, [0, 2], 32, "fold")
    grown = []
    real = fp.grow
    try:
        fp.grow = lambda b, members: grown.extend(members) or real(b, members)
        scored = fp.held_out_scores(blocks, spark, points).collect()
        for i in (0, 3, 6):
            single = fp.fit(blocks, spark, points[i])
            held = rows.filter(F.col("fold") == points[i].held_out)
            assert sorted(likely(single, held)[:, 0]) == pytest.approx(sorted(r.probability for r in scored if r.problem == i))
    finally:
        fp.grow = real
        blocks.state.unpersist()
    assert len(grown) == 2 * 5 + sum(points[i].trees for i in (0, 3, 6))


def test_a_forest_grid_of_many_rows_takes_few_jobs(rows, monkeypatch, tmp_path):
    """Own fits take jobs for each level, whose traces fill the driver."""
    monkeypatch.setattr(fp, "LEAST_ROWS", 1_000)
    context, train = rows.sparkSession.sparkContext, rows.drop("fold")
    grid = {"numTrees": [3, 6], "maxDepth": [4, 9], "minInstancesPerNode": [1, 5], "featureSubsetStrategy": ["auto", "sqrt"], "impurity": ["gini"]}
    context.setJobGroup("forest-grid", "")
    options = {"folds": 2, "state_path": str(tmp_path / "state")}
    try:
        found = t.run_plan("random_forest", train, grid, "userId", **options)
        jobs = len(context.statusTracker().getJobIdsForGroup("forest-grid"))
        again = t.run_plan("random_forest", train, grid, "userId", **options)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    # Spark's forests took over 300.
    assert found.scores.shape == (16, 2) and jobs < 60
    assert (again.scores == found.scores).all() and (found.scores[0] == found.scores[1]).all()
    monkeypatch.setattr(fp, "LEAST_ROWS", 10_000)
    own = t.run_plan("random_forest", train, grid, "userId", folds=2)
    assert np.abs(found.scores - own.scores).mean() < 0.03
    assert metrics.score_metrics(t.predictions(found.bestModel, rows, "userId")).first().AUC > 0.8


def test_forests_that_sample_are_fitted_by_spark():
    point = {"numTrees": 3, "maxDepth": 4}
    assert s.forest_of(RandomForestClassifier(), point, 1) == fp.Forest(3, 4, seed=RandomForestClassifier().getSeed(), held_out=1)
    assert s.forest_of(RandomForestClassifier(), {**point, "numTrees": 1}, 1).every_feature
    for other in ({"subsamplingRate": 0.5}, {"minInfoGain": 0.1}, {"featureSubsetStrategy": "0.7"}, {"weightCol": "w"}):
        assert s.forest_of(RandomForestClassifier(**other), point, 1) is None


@pytest.mark.parametrize("fit", [lambda d: t.random_forest(d, 30, 8), lambda d: t.bagging(d, 5), t.decision_tree])
def test_models_of_many_rows_grow_here(rows, monkeypatch, fit):
    monkeypatch.setattr(fp, "LEAST_ROWS", 1_000)
    model = fit(rows)
    assert isinstance(model, fp.GrownForest)
    assert metrics.score_metrics(t.predictions(model, rows, "userId")).first().AUC > 0.85


def test_models_of_many_rounds_start_first(rows):
    class Constant:
        def transform(self, df):
            return df.withColumn("prediction", F.lit(0.0))

    begun = []
    models = {name: lambda train, name=name: begun.append(name) or Constant() for name in t.MODEL_PLAN}
    found = t.leaderboard(models, t.Prepared(rows, rows, []), parallelism=1).collect()
    assert begun[:2] == ["AdaBoostClassifier", "GradientBoostingClassifier"] and sorted(begun) == sorted(t.MODEL_PLAN)
    assert [r.model for r in found] == sorted(t.MODEL_PLAN)


def test_threads_ship_the_code_once(spark, monkeypatch):
    """Spark refuses a second file of one name from another folder."""
    added = []
    monkeypatch.setattr(workers, "_shipped", set())
    monkeypatch.setattr(type(spark.sparkContext), "addPyFile", lambda self, path: sleep(0.2) or added.append(path))
    s.run_parallel([lambda: workers.ship_code(spark)] * 4, 4, spark)
    assert len(added) == 1


def test_draws_are_spread(rows):
    forest = fp.Forest(1)
    block = fp.Block(7, np.ones(20_000, bool), np.arange(20_000) % 4, {}, {})
    drawn = block.drawn(forest, 3)
    assert (drawn == block.drawn(forest, 3)).all() and (drawn != block.drawn(forest, 4)).any()
    assert drawn.mean() == pytest.approx(1, abs=0.03) and (drawn == 0).mean() == pytest.approx(np.exp(-1), abs=0.02)
    assert not block.drawn(replace(forest, held_out=2), 3)[2::4].any()
    chosen = fp._features(fp._children(np.arange(4_000, dtype=np.uint64)).ravel(), 10, forest)
    assert chosen.shape == (8_000, 4) and (np.diff(chosen, axis=1) > 0).all()
    assert np.bincount(chosen.ravel()) / 8_000 == pytest.approx(np.full(10, 0.4), abs=0.03)

"""Whole grid searches: shared passes, prefixes of boosted fits, and searches that go on after a stop."""

from threading import Barrier

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from ebbline.plans import boosted_path as bp
from ebbline.plans import logistic_path as lp
from ebbline.plans import search as s
from ebbline.plans import training as t

COLUMNS = {"labelCol": "label", "featuresCol": "scaled_features"}


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    """1,200 rows of six columns, one of them constant, in three folds."""
    draw = np.random.default_rng(11)
    x = draw.normal(size=(1_200, 6)) * [1, 3, 0.2, 1, 1, 0] + [0, 1, 0, 0, 5, 2]
    x[:, 3] = x[:, 0] * 0.5 + x[:, 3]
    likely = 1 / (1 + np.exp(-(x[:, 0] - 0.7 * x[:, 1] + 4 * x[:, 2] - 0.5)))
    y = (draw.random(1_200) < likely).astype(float)
    data = [(str(i), float(y[i]), i % 3, Vectors.dense(x[i])) for i in range(len(x))]
    path = str(tmp_path_factory.mktemp("search") / "rows")
    df = spark.createDataFrame(data, ["userId", "label", "fold", "scaled_features"])
    df.withColumn("fold", F.col("fold").cast("int")).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


GRID = [(0.0, 0.0), (0.01, 0.0), (1e-3, 1.0), (0.05, 0.5), (1.0, 1.0), (0.3, 0.2)]


def test_shared_passes_give_the_coefficients_of_single_fits(rows):
    problems = [lp.Problem(strength, mix, held_out=fold) for strength, mix in GRID for fold in (0, 2, lp.NOBODY)]
    models = lp.fit_path(rows, problems)
    for problem, model in zip(problems, models, strict=True):
        single = LogisticRegression(
            family="binomial", regParam=problem.strength, elasticNetParam=problem.mix, maxIter=1_000, tol=1e-13, **COLUMNS
        ).fit(rows.filter(F.col("fold") != problem.held_out))
        assert model.coefficients.toArray() == pytest.approx(single.coefficients.toArray(), abs=1e-4)
        assert model.intercept == pytest.approx(single.intercept, abs=1e-4)
        assert model.coefficients[5] == 0.0 and 0 < model.steps < 30


def test_scores_follow_the_model(rows):
    problems = [lp.Problem(0.01, 0.5, held_out=f) for f in range(3)]
    models = lp.fit_path(rows, problems)
    scored = lp.held_out_scores(rows, models, problems)
    areas = {r.problem: r.score for r in s.area(scored, ["problem"]).collect()}
    f1 = {r.problem: r.score for r in s.weighted_f1(scored, ["problem"]).collect()}
    for fold, model in enumerate(models):
        held = model.transform(rows.filter(F.col("fold") == fold))
        assert areas[fold] == pytest.approx(
            BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0).evaluate(held), abs=1e-12
        )
        assert f1[fold] == pytest.approx(MulticlassClassificationEvaluator().evaluate(held), abs=1e-12)


def test_paths_of_odd_rows(spark, rows):
    one_label = rows.filter("label = 1")
    sure, = lp.fit_path(one_label, [lp.Problem()])
    assert sure.intercept == float("inf") and not sure.coefficients.toArray().any()
    assert sure.transform(one_label).filter("prediction = 1").count() == one_label.count()
    none, = lp.fit_path(rows.limit(0), [lp.Problem()])
    assert none.intercept == 0.0 and len(none.coefficients) == 0
    # Columns that depend on each other: probabilities are unique although coefficients are not.
    twice = rows.withColumn("a", vector_to_array("scaled_features"))
    from pyspark.ml.functions import array_to_vector

    twice = twice.withColumn("scaled_features", array_to_vector(F.concat("a", F.slice("a", 1, 2)))).drop("a")
    plain, double = lp.fit_path(rows, [lp.Problem()])[0], lp.fit_path(twice, [lp.Problem()])[0]

    def odds(model, df):
        return [r.p[1] for r in model.transform(df).orderBy("userId").select(vector_to_array("probability").alias("p")).collect()]

    assert odds(double, twice) == pytest.approx(odds(plain, rows), abs=1e-6)
    # Rows that a line separates: no finite best, the steps end at their limit or at a loss of nothing.
    apart = rows.withColumn("label", (vector_to_array("scaled_features")[0] > 0).cast("double"))
    model, = lp.fit_path(apart, [lp.Problem(max_iter=15)])
    assert model.steps <= 15 and model.transform(apart).filter("prediction <> label").count() == 0


def test_a_grid_is_read_a_few_times_however_large(rows, monkeypatch):
    passes = []
    real = lp._sums
    monkeypatch.setattr(lp, "_sums", lambda *a: passes.append(len(a[2])) or real(*a))
    lp.fit_path(rows, [lp.Problem(r, e, held_out=f) for r in (1e-4, 1e-2, 0.1) for e in (0.0, 0.5, 1.0) for f in range(3)])
    assert passes[0] == 27 and len(passes) <= 15


def test_first_rounds_are_the_shorter_fit(rows):
    long = GBTClassifier(maxIter=6, maxDepth=3, stepSize=0.2, seed=42, **COLUMNS).fit(rows)
    for rounds in (1, 4, 6):
        short = GBTClassifier(maxIter=rounds, maxDepth=3, stepSize=0.2, seed=42, **COLUMNS).fit(rows)
        cut = s.first_rounds(long, rounds)
        assert cut.getNumTrees == rounds
        got, expected = (
            [r.p for r in m.transform(rows).orderBy("userId").select(vector_to_array("probability").alias("p")).collect()]
            for m in (cut, short)
        )
        assert got == expected


def test_boosted_grid_scores_are_those_of_own_fits(rows):
    grid = {"stepSize": [0.1, 0.3], "maxIter": [2, 5], "maxDepth": [2]}
    found = s.search(lambda: GBTClassifier(seed=42, **COLUMNS), grid, rows.drop("fold"), "userId", 2, "auc", rounds="maxIter")
    assert found.points == s.grid_points(grid) and found.scores.shape == (4, 2)
    folded = s.with_folds(rows.drop("fold"), "userId", 2)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="probability", numBins=0)
    for point, scores in zip(found.points, found.scores, strict=True):
        for fold in range(2):
            model = GBTClassifier(seed=42, **point, **COLUMNS).fit(folded.filter(F.col("fold") != fold))
            expected = evaluator.evaluate(model.transform(folded.filter(F.col("fold") == fold)))
            assert scores[fold] == pytest.approx(expected, abs=0.02)
    assert found.bestModel.getNumTrees == found.best["maxIter"]


@pytest.mark.parametrize("node_rows", [8_192, 100])
def test_shared_rounds_give_the_trees_of_single_fits(rows, monkeypatch, node_rows):
    """Whether nodes are grown by one task or split by sums of all tasks."""
    monkeypatch.setattr(bp, "NODE_ROWS", node_rows)
    monkeypatch.setattr(bp, "PARTITION_ROWS", 2_000 if node_rows > 1_200 else 300)
    monkeypatch.setattr(bp, "CUT_EVERY", 3)
    problems = [bp.Problem(0.1, 3, 7, 0), bp.Problem(0.3, 2, 5, 1), bp.Problem(0.3, 4, 4), bp.Problem(0.1, 0, 2)]
    scored, models = bp.fit_path(rows, problems, [2, 4, 5, 7], "userId")
    assert models[:2] == [None, None] and [m.getNumTrees for m in models[2:]] == [4, 2]

    def single(p, length):
        estimator = GBTClassifier(seed=42, stepSize=p.step, maxDepth=p.depth, maxIter=length, **COLUMNS)
        return estimator.fit(rows.filter(F.col("fold") != p.held_out))

    def likely(model, df):
        scored = model.transform(df).select("userId", "prediction", vector_to_array("probability")[1].alias("p"))
        return {r.userId: (r.p, r.prediction) for r in scored.collect()}

    found = {}
    for r in scored.collect():
        found.setdefault((r.problem, r.length), []).append(r.probability)
    assert set(found) == {(0, 2), (0, 4), (0, 5), (0, 7), (1, 2), (1, 4), (1, 5)}
    for (i, length), values in found.items():
        expected = likely(single(problems[i], length), rows.filter(F.col("fold") == problems[i].held_out))
        assert sorted(values) == pytest.approx(sorted(p for p, _ in expected.values()), abs=1e-9)
    for p, model in zip(problems[2:], models[2:], strict=True):
        own = single(p, p.rounds)
        assert model.featureImportances.toArray() == pytest.approx(own.featureImportances.toArray(), abs=1e-9)
        got, expected = likely(model, rows), likely(own, rows)
        assert {k: v for k, (_, v) in got.items()} == {k: v for k, (_, v) in expected.items()}
        assert [got[k][0] for k in sorted(got)] == pytest.approx([expected[k][0] for k in sorted(got)], abs=1e-9)


def test_thresholds_of_few_and_many_values():
    assert bp.thresholds_of(np.array([3.0, 1.0, 1.0]), 32).tolist() == [2.0]
    assert bp.thresholds_of(np.full(9, 2.0), 32).tolist() == []
    assert bp.thresholds_of(np.arange(100.0), 4).tolist() == [24.5, 49.5, 74.5]


def test_a_boosted_grid_takes_a_few_jobs_a_round_however_many_points(rows, tmp_path):
    context, train = rows.sparkSession.sparkContext, rows.drop("fold")
    grid = {"stepSize": [0.1, 0.2, 0.3], "maxIter": [4, 12], "maxDepth": [2, 3]}
    context.setJobGroup("boosted-grid", "")
    try:
        options = {"folds": 2, "metric": "auc", "state_path": str(tmp_path / "state")}
        found = t.run_plan("gbm", train, grid, "userId", **options)
        first = len(context.statusTracker().getJobIdsForGroup("boosted-grid"))
        again = t.run_plan("gbm", train, grid, "userId", **options)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    # Own fits would be 12 of 12 rounds, each of three jobs or more.
    assert found.scores.shape == (12, 2) and first < 80
    assert (again.scores == found.scores).all() and again.best == found.best


def test_only_plain_boosting_grows_in_shared_rounds():
    names = ["stepSize", "maxIter", "maxDepth"]
    assert s.shares_rounds(GBTClassifier(seed=42, **COLUMNS), names)
    assert not s.shares_rounds(GBTClassifier(subsamplingRate=0.5), names)
    assert not s.shares_rounds(GBTClassifier(weightCol="w"), names)
    assert not s.shares_rounds(GBTClassifier(), [*names, "minInfoGain"])
    assert not s.shares_rounds(RandomForestClassifier(), ["maxDepth"])


def test_a_stopped_search_goes_on(rows, tmp_path, monkeypatch):
    state, train = str(tmp_path / "state"), rows.drop("fold")
    grid = {"numTrees": [2, 3], "maxDepth": [2, 4]}
    options = {"folds": 2, "state_path": state, "parallelism": 1}
    fits = []
    real = s._fitted

    def fitted(estimator, parameters, df):
        if len(fits) == 3:
            raise RuntimeError("driver lost")
        fits.append(parameters)
        return real(estimator, parameters, df)

    def forest():
        return RandomForestClassifier(seed=42, **COLUMNS)

    monkeypatch.setattr(s, "_fitted", fitted)
    with pytest.raises(RuntimeError):
        s.search(forest, grid, train, "userId", **options)
    monkeypatch.setattr(s, "_fitted", lambda *a: fits.append(a[1]) or real(*a))
    found = s.search(forest, grid, train, "userId", **options)
    assert len(fits) == 8 + 1  # every fit once, and the best one on all rows
    again = s.search(forest, grid, train, "userId", **options)
    assert len(fits) == 10 and (again.scores == found.scores).all()
    # Other rows or another metric are another search.
    s.search(forest, {"numTrees": [2], "maxDepth": [2]}, train.limit(900), "userId", **options)
    s.search(forest, {"numTrees": [2], "maxDepth": [2]}, train, "userId", metric="auc", **options)
    assert len(fits) == 10 + 3 + 3


def test_points_that_ask_for_the_same_forest_are_fitted_once(rows, monkeypatch):
    fits = []
    real = s._fitted
    monkeypatch.setattr(s, "_fitted", lambda *a: fits.append(a[1]) or real(*a))
    grid = {"numTrees": [1, 3], "maxDepth": [3], "featureSubsetStrategy": ["auto", "sqrt"]}
    found = t.run_plan("random_forest", rows.drop("fold"), grid, key="userId", folds=2)
    assert found.scores.shape == (4, 2) and (found.scores[2] == found.scores[3]).all()
    # One tree sees all features by "auto"; the best point is fitted once more.
    assert len(fits) == 3 * 2 + 1
    auto, root = (real(t.PLANS["random_forest"].estimator, {"numTrees": 3, "featureSubsetStrategy": w}, rows) for w in ("auto", "sqrt"))
    assert auto.toDebugString.split("\n", 1)[1] == root.toDebugString.split("\n", 1)[1]


def test_plans_rank_by_their_own_metric_and_folds():
    assert {n: (p.metric, p.folds, p.stratified) for n, p in t.PLANS.items()} == {
        "logistic_regression": ("f1", 4, False),
        "random_forest": ("f1", 4, False),
        "gradient_boost": ("f1", 3, False),
        "glm": ("auc", 3, False),
        "gbm": ("auc", 3, False),
        "distributed_forest": ("auc", 5, True),
    }


def test_whole_logistic_plans(rows):
    train = rows.drop("fold")
    plain, net = t.run_plan("logistic_regression", train, key="userId"), t.run_plan("glm", train, key="userId")
    assert plain.scores.shape == (12, 4) and net.scores.shape == (36, 3)
    assert plain.best["regParam"] in (0.0, 0.001, 0.01) and max(net.avgMetrics) > 0.85
    names = {r.parameters for r in t.cv_scores(net).collect()}
    assert len(names) == 36 and "elasticNetParam=0.2, regParam=0.01" in names


def test_parallel_fits_have_their_own_local_properties(spark):
    """Fits that share them lose the id of their query when another one ends ("Cannot parse null string")."""
    context, meet = spark.sparkContext, Barrier(3, timeout=60)

    def task(i):
        def run():
            context.setLocalProperty("ebbline.fit", str(i))
            meet.wait()
            return context.getLocalProperty("ebbline.fit")

        return run

    assert s.run_parallel([task(i) for i in range(3)], 3, spark) == ["0", "1", "2"]


def test_folds_follow_the_key(spark):
    df = spark.createDataFrame([(f"u{k}", float(k % 4 == 0)) for k in range(400)], "k string, label double")
    first, second = (
        {r.k: r.fold for r in s.with_folds(d, "k", 4).collect()} for d in (df, df.repartition(7).orderBy(F.rand()))
    )
    assert first == second and set(first.values()) == set(range(4))
    even = s.with_folds(df, "k", 4, stratified=True).groupBy("fold").agg(F.sum("label").alias("ones"), F.count("*").alias("n"))
    assert {(r.ones, r.n) for r in even.collect()} == {(25.0, 100)}

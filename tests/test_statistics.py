"""Order statistics, distributions, correlations and metrics against plain recomputation."""

import datetime
import math
import random
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import MinMaxScaler
from pyspark.sql import functions as F

from ebbline.functions.columns import double_order
from ebbline.operators import clean, metrics, neighbours, profile, ranking, transform
from ebbline.operators import correlation as corr


def numbers(spark, values, name="x", kind="double"):
    return spark.createDataFrame([(v,) for v in values], f"{name} {kind}")


@pytest.mark.parametrize("group_rows", [1, 20, 1 << 16])
def test_quantiles_for_any_group_size(spark, group_rows):
    rng = random.Random(3)
    values = [rng.choice([0.0, 1.0, rng.gauss(0, 1), rng.lognormvariate(0, 5)]) for _ in range(500)]
    counts = numbers(spark, values, "value").groupBy("value").agg(F.count("*").alias("n"))
    wanted = {"a": 0.0, "b": 0.01, "c": 0.25, "d": 0.5, "e": 0.99, "f": 1.0}
    row = ranking.exact_quantiles(counts, wanted, group_rows=group_rows).first()
    for name, p in wanted.items():
        assert row[name] == pytest.approx(pd.Series(values).quantile(p), rel=1e-12)


def test_quantiles_when_one_value_holds_most_rows(spark):
    values = [5.0] * 900 + [float(i) for i in range(100)]
    row = profile.quantiles(numbers(spark, values), ["x"], {"m": 0.5, "h": 0.97}).first()
    assert row.m == 5.0 and row.h == pytest.approx(pd.Series(values).quantile(0.97))


@pytest.mark.parametrize("group_rows", [1, 8, 1 << 16])
def test_running_totals(spark, group_rows):
    values = random.Random(1).sample(range(-10000, 10000), 300)
    df = numbers(spark, values, "v", "int").withColumn("one", F.lit(1))
    rows = ranking.running_totals(df, "v", {"one": "rank"}, group_rows=group_rows).collect()
    assert [r.v for r in sorted(rows, key=lambda r: r["rank"])] == sorted(values)
    assert sorted(r["rank"] for r in rows) == list(range(1, 301))


def test_index_select(spark):
    df = spark.range(0, 1000).select((F.col("id") * 3).alias("k"), F.lit("x").alias("s")).repartition(5)
    got = clean.index_select(df, [0, 7, 999, 5000], "k").collect()
    assert sorted(r.k for r in got) == [0, 21, 2997]
    assert clean.index_select(df.limit(0), [0], "k").collect() == []


def test_double_order_keeps_the_order(spark):
    rng = random.Random(7)
    values = [struct.unpack("<d", rng.randbytes(8))[0] for _ in range(3_000)]
    values = [v for v in values if not math.isnan(v)]
    values += [s * 2.0**e * f for s in (1, -1) for e in range(-1074, 1024, 3) for f in (1, 1 + 2**-52, 2 - 2**-52) if math.isfinite(2.0**e * f)]
    values += [0.0, -0.0, 5e-324, -5e-324, math.inf, -math.inf, 1.7976931348623157e308, 2.2250738585072014e-308, math.nan]
    got = numbers(spark, values).select("x", double_order(F.col("x")).alias("k")).collect()
    for row in got:
        if math.isnan(row.x):
            assert row.k > 2047 << 52
        else:
            bits = struct.unpack("<q", struct.pack("<d", abs(row.x)))[0]
            assert row.k == (-bits if row.x < 0 else bits)


def skewed(spark, rows):
    """Nearly all values share their leading bits; some lie far away."""
    near = spark.range(rows).select((1 + F.col("id") * 2.0**-50).alias("value"))
    far = spark.range(200).select((F.pow(F.lit(-3.0), F.col("id"))).alias("value"))
    return near.union(far).distinct().withColumn("n", F.lit(1).cast("long"))


def test_no_group_is_larger_than_asked_for(spark):
    df = skewed(spark, 40_000).cache()
    rows = ranking.grouped(df, "value", ["n"], group_rows=500)
    sizes = rows.groupBy("_shift", "_group").agg(F.count("*").alias("rows"), F.min("value").alias("low"), F.max("value").alias("high"))
    found = sizes.collect()
    assert max(r.rows for r in found) <= 500 and sum(r.rows for r in found) == df.count()
    # Groups do not overlap, so ordering inside them orders everything.
    found.sort(key=lambda r: r.low)
    assert all(a.high < b.low for a, b in zip(found, found[1:]))
    totals = ranking.running_totals(df, "value", {"n": "rank"}, group_rows=500)
    assert [r["rank"] for r in totals.orderBy("value").collect()] == list(range(1, df.count() + 1))
    df.unpersist()


def test_ranks_of_skewed_values_by_group(spark):
    df = skewed(spark, 5_000).withColumn("g", F.pmod(F.hash("value"), F.lit(2))).cache()
    expected = {g: sorted(r.value for r in df.filter(F.col("g") == g).collect()) for g in (0, 1)}
    wanted = [(g, k) for g in (0, 1) for k in (0, 17, 2_000, len(expected[g]) - 1, 10**6)]
    ranks = spark.createDataFrame(wanted, "g int, rank long")
    for group_rows in (1, 300, 1 << 16):
        got = {(r.g, r["rank"]): r.value for r in ranking.select_ranks(df, ranks, ["g"], group_rows).collect()}
        assert got == {(g, k): expected[g][k] for g, k in wanted if k < len(expected[g])}
    df.unpersist()


def test_ranks_of_dates_and_text(spark):
    df = spark.createDataFrame([(datetime.date(2020, 1, k),) for k in (5, 3, 9)], "d date")
    assert [r.d.day for r in clean.index_select(df, [1], "d").collect()] == [5]
    with pytest.raises(TypeError, match="string"):
        clean.index_select(df.select(F.col("d").cast("string")), [0], "d")


def test_describe_matches_pandas(spark):
    values = [1.0, 2.0, 3.0, 10.0, 50.0]
    row = profile.describe(numbers(spark, values), ["x"]).first()
    expected = pd.Series(values).describe()
    assert list(row)[1:] == pytest.approx(
        [expected[k] for k in ("count", "mean", "std", "min", "25%", "50%", "75%", "max")]
    )


def test_skew(spark):
    df = spark.createDataFrame(
        [(1.0, 4.0, None), (2.0, 4.0, None), (3.0, 4.0, None), (10.0, 4.0, 1.0), (50.0, 4.0, 2.0)],
        "x double, k double, few double",
    )
    skew = {r.column: r.skew for r in profile.feature_skew(df, ["x", "k", "few"]).collect()}
    assert skew["x"] == pytest.approx(2.0855561345300138) and skew["k"] == 0.0 and skew["few"] is None


def test_winsorize(spark):
    values = [1.0, 2.0, 3.0, 10.0, 50.0, None]
    clipped = transform.winsorize(numbers(spark, values), ["x"]).collect()
    series = pd.Series(values[:5])
    got = sorted(r.x_clipped for r in clipped if r.x is not None)
    assert got[0] == pytest.approx(1.04) and got[-1] == pytest.approx(series.quantile(0.99))
    assert [r.x_clipped for r in clipped if r.x is None] == [None]


def test_log_and_clip_only_clips_logged_names(spark):
    df = numbers(spark, [0.0, 1.0, 2.0, 30.0], "plays_log")
    assert "plays_log_logClip" in transform.log_and_clip(df, ["plays_log"]).columns
    row = transform.log_and_clip(df, ["plays_log"]).orderBy("plays_log").collect()[-1]
    assert row.plays_log_logClip == pytest.approx(pd.Series([0, 1, 2, 30]).quantile(0.99))


def test_correlations_pairwise_complete(spark):
    rng = np.random.default_rng(0)
    frame = pd.DataFrame({"a": rng.normal(1e6, 1, 200), "b": rng.normal(0, 1e-3, 200)})
    frame["c"] = frame.a + frame.b * 500
    frame["k"] = 3.0
    frame.loc[::7, "a"] = np.nan
    frame.loc[::5, "b"] = np.nan
    rows = [tuple(None if np.isnan(v) else float(v) for v in r) for r in frame.to_numpy()]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    expected = frame.corr()
    for row in corr.correlations(df, ["a", "b", "c", "k"]).collect():
        want = expected.loc[row.column_1, row.column_2]
        if np.isnan(want):
            assert row.r is None
        else:
            assert row.r == pytest.approx(want, abs=1e-9)


def test_null_structure(spark):
    df = spark.createDataFrame([(1, None, None), (2, "x", None), (None, None, 3)], "a int, b string, c int")
    edges = {(r.src, r.dst): r.n_rows for r in profile.null_cooccurrence(df).collect()}
    assert edges == {
        ("a", "a"): 1, ("a", "b"): 1, ("b", "a"): 1, ("b", "b"): 2, ("b", "c"): 1, ("c", "b"): 1, ("c", "c"): 2,
    }
    nodes = profile.null_edges(df.select("a", F.lit(1).alias("full"))).collect()
    assert {(r.src, r.dst) for r in nodes} == {("a", "a"), ("full", None)}
    counted = {r.column: (r.unique_count, r.null_count) for r in profile.null_profile(df).collect()}
    assert counted == {"a": (2, 1), "b": (1, 2), "c": (1, 2)}
    with_null = {r.column: r.unique_count for r in profile.null_profile(df, count_null=True).collect()}
    assert with_null == {"a": 3, "b": 2, "c": 2}
    sketched = {r.column: r.unique_count for r in profile.null_profile(df, approximate=True).collect()}
    assert sketched == {"a": 2, "b": 1, "c": 1}


def test_histogram_matches_numpy(spark):
    values = [0.0, 1.0, 1.5, 2.0, 9.0, 10.0, 10.0]
    counts, ends = np.histogram(values, bins=10)
    rows = sorted(profile.histogram(numbers(spark, values), ["x"]).collect(), key=lambda r: r.bin)
    assert [r["count"] for r in rows] == list(counts)
    assert [r.bin_start for r in rows] == pytest.approx(list(ends[:-1]))
    constant = profile.histogram(numbers(spark, [4.0, 4.0]), ["x"]).collect()
    assert sum(r["count"] for r in constant) == 2 and len(constant) == 10


def test_minmax_matches_the_ml_scaler(spark):
    rows = [(1.0, 5.0), (2.0, 5.0), (4.0, 5.0)]
    df = spark.createDataFrame(rows, "x double, k double")
    ours = [(r.x_scaled, r.k_scaled) for r in transform.minmax_scale(df, ["x", "k"]).orderBy("x").collect()]
    vectors = transform.assemble(df, ["x", "k"])
    model = MinMaxScaler(inputCol="features", outputCol="s").fit(vectors)
    theirs = [tuple(r.s.toArray()) for r in model.transform(vectors).orderBy("x").collect()]
    assert np.array(ours) == pytest.approx(np.array(theirs))


def test_assemble_needs_columns(spark):
    with pytest.raises(ValueError):
        transform.assemble(spark.range(1), [])


def test_vector_kinds(spark):
    from pyspark.ml.linalg import Vectors

    rows = [(Vectors.dense([1.0, 2.0]),), (Vectors.sparse(2, {0: 1.0}),), (Vectors.sparse(2, {}),)]
    kinds = transform.vector_kinds(spark.createDataFrame(rows, ["features"]))
    assert {r.kind: r["count"] for r in kinds.collect()} == {"dense": 1, "sparse": 2}


def test_stratified_folds_are_even(spark):
    df = spark.range(0, 503).select(F.col("id").cast("string").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("label"))
    sizes = transform.stratified_folds(df, "k").groupBy("label", "fold").count().collect()
    for label in (0, 1):
        counts = [r["count"] for r in sizes if r.label == label]
        assert len(counts) == 5 and max(counts) - min(counts) <= 1


def test_one_class_metrics(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (0, 0)], "label int, prediction int")
    row = metrics.score_metrics(df).first()
    assert (row.precision, row.recall, row.f1, row.f2) == (0, 0, 0, 0)
    assert row.specificity == 1 and row.AUC == 0.5 and row.accuracy == pytest.approx(2 / 3)


def test_hard_auc_is_mean_of_class_rates(spark):
    rng = random.Random(0)
    df = spark.createDataFrame([(rng.randint(0, 1), rng.randint(0, 1)) for _ in range(99)], "label int, prediction int")
    row = metrics.score_metrics(df).first()
    assert row.AUC == pytest.approx((row.recall + row.specificity) / 2)


def test_validation_report(spark):
    rng = random.Random(5)
    rows = [(float(rng.random() < p), p) for p in (round(rng.uniform(0.01, 0.99), 2) for _ in range(400))]
    df = spark.createDataFrame(rows, "label double, probability double")
    row = metrics.validation_report(df, predictors=35).first()
    for metric, value in (("areaUnderROC", row.AUC), ("areaUnderPR", row.AUCPR)):
        evaluator = BinaryClassificationEvaluator(
            rawPredictionCol="probability", labelCol="label", metricName=metric, numBins=0
        )
        assert value == pytest.approx(evaluator.evaluate(df), abs=1e-9)
    assert row.Gini == pytest.approx(2 * row.AUC - 1) and row.RMSE**2 == pytest.approx(row.MSE)
    assert row.residual_deviance == pytest.approx(2 * row.n * row.LogLoss)
    assert row.AIC == pytest.approx(row.residual_deviance + 2 * 36)
    assert (row.null_dof, row.residual_dof) == (399, 364)
    rate = sum(label for label, _ in rows) / 400
    assert row.null_deviance == pytest.approx(-2 * 400 * (rate * math.log(rate) + (1 - rate) * math.log(1 - rate)))


def test_best_thresholds(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.7), (0, 0.1)], "label int, probability double")
    best = {r.metric: (r.threshold, r.value) for r in metrics.best_thresholds(df).collect()}
    assert best == {"F1": (0.8, 1.0), "F2": (0.8, 1.0)}


@pytest.mark.parametrize("seed", range(3))
def test_knn_equals_brute_force(spark, seed):
    rng = random.Random(seed)

    def points(n, prefix):
        rows = [(f"{prefix}{i}", rng.randint(0, 1), rng.gauss(0, 3), float(rng.randint(0, 4))) for i in range(n)]
        # A third of the rows are copies of one point.
        return [(k, y, 1.0, 1.0) if i % 3 == 0 else (k, y, a, b) for i, (k, y, a, b) in enumerate(rows)]

    train, test = points(120, "t"), points(40, "q")
    schema = "k string, label int, a double, b double"
    got = neighbours.knn_classify(
        spark.createDataFrame(train, schema), spark.createDataFrame(test, schema), ["a", "b"], "k", block_rows=16
    )

    def vote(q):
        near = sorted(train, key=lambda r: ((r[2] - q[2]) ** 2 + (r[3] - q[3]) ** 2, r[0]))[:5]
        return int(2 * sum(r[1] for r in near) > 5)

    assert {r.k: r.prediction for r in got.collect()} == {q[0]: vote(q) for q in test}


def test_knn_rows_leaving_a_block_are_bounded(spark):
    """In 40 dimensions, with one point far off: at most k rows per query and training block."""
    rng = random.Random(5)
    point = [[rng.random() for _ in range(40)] for _ in range(300)] + [[1e6] * 40]
    train = spark.createDataFrame([(f"t{i:03}", i % 2, x) for i, x in enumerate(point)], "_id string, _label int, _x array<double>")
    test = spark.createDataFrame([(i, x) for i, x in enumerate(point[:50])], "_n long, _q array<double>")
    found = neighbours.block_neighbours(train, test, 3, block_rows=64)
    assert 50 * 3 <= found.count() <= 50 * 5 * 3
    nearest = {r._n: r._id for r in found.where("_square = 0").collect()}
    assert nearest == {i: f"t{i:03}" for i in range(50)}


def test_knn_with_fewer_rows_than_neighbours(spark):
    schema = "k string, label int, a double"
    train = spark.createDataFrame([("a", 1, 0.0), ("b", 0, 9.0), ("c", 1, 9.0)], schema)
    test = spark.createDataFrame([("q", 0, 3.0), ("r", 0, None)], schema)
    got = {r.k: r.prediction for r in neighbours.knn_classify(train, test, ["a"], "k").collect()}
    assert got == {"q": 1, "r": None}


def test_standard_scale_of_a_constant(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 2.0)], "x double, k double")
    rows = transform.standard_scale(df, ["x", "k"]).orderBy("x").collect()
    assert [(r.x_scaled, r.k_scaled) for r in rows] == [(-1.0, 0.0), (1.0, 0.0)]


def test_outliers_skip_two_valued_columns(spark):
    rows = [(0.0, 0.0)] * 30 + [(1.0, 0.0)] * 30 + [(100.0, 1.0)]
    got = profile.outlier_counts(spark.createDataFrame(rows, "x double, flag double"), ["x", "flag"]).collect()
    assert [(r.column, r.outliers, r.total_samples) for r in got] == [("x", 1, 61)]


def test_one_hot(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    categories = {"c": transform.discover_categories(df, "c")}
    rows = transform.one_hot(df, categories).collect()
    assert sorted((r.c_a, r.c_b) for r in rows) == [(0, 0), (0, 1), (1, 0)]
    with pytest.raises(ValueError):
        transform.discover_categories(df, "c", at_most=2)

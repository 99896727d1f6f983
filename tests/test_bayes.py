"""Naive Bayes from sufficient statistics, against Spark's own and against plain Python."""

import math
import random

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ebbline.plans import bayes

NAMES = ["b", "a", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    draw = random.Random(8)
    data = [
        (i, y := draw.randrange(2), i % 3, draw.gauss(y, 1), draw.gauss(-y, 2 + y) if i % 9 else None, 4.0) for i in range(300)
    ]
    return spark.createDataFrame(data, "id int, label int, fold int, a double, b double, c double")


def sums(df):
    return {(r.label, r.column): (r.n, pytest.approx(r.total, abs=1e-9), pytest.approx(r.squares, abs=1e-9)) for r in df.collect()}


def test_statistics_add_and_withdraw(rows):
    whole, first = bayes.statistics(rows, NAMES), bayes.statistics(rows.filter("fold = 0"), NAMES)
    rest = bayes.statistics(rows.filter("fold <> 0"), NAMES)
    assert sums(bayes.added(first, rest)) == sums(whole)
    assert sums(bayes.withdrawn(whole, first)) == sums(rest)
    assert bayes.withdrawn(whole, whole).collect() == []
    parts = bayes.statistics(rows, NAMES, by=["fold"])
    assert sums(bayes.combined(parts)) == sums(whole)
    assert sums(bayes.without_fold(parts, "fold").filter("fold = 0")) == sums(rest)


def test_same_classes_as_the_library(rows):
    model = bayes.fitted(bayes.statistics(rows, NAMES))
    got = {r.id: (r.prediction, r.probability) for r in bayes.classify(rows, model, NAMES).collect()}
    vectors = VectorAssembler(inputCols=NAMES, outputCol="features").transform(rows.na.fill(0.0))
    library = NaiveBayes(modelType="gaussian").fit(vectors).transform(vectors)
    for r in library.select("id", "prediction", vector_to_array("probability")[1].alias("p")).collect():
        assert got[r.id] == (r.prediction, pytest.approx(r.p, abs=1e-6))


def test_models_by_fold_are_models_of_the_other_rows(rows):
    parts = bayes.statistics(rows, NAMES, by=["fold"])
    by_fold = bayes.classify(rows, bayes.fitted(bayes.without_fold(parts, "fold"), ["fold"]), NAMES, ["fold"])
    got = {r.id: r.probability for r in by_fold.collect()}
    assert len(got) == 300
    for fold in range(3):
        model = bayes.fitted(bayes.statistics(rows.filter(F.col("fold") != fold), NAMES))
        for r in bayes.classify(rows.filter(F.col("fold") == fold), model, NAMES).collect():
            assert got[r.id] == pytest.approx(r.probability, abs=1e-9)


def test_a_class_missing_in_a_fold(spark):
    df = spark.createDataFrame([(0, 0, 1.0), (0, 0, 2.0), (1, 1, 5.0), (1, 0, 1.5), (None, 1, 3.0)], "fold int, label int, x double")
    parts = bayes.statistics(df.filter("fold is not null"), ["x"], by=["fold"])
    found = {(r.fold, r.label): (r.n, r.total) for r in bayes.without_fold(parts, "fold").collect()}
    assert found == {(0, 1): (1, 5.0), (0, 0): (1, 1.5), (1, 0): (2, 3.0)}


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, 0, 0.0), (2, 1, 0.0), (3, None, None)], "id int, label int, x double")
    model = bayes.fitted(bayes.statistics(df, ["x"]))
    # Constant columns tell nothing: equal classes, the smaller one wins; nulls count as 0.
    assert [(r.prediction, r.probability) for r in bayes.classify(df, model, ["x"]).orderBy("id").collect()] == [(0, 0.5)] * 3
    assert bayes.fitted(bayes.statistics(df.limit(0), ["x"])).collect() == []
    far = bayes.classify(df.withColumn("x", F.lit(1e6)), model, ["x"]).first()
    assert not math.isnan(far.probability)

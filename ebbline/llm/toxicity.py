"""Toxicity by a linear model over character n-grams scaled by naive Bayes log-count ratios."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import ship, written

#: n-gram lengths, bits of their hash, rows per label the model is fitted on.
LENGTHS = (3, 4, 5)
BITS = 18
SAMPLE_ROWS = 4_000
#: A feature takes part if its count among toxic rows differs from what its total says by so many deviations.
LEAST_DEVIATION = 3.0
LEAST_ROWS = 3


def ngrams(text: str) -> np.ndarray:
    """Hashes of all character n-grams of the lower-case text, in [0, 2^BITS); repeats included."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, state = [], np.zeros(len(points), np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        if len(points) < n:
            break
        state = state[: len(points) - n + 1] * np.uint64(0x9E3779B97F4A7C15) + points[n - 1 :] + np.uint64(n)
        state ^= state >> np.uint64(29)
        if n in LENGTHS:
            out.append(((state * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


@dataclass
class Model:
    """``weights[f]`` is added for each n-gram hash present in a text; the logistic function gives the score."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        found = ngrams(text or "")
        found = np.unique(found[self.weights[found] != 0])
        return float(1 / (1 + np.exp(-np.clip(self.intercept + self.weights[found].sum(), -700, 700))))


def labelled_rows(documents: DataFrame, labels: DataFrame, seed: Column, sample_rows: int) -> DataFrame:
    """``(text, label, weight)``: at most ``sample_rows`` texts of each label, those first by a hash of the id.

    Weights restore the label's share among all labelled rows, so scores stay probabilities.
    """
    known = labels.where(seed & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("double").alias("label"))
    known = written(known, "labels")
    totals = {row.label: row.n for row in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    parts = []
    for label in (0.0, 1.0):
        taken = min(sample_rows, totals.get(label, 0))
        order = [F.xxhash64("doc_id"), F.col("doc_id")]
        part = known.where(F.col("label") == label).orderBy(*order).limit(sample_rows)
        parts.append(part.withColumn("weight", F.lit(totals.get(label, 0) / max(taken, 1))))
    chosen = reduce(DataFrame.unionByName, parts).withColumnRenamed("doc_id", "labelled_id")
    texts = documents.select("doc_id", "text")
    return texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled_id")).select("text", "label", "weight")


def fit(documents: DataFrame, labels: DataFrame, seed: Column, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model of ``labels.toxic`` from the texts of labelled rows for which ``seed`` holds.

    Log-count ratios come from how many toxic and other texts hold an n-gram; features that tell the labels apart
    enter a logistic regression with their ratio as value. Rows of unknown documents, null ids and null labels are
    left out; a document labelled more than once is toxic if any label says so. With no row of one label the score
    is the share of toxic rows whatever the text (0 without any row).
    """
    spark = documents.sparkSession
    ship(spark)
    rows = written(labelled_rows(documents, labels, seed, sample_rows), "toxicity-sample")

    names = ["f", "label", "weight"]

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                found = [np.unique(ngrams(text or "")).astype(np.int32) for text in part.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.int32())), *part.columns[1:]], names)

    present = rows.select("text", "label", "weight").mapInArrow(presence, "f array<int>, label double, weight double")
    counted = present.select(F.explode("f").alias("f"), "label").groupBy("f")
    counted = counted.agg(F.sum("label").alias("toxic"), F.count("*").alias("total")).toPandas()
    shape = rows.agg(
        F.count("*").alias("n"), F.sum("label").alias("toxic"), F.sum("weight").alias("w"),
        F.sum(F.col("weight") * F.col("label")).alias("wt"),
    ).first()
    n, share = shape.n, (shape.toxic or 0) / max(shape.n, 1)
    if not 0 < share < 1:
        return Model(np.zeros(1 << BITS), 700.0 if share else -700.0)
    toxic, total = np.zeros(1 << BITS), np.zeros(1 << BITS)
    toxic[counted.f], total[counted.f] = counted.toxic, counted.total
    positive, negative = toxic + 1, total - toxic + 1
    ratio = np.log(positive / positive.sum()) - np.log(negative / negative.sum())
    deviation = np.abs(toxic - total * share) / np.sqrt(total * share * (1 - share) + 1)
    kept = np.flatnonzero((deviation >= LEAST_DEVIATION) & (total >= LEAST_ROWS))
    weights = np.zeros(1 << BITS)
    base = float(np.log(shape.wt / (shape.w - shape.wt)))
    if not len(kept):
        return Model(weights, base)
    number = np.full(1 << BITS, -1)
    number[kept] = np.arange(len(kept))
    shared = spark.sparkContext.broadcast((number, ratio[kept]))

    def vector(text):
        number, ratio = shared.value
        at = number[np.unique(ngrams(text or ""))]
        at = np.sort(at[at >= 0])
        return Vectors.sparse(len(ratio), at, ratio[at])

    # From the texts, not from ``present``: a task that chains two Python steps keeps two workers, which stay alive.
    data = rows.select(F.udf(vector, VectorUDT())("text").alias("features"), "label", "weight")
    data = written(data.withColumn("weight", F.col("weight") * n / shape.w), "toxicity-vectors")
    fitted = LogisticRegression(weightCol="weight", regParam=1e-4, standardization=False, maxIter=100).fit(data)
    weights[kept] = fitted.coefficients.toArray() * ratio[kept]
    return Model(weights, float(fitted.intercept))


def score(documents: DataFrame, model: Model, text_column: str = "text") -> Column:
    """The score of each whole text, 0 to 1; null and empty texts get the score of a text without n-grams."""
    spark = documents.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        return pd.Series([shared.value.score(text) for text in texts], dtype="float64")

    return scored(documents[text_column])


def held_out(column: str = "doc_id") -> Column:
    """Rows no label is learned from: crc32 of the id as text leaves 0 modulo 5."""
    return F.crc32(F.col(column).cast("string")) % 5 == 0


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``documents`` without those scored ``threshold`` or more by a model of the labels outside ``held_out``.

    Columns stay as they are; an empty table stays empty; repeated rows share their fate.
    """
    model = fit(documents, labels, ~held_out())
    return documents.where(score(documents, model) < threshold)

"""Many logistic regressions in shared passes over the rows.

A grid search fits the same rows again for each penalty and each fold. Here one pass serves all of them: tasks add up
loss, gradient and Hessian of every (penalty, fold) at its current coefficients, Spark adds up the tasks, and the
driver, which sees only these sums, takes one proximal Newton step for each. Some ten passes fit a whole grid, however
many points it has, where a fit per point reads the rows once per point, fold and iteration.

A task holds (features + 1) squared numbers for each problem that is still moving: for some hundreds of columns.
"""

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.sources.workers import ship_code

SLICE_ROWS = 4_096
#: A problem ends with a step that gains less than this share of its value.
TOLERANCE = 1e-10
STEPS_PER_TARGET = 1_000
NOBODY = -1  # a problem that holds out no fold


@dataclass(frozen=True)
class Problem:
    """Mean log loss plus ``strength * (mix * |b| + (1 - mix) / 2 * b ** 2)`` of the coefficients ``b`` on features of
    unit deviation, over all rows that are not in the fold ``held_out``."""

    strength: float = 0.0
    mix: float = 0.0
    max_iter: int = 100
    held_out: int = NOBODY


@dataclass(frozen=True)
class LogisticModel:
    """Coefficients on the features as they are. Rows are scored by built-in expressions."""

    coefficients: DenseVector
    intercept: float
    steps: int = 0
    features_column: str = "scaled_features"

    def transform(self, df: DataFrame) -> DataFrame:
        weights = F.array(*(F.lit(float(c)) for c in self.coefficients))
        products = F.zip_with(vector_to_array(self.features_column), weights, lambda x, w: x * w)
        margin = F.aggregate(products, F.lit(float(self.intercept)), lambda total, x: total + x)
        likely = 1 / (1 + F.exp(-margin))
        probability = array_to_vector(F.array(1 - likely, likely))
        return df.withColumn("probability", probability).withColumn("prediction", (margin > 0).cast("double"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _slices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(label, fold, features after a column of ones) of a bounded number of rows."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            x = _matrix(part.column(2), width)
            ones = np.concatenate([np.ones((len(x), 1)), x], axis=1)
            yield part.column(0).to_numpy(zero_copy_only=False), part.column(1).to_numpy(zero_copy_only=False), ones


def _sigmoid(values: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * values))


def _sums(rows: DataFrame, width: int, theta: np.ndarray, held_out: np.ndarray) -> dict[int, np.ndarray]:
    """Per problem the sums of loss, gradient and Hessian over its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = width + 1
        loss, gradient = np.zeros(len(theta)), np.zeros((len(theta), size))
        hessian = np.zeros((len(theta), size, size))
        for y, fold, x in _slices(batches, width):
            margin = x @ theta.T
            used = fold[:, None] != held_out[None, :]
            likely = _sigmoid(margin)
            loss += ((np.logaddexp(0, margin) - y[:, None] * margin) * used).sum(axis=0)
            gradient += ((likely - y[:, None]) * used).T @ x
            curve = likely * (1 - likely) * used
            for k in range(len(theta)):
                hessian[k] += (x * curve[:, k : k + 1]).T @ x
        sums = np.concatenate([loss[:, None], gradient, hessian.reshape(len(theta), -1)], axis=1)
        offsets = np.arange(0, sums.size + 1, sums.shape[1], dtype=np.int32)
        lists = pa.ListArray.from_arrays(offsets, sums.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(theta), dtype=np.int32)), lists], ["problem", "sums"])

    parts = rows.mapInArrow(run, "problem int, sums array<double>")
    totals = parts.groupBy("problem").agg(vector_to_array(Summarizer.sum(array_to_vector("sums"))).alias("sums"))
    return {r.problem: np.array(r.sums) for r in totals.collect()}  # one row per problem


def _moments(rows: DataFrame, width: int) -> dict[int, tuple[int, float, np.ndarray, np.ndarray]]:
    """Per fold: rows, positives, feature means and sums of squared deviations."""
    vector = array_to_vector("x")
    found = rows.groupBy("fold").agg(
        F.count("*").alias("n"),
        F.sum("label").alias("ones"),
        Summarizer.metrics("mean", "variance").summary(vector).alias("m"),
    )
    out = {}
    for r in found.collect():  # one row per fold
        out[r.fold] = (r.n, r.ones, r.m.mean.toArray(), r.m.variance.toArray() * max(r.n - 1, 0))
    return out


def _pooled(moments: dict, held_out: int, width: int) -> tuple[int, float, np.ndarray]:
    """Rows, positives and sample deviations over all folds but one."""
    n, ones, mean, squares = 0, 0.0, np.zeros(width), np.zeros(width)
    for fold, (count, positives, average, deviation) in moments.items():
        if fold != held_out and count:
            gap = average - mean
            squares = squares + deviation + gap**2 * (n * count / (n + count))
            mean = mean + gap * (count / (n + count))
            n, ones = n + count, ones + positives
    return n, ones, np.sqrt(squares / max(n - 1, 1))


def _ridge_steps(curve: np.ndarray, slope: np.ndarray, theta: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    """Newton targets without an absolute penalty; least-norm steps where columns depend on each other."""
    out = np.empty_like(theta)
    for k in range(len(theta)):
        weights = np.full(theta.shape[1], ridge[k])
        weights[0] = 0.0
        right = slope[k] + weights * theta[k]
        out[k] = theta[k] - np.linalg.lstsq(curve[k] + np.diag(weights), right, rcond=1e-12)[0]
    return out


def _lasso_target(matrix: np.ndarray, linear: np.ndarray, lasso: float, start: np.ndarray) -> np.ndarray:
    """Minimum of ``x @ matrix @ x / 2 - linear @ x + lasso * abs(x[1:]).sum()``, exactly.

    With the signs of ``x`` given the minimum is a linear system. Coordinates that would change their sign on the way to
    it stop at 0 where that is best; at such a minimum the coordinate at 0 with the steepest slope joins, until none
    has a slope above ``lasso``. The value falls with every step, so no set of signs comes twice.
    """
    usable = np.diag(matrix) > 0
    matrix = matrix + np.diag(np.where(usable, 1e-12 * np.diag(matrix).max(initial=0.0), 0.0))
    x = np.where(usable, start, 0.0)
    sign = np.sign(x)
    sign[0] = 0
    active = (x != 0) & usable
    active[0] = usable[0]

    def value(points: np.ndarray) -> np.ndarray:
        squares = np.einsum("ij,ij->i", points @ matrix, points) / 2
        return squares - points @ linear + lasso * np.abs(points[:, 1:]).sum(axis=1)

    for _ in range(STEPS_PER_TARGET):
        own = np.flatnonzero(active)
        move = np.zeros_like(x)
        move[own] = np.linalg.solve(matrix[np.ix_(own, own)], linear[own] - lasso * sign[own]) - x[own]
        turning = np.flatnonzero((sign * (x + move) < 0) & active)
        stops = np.append(-x[turning] / move[turning], 1.0)
        points = x + stops[:, None] * move
        points[np.arange(len(turning)), turning] = 0.0
        best = int(np.argmin(value(points)))
        x = points[best]
        if best < len(turning):
            active[turning[best]] = False
            sign = np.sign(x)
            sign[0] = 0
            continue
        sign = np.sign(x)
        sign[0] = 0
        slope = matrix @ x - linear
        excess = np.where((x == 0) & usable, np.abs(slope) - lasso, -1.0)
        excess[0] = -1.0
        joins = int(np.argmax(excess))
        if not len(turning) and excess[joins] <= 1e-12 * (1 + lasso):
            break
        if excess[joins] > 1e-12 * (1 + lasso):
            active[joins], sign[joins] = True, -np.sign(slope[joins])
    return x


def _lasso_steps(curve: np.ndarray, slope: np.ndarray, theta: np.ndarray, ridge: np.ndarray, lasso: np.ndarray) -> np.ndarray:
    """Newton targets with an absolute penalty."""
    out = np.empty_like(theta)
    for k in range(len(theta)):
        weights = np.full(theta.shape[1], ridge[k])
        # No curvature and no penalty that could be felt: a constant column.
        weights[0] = 0.0
        weights[np.diag(curve[k]) <= 0] = 0.0
        linear = curve[k] @ theta[k] - slope[k]
        out[k] = _lasso_target(curve[k] + np.diag(weights), linear, lasso[k], theta[k])
    return out


def fit_path(
    train: DataFrame,
    problems: Sequence[Problem],
    fold: str = "fold",
    label: str = "label",
    features: str = "scaled_features",
) -> list[LogisticModel]:
    """One model per problem. ``train`` is read about ten times in all, so pass a written table.

    Features are scaled to unit sample deviation inside, per problem, and coefficients come back on the given scale;
    a constant feature gets 0. A step that makes a problem worse is halved. A problem whose rows have one label only
    has no coefficients and an infinite intercept; one without rows has zeros. Where columns depend on each other and
    nothing is penalized, the coefficients are one of many with the same probabilities.
    """
    ship_code(train.sparkSession)
    rows = train.select(
        F.col(label).cast("double").alias("label"), F.col(fold).cast("int").alias("fold"), vector_to_array(features).alias("x")
    )
    first = rows.select(F.size("x")).first()
    width = first[0] if first else 0
    moments = _moments(rows, width) if first else {}
    number = len(problems)
    counts, positives, scale = np.zeros(number), np.zeros(number), np.ones((number, width + 1))
    for k, problem in enumerate(problems):
        counts[k], positives[k], deviation = _pooled(moments, problem.held_out, width)
        # A constant column keeps the deviation 0 up to rounding of its mean.
        scale[k, 1:] = np.where(deviation > 1e-12, deviation, np.inf)
    held_out = np.array([p.held_out for p in problems])
    strength, mix = np.array([p.strength for p in problems]), np.array([p.mix for p in problems])
    ridge, lasso = strength * (1 - mix), strength * mix
    theta = np.zeros((number, width + 1))  # on the unit scale, the intercept first
    mixed = (positives > 0) & (positives < counts)
    theta[mixed, 0] = np.log(positives[mixed] / (counts[mixed] - positives[mixed]))
    theta[~mixed, 0] = np.where(counts[~mixed] > 0, np.where(positives[~mixed] > 0, np.inf, -np.inf), 0.0)
    best, value, steps = theta.copy(), np.full(number, np.inf), np.zeros(number, int)
    moving = np.flatnonzero(mixed)
    while len(moving):
        sums = _sums(rows, width, theta[moving] / scale[moving], held_out[moving])
        total = np.array([sums[i] for i in range(len(moving))])
        size = width + 1
        n, s = counts[moving], scale[moving]
        slope = total[:, 1 : 1 + size] / n[:, None] / s
        curve = total[:, 1 + size :].reshape(-1, size, size) / n[:, None, None] / s[:, :, None] / s[:, None, :]
        b = theta[moving, 1:]
        now = total[:, 0] / n + lasso[moving] * np.abs(b).sum(axis=1) + ridge[moving] / 2 * (b**2).sum(axis=1)
        before = value[moving]
        good = now <= before + 1e-13 * np.maximum(1, np.abs(before))
        gain = np.where(np.isfinite(before), before - now, np.inf)
        ended = good & (gain <= TOLERANCE * np.maximum(1, np.abs(now)))
        ended |= ~good & (np.abs(theta[moving] - best[moving]).max(axis=1) < 1e-10)
        taken = moving[good]
        best[taken], value[taken] = theta[taken], now[good]
        ended |= good & (steps[moving] >= np.array([problems[k].max_iter for k in moving]))
        # Halfway back where the step was too long, a new step where it was good.
        theta[moving[~good]] = (theta[moving[~good]] + best[moving[~good]]) / 2
        for plain in (True, False):
            part = good & ~ended & ((lasso[moving] == 0) == plain)
            where = moving[part]
            if not len(where):
                continue
            if plain:
                theta[where] = _ridge_steps(curve[part], slope[part], theta[where], ridge[where])
            else:
                theta[where] = _lasso_steps(curve[part], slope[part], theta[where], ridge[where], lasso[where])
            steps[where] += 1
        moving = moving[~ended]
    weights = best[:, 1:] / scale[:, 1:]
    return [
        LogisticModel(DenseVector(weights[k]), float(best[k, 0]), int(steps[k]), features) for k in range(number)
    ]


def held_out_scores(
    train: DataFrame,
    models: Sequence[LogisticModel],
    problems: Sequence[Problem],
    fold: str = "fold",
    label: str = "label",
    features: str = "scaled_features",
) -> DataFrame:
    """``(problem, label, probability)`` of the rows that each problem holds out, in one pass for all problems."""
    ship_code(train.sparkSession)
    theta = np.array([[m.intercept, *m.coefficients.toArray()] for m in models])
    held_out, width = np.array([p.held_out for p in problems]), theta.shape[1] - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for y, folds, x in _slices(batches, width):
            at, problem = np.nonzero(folds[:, None] == held_out[None, :])
            likely = _sigmoid((x @ theta.T)[at, problem])
            columns = [pa.array(problem.astype(np.int32)), pa.array(y[at]), pa.array(likely)]
            yield pa.RecordBatch.from_arrays(columns, ["problem", "label", "probability"])

    rows = train.select(
        F.col(label).cast("double").alias("label"), F.col(fold).cast("int").alias("fold"), vector_to_array(features).alias("x")
    )
    return rows.mapInArrow(run, "problem int, label double, probability double")

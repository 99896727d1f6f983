"""Pairwise-complete Pearson correlations from one distributed Gram matrix."""

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.operators.scalars import with_scalar


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_1, column_2, r) for every ordered pair; null where a column is constant.

    Each row becomes [x, present, x^2] with absent values 0, and the Gram matrix of those vectors
    (one tree aggregation of a small matrix, whatever the number of rows) holds every sum the
    pairs need over the rows where both are present. Values are standardized first so the sums do
    not cancel. Reads ``df`` twice, so pass a written table.
    """
    names = list(columns)
    known = with_scalar(
        df,
        "_moments",
        df,
        *(F.avg(f"`{c}`").alias(f"mean_{i}") for i, c in enumerate(names)),
        *(F.stddev_pop(f"`{c}`").alias(f"std_{i}") for i, c in enumerate(names)),
    )
    cells = []
    for i, c in enumerate(names):
        value, std = F.col(f"`{c}`").cast("double"), F.col("_moments")[f"std_{i}"]
        shifted = F.try_divide(value - F.col("_moments")[f"mean_{i}"], std)
        cells.append(F.coalesce(shifted, F.lit(0.0)).alias(f"x_{i}"))
    squares = [F.col(f"x_{i}") * F.col(f"x_{i}") for i in range(len(names))]
    present = [F.col(f"`{c}`").isNotNull().cast("double") for c in names]
    rows = known.select(*cells, *(p.alias(f"m_{i}") for i, p in enumerate(present))).select(
        "*", *(s.alias(f"s_{i}") for i, s in enumerate(squares))
    )
    order = [f"{part}_{i}" for part in "xms" for i in range(len(names))]
    vectors = VectorAssembler(inputCols=order, outputCol="v").transform(rows).select("v")
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(vectors, "v")).computeGramianMatrix()
    r = _pearson(gram.toArray(), len(names))
    pairs = [
        (a, b, None if np.isnan(r[i, j]) else float(r[i, j]))
        for i, a in enumerate(names)
        for j, b in enumerate(names)
    ]
    return df.sparkSession.createDataFrame(pairs, "column_1 string, column_2 string, r double")


def _pearson(gram: np.ndarray, k: int) -> np.ndarray:
    x, m, s = slice(0, k), slice(k, 2 * k), slice(2 * k, 3 * k)
    n = gram[m, m]
    sum_x, sum_xx = gram[x, m], gram[s, m]
    with np.errstate(divide="ignore", invalid="ignore"):
        covariance = gram[x, x] / n - (sum_x / n) * (sum_x.T / n)
        variance = sum_xx / n - (sum_x / n) ** 2
        # Below rounding noise of standardized values the column is constant over the pair's rows.
        variance = np.where(variance > 1e-12, variance, np.nan)
        return np.clip(covariance / np.sqrt(variance * variance.T), -1.0, 1.0)


def correlated_pairs(matrix: DataFrame, columns: Sequence[str], above: float = 0.8) -> DataFrame:
    """Pairs with r above the threshold (signed), each once, first column before second."""
    position = F.create_map(*(F.lit(x) for i, c in enumerate(columns) for x in (c, i)))
    in_order = position[F.col("column_1")] < position[F.col("column_2")]
    return matrix.filter(in_order & (F.col("r") > above)).orderBy("column_1", "column_2")

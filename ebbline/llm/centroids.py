"""Centroid clustering of vectors with exact integers, searched coarse to fine in Walsh-Hadamard coefficients."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.llm.common import ship, written

SCALE = 256
CENTROIDS = 40
ROUNDS = 5
SEED = 2
#: Coefficients that have been compared after each step of the search.
STEPS = (4, 8, 16, 32)
#: Vectors that one step of numpy works on.
SLICE_ROWS = 4_096
#: Integer components stay below this, so that coefficients, squares and their sums are exact in 64 bits.
LARGEST = 1 << 21


def hadamard(size: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of a power of two, rows from few to many sign changes: coarse to fine."""
    matrix = np.ones((1, 1), np.int64)
    while len(matrix) < size:
        matrix = np.block([[matrix, matrix], [matrix, -matrix]])
    changes = (matrix[:, 1:] != matrix[:, :-1]).sum(axis=1)
    return matrix[np.argsort(changes)]


def transform(vectors: np.ndarray) -> np.ndarray:
    """Coefficients of integer vectors. Squared distances between them are ``size`` times those of the vectors."""
    # Products of floats are exact here: below LARGEST * size, far below 2 ** 53.
    matrix = hadamard(vectors.shape[1]).astype(np.float64)
    return (vectors.astype(np.float64) @ matrix.T).astype(np.int64)


def inverse(coefficients: np.ndarray) -> np.ndarray:
    """Integer vectors from their coefficients, also from sums of coefficients."""
    size = coefficients.shape[1]
    return coefficients @ hadamard(size) // size


def nearest(rows: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For coefficient rows the nearest centroid (ties: smaller number) and the squared distance of the vectors.

    Partial sums of squared coefficient differences only grow. After each step the row's leader, the centroid with
    the least sum, is measured in full; centroids whose partial sum is above the least full one so far are worse
    for certain and go. What is left after the last step gets all its coefficients.
    """
    number, size = rows.shape
    start = STEPS[0]
    partial = ((rows[:, None, :start] - centroids[None, :, :start]) ** 2).sum(axis=2)
    row, centroid = (part.ravel() for part in np.indices(partial.shape))
    partial = partial.ravel()
    bound = np.full(number, np.iinfo(np.int64).max)
    for step, low in enumerate(STEPS):
        order = np.lexsort((partial, row))
        leaders = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
        whole = ((rows[row[leaders]] - centroids[centroid[leaders]]) ** 2).sum(axis=1)
        bound[row[leaders]] = np.minimum(bound[row[leaders]], whole)
        left = partial <= bound[row]
        row, centroid, partial = row[left], centroid[left], partial[left]
        high = STEPS[step + 1] if step + 1 < len(STEPS) else size
        partial = partial + ((rows[row, low:high] - centroids[centroid, low:high]) ** 2).sum(axis=1)
    order = np.lexsort((centroid, partial, row))
    first = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
    return centroid[first], partial[first] // size


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def coefficients(vectors: DataFrame, size: int, id_column: str, vector_column: str) -> DataFrame:
    """``(id, seed_order, coefficients)`` of the vectors that can be clustered."""
    vector = F.transform(vectors[vector_column], lambda x: x.cast("double"))
    scaled = F.transform(vector, lambda x: F.floor(x * SCALE))
    # A null, NaN or infinite component fails this test, since comparisons with it are null or false.
    good = F.forall(vector, lambda x: F.coalesce((x >= -LARGEST / SCALE) & (x < LARGEST / SCALE), F.lit(False)))
    kept = vectors.where((F.size(vector) == size) & good)
    text = F.concat(F.lit(f"{SEED}:"), kept[id_column].cast("string"))
    rows = kept.select(kept[id_column].alias("id"), F.sha2(text, 256).alias("seed_order"), scaled.alias("vector"))
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = transform(_matrix(batch.column(2), size)).astype(np.int32)
            lists = pa.ListArray.from_arrays(np.arange(0, values.size + 1, size, dtype=np.int32), values.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), lists], names)

    names = ["id", "seed_order", "coefficients"]
    return rows.mapInArrow(run, f"id {kind}, seed_order string, coefficients array<int>")


def _slices(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(start, SLICE_ROWS)
            yield part, _matrix(part.column(column), size).astype(np.int64)


def moved(rows: DataFrame, centroids: np.ndarray, size: int) -> np.ndarray:
    """Coefficients of the centroids after one round: each task adds up its vectors, Spark adds up the tasks."""
    at = transform(centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((len(at), size), np.int64), np.zeros(len(at), np.int64)
        for _, values in _slices(batches, 0, size):
            cluster, _ = nearest(values, at)
            np.add.at(sums, cluster, values)
            counts += np.bincount(cluster, minlength=len(at))
        used = np.flatnonzero(counts)
        columns = [pa.array(used, pa.int32()), pa.array(counts[used]), *(pa.array(s) for s in sums[used].T)]
        yield pa.RecordBatch.from_arrays(columns, names)

    parts = [f"s{k}" for k in range(size)]
    names = ["cluster", "n", *parts]
    schema = "cluster int, " + ", ".join(f"{name} long" for name in names[1:])
    totals = rows.select("coefficients").mapInArrow(run, schema).groupBy("cluster").agg(*(F.sum(n).alias(n) for n in names[1:]))
    out = centroids.copy()
    for total in totals.collect():  # one row per centroid
        whole = inverse(np.array([total[2:]], np.int64))[0]
        out[total["cluster"]] = whole // total["n"]
    return out


def cluster(
    vectors: DataFrame,
    number: int = CENTROIDS,
    rounds: int = ROUNDS,
    size: int = 64,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """``(id, cluster, distance, cluster_inertia, inertia, centroid_sha256)`` of every vector that can be clustered.

    Components become the integers ``floor(256 * x)``. The centroids start as the vectors of the ``number`` ids
    whose digest of ``2:<id>`` is least; a round assigns every vector to its nearest centroid (ties: smaller number)
    and moves every centroid that has vectors to the floor of their mean; after ``rounds`` rounds all are assigned once
    more. The driver and the tasks hold the centroids only.

    Vectors that are null, of another length than ``size`` (a power of two from 64 on), or with a null, NaN, infinite
    or larger component than ``LARGEST`` allows (8192 in size; exact 64-bit sums end there) are not in the result.
    With fewer vectors than ``number`` there are as many centroids as vectors. Repeated rows are vectors of their
    own; of an id that comes several times the smaller coefficients come first as a start. Null ids come last as
    starts. An empty table gives an empty result. Other columns are not read.
    """
    ship(vectors.sparkSession)
    rows = written(coefficients(vectors, size, id_column, vector_column), "coefficients")
    first = rows.orderBy(F.col("seed_order").asc_nulls_last(), "coefficients").select("coefficients").limit(number).collect()
    centroids = inverse(np.array([r[0] for r in first], np.int64).reshape(len(first), size))
    for _ in range(rounds if first else 0):
        centroids = moved(rows, centroids, size)
    at = transform(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, values in _slices(batches, 1, size):
            found, distance = nearest(values, at)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.int32()), pa.array(distance)], names)

    names = ["id", "cluster", "distance"]
    kind = rows.schema["id"].dataType.simpleString()
    assigned = written(
        rows.select("id", "coefficients").mapInArrow(assign, f"id {kind}, cluster int, distance long"), "assigned"
    )
    inertia = {r[0]: r[1] for r in assigned.groupBy("cluster").agg(F.sum("distance")).collect()}  # one row per centroid
    per_cluster = vectors.sparkSession.createDataFrame(
        [
            (k, inertia[k], sum(inertia.values()), hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
            for k, c in enumerate(centroids.tolist())
            if k in inertia
        ],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string",
    )
    return assigned.join(F.broadcast(per_cluster), "cluster").select(
        F.col("id").alias(id_column), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )

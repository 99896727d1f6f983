"""Exact k-nearest-neighbour classification in blocks.

Every query is compared with every training point: in many dimensions no exact method avoids most of that, so the
cost is queries times training points. Both sides are cut into blocks of bounded size, one group per pair of blocks
computes its distances as arrays, and only the k nearest per query and block leave a group. Rows moved are queries
times training blocks plus training points times query blocks; results are at most queries x blocks x k.
"""

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbline.sources.scratch import materialize

#: Rows of either side in one group.
BLOCK_ROWS = 2048


def block_neighbours(
    train: DataFrame, test: DataFrame, k: int, block_rows: int = BLOCK_ROWS
) -> DataFrame:
    """``(_n, _square, _id, _label)``: for each query and block of ``train(_id, _label, _x)`` its k nearest points.

    ``test(_n, _q)`` are the queries. Equal distances go to the smaller id.
    """
    blocks = [-(-side.count() // block_rows) or 1 for side in (train, test)]
    own_train = F.pmod(F.xxhash64("_id", "_x"), F.lit(blocks[0])).cast("int")
    own_test = F.pmod(F.xxhash64("_n"), F.lit(blocks[1])).cast("int")
    every = [F.explode(F.sequence(F.lit(0), F.lit(n - 1))) for n in blocks]
    points = train.select(own_train.alias("_t"), every[1].alias("_u"), "_id", "_label", "_x")
    queries = test.select(every[0].alias("_t"), own_test.alias("_u"), "_n", "_q")
    kinds = dict(train.dtypes)

    def nearest(points, queries):
        import numpy as np

        if not len(points) or not len(queries):
            return pd.DataFrame({"_n": [], "_square": [], "_id": [], "_label": []})
        points = points.sort_values("_id", kind="stable", ignore_index=True)
        x, out = np.stack(points["_x"].to_list()), []
        for low in range(0, len(queries), 256):
            part = queries.iloc[low : low + 256]
            q = np.stack(part["_q"].to_list())
            square = np.zeros((len(q), len(x)))
            for i in range(x.shape[1]):
                square += (x[None, :, i] - q[:, i, None]) ** 2
            order = np.argsort(square, axis=1, kind="stable")[:, :k]
            found = points.iloc[order.ravel()]
            out.append(
                pd.DataFrame(
                    {
                        "_n": np.repeat(part["_n"].to_numpy(), order.shape[1]),
                        "_square": np.take_along_axis(square, order, axis=1).ravel(),
                        "_id": found["_id"].to_numpy(),
                        "_label": found["_label"].to_numpy(),
                    }
                )
            )
        return pd.concat(out)

    pair = points.groupBy("_t", "_u").cogroup(queries.groupBy("_t", "_u"))
    return pair.applyInPandas(nearest, f"_n long, _square double, _id {kinds['_id']}, _label int")


def knn_classify(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    key: str,
    label: str = "label",
    k: int = 5,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(key, prediction) for each test row: majority of the k nearest training rows.

    Equal distances go to the smaller training key, tied votes to label 0. Of identical training
    points only the k smallest keys can matter and only they are kept; identical test points are
    looked up once. Training rows with a null feature are left out, such test rows get null.
    """
    point = F.array(*(F.col(f"`{c}`").cast("double") for c in features))
    complete = ~F.exists(point, lambda x: x.isNull())
    rows = train.filter(complete).select(
        F.col(key).alias("_id"), F.col(label).cast("int").alias("_label"), point.alias("_x")
    )
    same_point = Window.partitionBy("_x").orderBy("_id")
    placed = materialize(
        rows.withColumn("_copy", F.row_number().over(same_point)).filter(F.col("_copy") <= k).drop("_copy"),
        "knn-points",
    )
    if placed.isEmpty():
        raise ValueError("no training rows")
    queries = test.filter(complete).select(point.alias("_q")).distinct()
    queries = materialize(queries.withColumn("_n", F.monotonically_increasing_id()), "knn-queries")
    closest = Window.partitionBy("_n").orderBy("_square", "_id")
    votes = (
        block_neighbours(placed, queries, k, block_rows)
        .withColumn("_i", F.row_number().over(closest))
        .filter(F.col("_i") <= k)
        .groupBy("_n")
        .agg((2 * F.sum("_label") > F.count("*")).cast("int").alias("prediction"))
    )
    found = queries.join(votes, "_n").select("_q", "prediction")
    return test.select(key, point.alias("_q")).join(found, "_q", "left").select(key, "prediction")

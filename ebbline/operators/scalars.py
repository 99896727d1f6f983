"""One-row statistics attached to every row as a scalar subquery, without a join."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_scalar(df: DataFrame, name: str, table: DataFrame, *statistics: Column) -> DataFrame:
    """Add a struct column of aggregates over ``table``; the subquery runs once."""
    return df.withColumn(name, table.agg(F.struct(*statistics).alias(name)).scalar())


def with_varied(
    df: DataFrame, columns: Sequence[str], name: str = "_varied", null_counts: Sequence[str] = ()
) -> DataFrame:
    """Add a struct column telling, per column, whether it has more than two distinct values.

    Some value lies strictly between the extremes, or null counts as the third one; that is two
    plain aggregations where counting distinct values would expand and shuffle every column.
    """

    def value(column):
        return F.col(f"`{column}`")

    ends = with_scalar(
        df,
        "_ends",
        df,
        *(F.min(value(c)).alias(f"low_{c}") for c in columns),
        *(F.max(value(c)).alias(f"high_{c}") for c in columns),
    )

    def varied(column):
        low, high = F.col("_ends")[f"low_{column}"], F.col("_ends")[f"high_{column}"]
        more = (value(column) > low) & (value(column) < high)
        if column in null_counts:
            more = F.coalesce(more, F.lit(False)) | (value(column).isNull() & (low < high))
        return F.coalesce(F.max(more), F.lit(False)).alias(column)

    return with_scalar(df, name, ends, *(varied(c) for c in columns))

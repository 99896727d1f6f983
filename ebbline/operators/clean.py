"""Cleaning, flagging, zero-filling and row selection."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions import flag_in
from ebbline.operators.ranking import select_ranks
from ebbline.schema import CHURN_PAGES, USER

# Columns that the cleaned log keeps.
KEEP_COLUMNS = ("userId", "artist", "ts", "page", "level", "location")


def clean_log(
    log: DataFrame, columns: Sequence[str] | None = KEEP_COLUMNS, keep_blank: bool = False
) -> DataFrame:
    """Pruned log without unknown users; ``keep_blank`` leaves ``''`` in as a user of its own.

    Dropping blank users also removes the one key that can hold a large share of the log.
    """
    known = F.col(USER).isNotNull() if keep_blank else F.col(USER) != ""
    kept = log.filter(known)
    return kept if columns is None else kept.select(*columns)


def blank_users_to_null(log: DataFrame) -> DataFrame:
    return log.withColumn(USER, F.nullif(F.col(USER), F.lit("")))


def integer_users(log: DataFrame) -> DataFrame:
    """User ids as integers; blank and malformed ids become null."""
    return log.withColumn(USER, F.col(USER).try_cast("int"))


def unique_users(log: DataFrame) -> DataFrame:
    return log.select(USER).distinct()


def flag_rows(df: DataFrame, column: str, values: Iterable, flag: str) -> DataFrame:
    return df.withColumn(flag, flag_in(F.col(column), values))


def flag_cancelled_users(
    log: DataFrame, pages: Iterable[str] = CHURN_PAGES, flag: str = "cancel_flag"
) -> DataFrame:
    """Every row of a user who ever reached one of ``pages`` gets flag 1.

    Rows without a user match nothing and pass by the join, which would hash them all to one partition.
    One row per flagged user is joined back, so no window gathers a whole user in one task: the
    join is broadcast when the flagged side is measured small, and otherwise adaptive execution
    splits the partitions of heavy users.
    """
    flagged = (
        log.filter(F.col("page").isin(list(pages)))
        .select(USER)
        .distinct()
        .withColumn(flag, F.lit(1))
    )
    known = log.filter(F.col(USER).isNotNull()).join(flagged, USER, "left")
    known = known.withColumn(flag, F.coalesce(F.col(flag), F.lit(0)))
    unknown = log.filter(F.col(USER).isNull()).withColumn(flag, F.lit(0))
    return known.unionByName(unknown.select(*known.columns))


def zero_fill(feature: DataFrame, users: DataFrame, fill=0) -> DataFrame:
    """One row per user of ``users``; values of users the feature lacks are ``fill``."""
    values = [c for c in feature.columns if c != USER]
    present = F.col("_present").isNotNull()
    return users.join(feature.withColumn("_present", F.lit(1)), USER, "left").select(
        USER, *(F.when(present, F.col(f"`{c}`")).otherwise(F.lit(fill)).alias(c) for c in values)
    )


def missing_users(feature: DataFrame, users: DataFrame) -> DataFrame:
    return users.select(USER).subtract(feature.select(USER))


def zero_fill_union(feature: DataFrame, users: DataFrame, fill=0) -> DataFrame:
    """``zero_fill`` for a (user, value) table, written as a set difference and a union."""
    (value,) = (c for c in feature.columns if c != USER)
    return feature.unionByName(missing_users(feature, users).withColumn(value, F.lit(fill)))


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``.

    The ``row_number() = 1`` filter is pushed below the shuffle as a group limit, so at most one
    row per key leaves each task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_row", F.row_number().over(window)).filter("_row = 1").drop("_row")


def index_select(df: DataFrame, positions: Sequence[int], order: str) -> DataFrame:
    """Rows at the given zero-based positions in ascending ``order``, a unique numeric column.

    The positions are selected by radix, without a sort; at most one value per position is joined back.
    """
    values = df.select(F.col(f"`{order}`").alias("value"), F.lit(1).cast("long").alias("n")).filter("value is not null")
    ranks = df.sparkSession.createDataFrame([(int(p),) for p in positions], "rank long")
    picked = select_ranks(values, ranks).select(F.col("value").alias(order))
    return df.join(F.broadcast(picked), order, "left_semi").select(*df.columns)

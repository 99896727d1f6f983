"""Null structure, value frequencies, distribution statistics and correlations of tables."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.operators.ranking import exact_quantiles
from ebbline.sources.scratch import materialize


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"))


def null_map(df: DataFrame) -> DataFrame:
    """0/1 per cell: whether it is null."""
    return df.select(*(F.col(f"`{c}`").isNull().cast("int").alias(c) for c in df.columns))


def null_patterns(df: DataFrame) -> DataFrame:
    """Distinct rows of the null map with their frequency."""
    return null_map(df).groupBy(*df.columns).agg(F.count("*").alias("n_rows"))


def null_profile(df: DataFrame, count_null: bool = False, approximate: bool = False) -> DataFrame:
    """Distinct values, nulls and type per column, fewest distinct first.

    ``count_null`` counts null as a value. ``approximate`` is one pass with a fixed-size sketch
    per column; exact counts shuffle the distinct values of every column.
    """
    distinct = F.approx_count_distinct if approximate else F.count_distinct
    names = df.columns
    kinds = dict(df.dtypes)
    counts = df.agg(*(distinct(f"`{c}`").alias(c) for c in names)).unpivot(
        [], names, "column", "unique_count"
    )
    null_counts = (
        null_patterns(df)
        .agg(*(F.sum(F.col(f"`{c}`") * F.col("n_rows")).alias(c) for c in names))
        .unpivot([], names, "column", "null_count")
    )
    type_of = F.create_map(*(F.lit(x) for c in names for x in (c, kinds[c])))
    unique, nulls = F.col("unique_count"), F.coalesce(F.col("null_count"), F.lit(0))
    return (
        counts.join(null_counts, "column")
        .select(
            "column",
            (unique + (nulls > 0).cast("long") if count_null else unique).alias("unique_count"),
            nulls.alias("null_count"),
            type_of[F.col("column")].alias("type"),
        )
        .orderBy("unique_count", "column")
    )


def null_cooccurrence(df: DataFrame) -> DataFrame:
    """(src, dst, n_rows): rows in which both columns are null, a column with itself included.

    Derived from the null patterns, so the table is scanned once and pairs of columns are formed
    per pattern, not per row.
    """
    nulls = F.array_compact(
        F.array(*(F.when(F.col(f"`{c}`") == 1, F.lit(c)) for c in df.columns))
    )
    patterns = null_patterns(df).select(nulls.alias("nulls"), "n_rows")
    pairs = patterns.withColumn("src", F.explode("nulls")).withColumn("dst", F.explode("nulls"))
    return pairs.groupBy("src", "dst").agg(F.sum("n_rows").alias("n_rows"))


def null_edges(df: DataFrame, ignore_no_relations: bool = False) -> DataFrame:
    """Edges of the null graph; columns without nulls stay as nodes with a null target."""
    edges = null_cooccurrence(df).select("src", "dst")
    if ignore_no_relations:
        return edges
    nodes = df.sparkSession.createDataFrame([(c,) for c in df.columns], "src string")
    return nodes.join(edges, "src", "left")


def _long(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """(by.., column, value): one row per cell, values as doubles."""
    cells = df.select(*by, *(F.col(f"`{c}`").cast("double").alias(c) for c in columns))
    return cells.unpivot(list(by), list(columns), "column", "value")


def _value_counts(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    cells = _long(df, columns, by).filter(F.col("value").isNotNull())
    return cells.groupBy(*by, "column", "value").agg(F.count("*").alias("n"))


def quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: dict[str, float], by: Sequence[str] = ()
) -> DataFrame:
    """Exact interpolated quantiles per column, (by.., column, one column per probability)."""
    counts = materialize(_value_counts(df, columns, by), "value-counts")
    return exact_quantiles(counts, probabilities, [*by, "column"])


def describe(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per column."""
    keys = [*by, "column"]
    moments = (
        _long(df, columns, by)
        .groupBy(*keys)
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("mean"),
            F.stddev_samp("value").alias("std"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
        )
    )
    quarters = quantiles(df, columns, {"q25": 0.25, "q50": 0.5, "q75": 0.75}, by)
    return moments.join(quarters, keys, "left").select(
        *keys, "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


STATISTICS = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")


def describe_by_label(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """``describe`` of both labels side by side: (column, statistic, value_1, value_0)."""
    stats = describe(df, columns, [label]).withColumn("count", F.col("count").cast("double"))
    rows = stats.unpivot([label, "column"], list(STATISTICS), "statistic", "value")
    side = {f"value_{k}": F.max(F.when(F.col(label) == k, F.col("value"))) for k in (1, 0)}
    return rows.groupBy("column", "statistic").agg(*(v.alias(n) for n, v in side.items()))


def feature_means_by_label(df: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """Mean and sum of each feature per label, (label, column, mean, total)."""
    cells = _long(df, columns, [label]).groupBy(label, "column")
    return cells.agg(F.avg("value").alias("mean"), F.sum("value").alias("total"))


def group_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("count"))


def value_counts(df: DataFrame, columns: Sequence[str], min_distinct: int = 3) -> DataFrame:
    """(column, value, count) for columns with at least ``min_distinct`` values."""
    counts = _value_counts(df, columns)
    # One row per column of the table.
    varied = counts.groupBy("column").agg(F.count("*").alias("d")).filter(F.col("d") >= min_distinct)
    return counts.join(F.broadcast(varied.select("column")), "column").select(
        "column", "value", F.col("n").alias("count")
    )


def feature_skew(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bias-adjusted skewness per column, largest first; 0 for a constant, null below 3 values."""
    value = F.col("value")
    n = F.count(value)
    adjust = F.try_divide(F.sqrt((n * (n - 1)).cast("double")), n - 2)
    skew = F.when(n < 3, None).when(F.min(value) == F.max(value), 0.0)
    cells = _long(df, columns).groupBy("column")
    table = cells.agg(skew.otherwise(F.skewness(value) * adjust).alias("skew"))
    return table.orderBy(F.desc_nulls_last("skew"), "column")


def outlier_counts(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> DataFrame:
    """Rows more than ``threshold`` sample deviations off the mean, for columns with > 2 values."""
    cells = _long(df, columns)
    value = F.col("value")
    stats = cells.groupBy("column").agg(
        F.avg(value).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )
    z = F.abs(F.try_divide(value - F.col("mean"), F.col("std")))
    # One row per column of the table. A value between the extremes makes it more than two.
    return (
        cells.join(F.broadcast(stats), "column")
        .groupBy("column")
        .agg(
            F.count_if(z > threshold).alias("outliers"),
            F.count("*").alias("total_samples"),
            F.max((value > F.col("low")) & (value < F.col("high"))).alias("_varied"),
        )
        .filter("_varied")
        .drop("_varied")
        .orderBy(F.desc("outliers"), "column")
    )


def box_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 interquartile ranges) and fliers per column."""
    counts = materialize(_value_counts(df, columns), "value-counts")
    quarters = exact_quantiles(counts, {"q1": 0.25, "median": 0.5, "q3": 0.75}, ["column"])
    value, reach = F.col("value"), (F.col("q3") - F.col("q1")) * 1.5
    inside = (value >= F.col("q1") - reach) & (value <= F.col("q3") + reach)
    # The quartile table has one row per column.
    return (
        counts.join(F.broadcast(quarters), "column")
        .groupBy("column", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("fliers"),
        )
    )


def histogram(df: DataFrame, columns: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width bins from minimum to maximum, the last one closed; empty bins included.

    (column, bin, bin_start, bin_end, count). A constant column gets bins around its value.
    """
    cells = _long(df, columns).filter(F.col("value").isNotNull())
    low, high = F.min("value"), F.max("value")
    # One row per column of the table.
    ranges = cells.groupBy("column").agg(
        F.when(low == high, low - 0.5).otherwise(low).alias("low"),
        (F.when(low == high, F.lit(1.0)).otherwise(high - low) / bins).alias("width"),
    )
    place = F.floor((F.col("value") - F.col("low")) / F.col("width"))
    counts = (
        cells.join(F.broadcast(ranges), "column")
        .groupBy("column", F.least(place, F.lit(bins - 1)).alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    grid = ranges.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    start = F.col("low") + F.col("bin") * F.col("width")
    return grid.withColumn("bin", F.col("bin").cast("long")).join(
        counts, ["column", "bin"], "left"
    ).select(
        "column",
        "bin",
        start.alias("bin_start"),
        (start + F.col("width")).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )

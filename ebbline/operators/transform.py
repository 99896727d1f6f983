"""Feature preparation: one-hot, clipping, log, scaling, splits and folds."""

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions import soft_clip
from ebbline.operators.profile import quantiles
from ebbline.operators.ranking import running_totals
from ebbline.operators.scalars import with_scalar, with_varied


def discover_categories(df: DataFrame, column: str, at_most: int | None = None) -> list[str]:
    """Sorted values of ``column``; more than ``at_most`` of them, if given, is an error, never a cut."""
    values = df.select(column).distinct()
    found = [row[0] for row in (values if at_most is None else values.limit(at_most + 1)).collect()]
    if at_most is not None and len(found) > at_most:
        raise ValueError(f"{column!r} has more than {at_most} values")
    return sorted(value for value in found if value is not None)


def one_hot(df: DataFrame, categories: Mapping[str, Sequence[str]]) -> DataFrame:
    """0/1 columns ``{column}_{value}`` in place of each encoded column."""
    flags = {
        f"{column}_{value}": F.when(F.col(column) == value, 1).otherwise(0)
        for column, values in categories.items()
        for value in values
    }
    return df.withColumns(flags).drop(*categories)


def winsorize(
    df: DataFrame,
    columns: Sequence[str],
    lower: float = 0.01,
    upper: float = 0.99,
    suffix: str = "_clipped",
) -> DataFrame:
    """Clip to quantiles into ``{column}{suffix}``; null stays null.

    Reads ``df`` twice, so pass a written table.
    """
    table = quantiles(df, columns, {"low": lower, "high": upper})
    # One entry per column of the table.
    entry = F.struct("column", F.struct("low", "high"))
    bounds = F.map_from_entries(F.collect_list(entry)).alias("bounds")

    def clip(name: str) -> Column:
        value, bound = F.col(f"`{name}`").cast("double"), F.col("_clip")["bounds"][name]
        return F.when(value.isNotNull(), F.least(F.greatest(value, bound["low"]), bound["high"]))

    bounded = with_scalar(df, "_clip", table, bounds)
    return bounded.withColumns({f"{c}{suffix}": clip(c) for c in columns}).drop("_clip")


def log_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_log": F.log1p(F.col(f"`{c}`")) for c in columns})


def winsorize_log(
    df: DataFrame, columns: Sequence[str], lower: float = 0.01, upper: float = 0.99
) -> DataFrame:
    """``{column}_log`` and its clipped form ``{column}_logClip``."""
    logged = log_columns(df, columns)
    names = [f"{c}_log" for c in columns]
    return winsorize(logged, names, lower, upper, suffix="Clip")


def log_and_clip(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``{column}_clipped`` and ``{column}_log`` for every column; columns already named ``*_log``
    with more than two values also get ``{column}_logClip``, clipped without another log."""
    already = [c for c in columns if c.endswith("_log")]
    if not already:
        return log_columns(winsorize(df, columns), columns)
    logged = log_columns(winsorize(with_varied(df, already), columns), columns)
    clipped = {
        f"{c}_logClip": F.when(F.col("_varied")[c], F.col(f"`{c}_clipped`")) for c in already
    }
    return logged.withColumns(clipped).drop("_varied")


def soft_clip_columns(df: DataFrame, columns: Sequence[str], threshold: float = 3.0) -> DataFrame:
    return df.withColumns({f"{c}_softClip": soft_clip(F.col(f"`{c}`"), threshold) for c in columns})


def minmax_scale(
    df: DataFrame, columns: Sequence[str], fit_on: DataFrame | None = None, constant: float = 0.5
) -> DataFrame:
    """Scale to [0, 1] by the range in ``fit_on`` (default ``df``); constants become ``constant``."""
    fitted = with_scalar(
        df,
        "_ends",
        df if fit_on is None else fit_on,
        *(F.min(f"`{c}`").cast("double").alias(f"low_{c}") for c in columns),
        *(F.max(f"`{c}`").cast("double").alias(f"high_{c}") for c in columns),
    )

    def scaled(name: str) -> Column:
        low, high = F.col("_ends")[f"low_{name}"], F.col("_ends")[f"high_{name}"]
        value = F.col(f"`{name}`").cast("double")
        ratio = F.coalesce(F.try_divide(value - low, high - low), F.lit(constant))
        return F.when(value.isNotNull(), ratio)

    return fitted.withColumns({f"{c}_scaled": scaled(c) for c in columns}).drop("_ends")


def standard_scale(df: DataFrame, columns: Sequence[str], sample: bool = False) -> DataFrame:
    """Zero mean, unit deviation (population unless ``sample``); constants become 0."""
    spread = F.stddev_samp if sample else F.stddev_pop
    fitted = with_scalar(
        df,
        "_moments",
        df,
        *(F.avg(f"`{c}`").alias(f"mean_{c}") for c in columns),
        *(spread(f"`{c}`").alias(f"std_{c}") for c in columns),
    )

    def scaled(name: str) -> Column:
        value = F.col(f"`{name}`").cast("double")
        mean, std = F.col("_moments")[f"mean_{name}"], F.col("_moments")[f"std_{name}"]
        ratio = F.coalesce(F.try_divide(value - mean, std), F.lit(0.0))
        return F.when(value.isNotNull(), ratio)

    return fitted.withColumns({f"{c}_scaled": scaled(c) for c in columns}).drop("_moments")


def assemble(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Numeric columns as one vector, nulls as 0; no columns is an error."""
    if not columns:
        raise ValueError("no feature columns to assemble")
    filled = df.withColumns(
        {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in columns}
    )
    return VectorAssembler(inputCols=list(columns), outputCol=output).transform(filled)


def vector_kinds(df: DataFrame, column: str = "features") -> DataFrame:
    """How many vectors are stored dense and how many sparse."""
    # A vector serializes with its storage type: 1 dense, 0 sparse.
    stored = F.get_json_object(F.to_json(F.struct(F.col(column).alias("v"))), "$.v.type")
    kinds = df.filter(F.col(column).isNotNull()).select(stored.alias("stored"))
    named = F.when(F.col("stored") == "1", "dense").otherwise("sparse").alias("kind")
    return kinds.groupBy(named).agg(F.count("*").alias("count"))


def row_hash(key: str) -> Column:
    """First 32 bits of the key's MD5: the same in every run, engine and partitioning."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")


def with_split(df: DataFrame, key: str, test_percent: int = 20, name: str = "split") -> DataFrame:
    """``test`` or ``train`` by key hash, so a row keeps its side as the data grows."""
    is_test = row_hash(key) % 100 < test_percent
    return df.withColumn(name, F.when(is_test, "test").otherwise("train"))


def train_test_split(df: DataFrame, key: str, test_percent: int = 20) -> tuple[DataFrame, DataFrame]:
    sides = with_split(df, key, test_percent, "_split")
    train, test = (sides.filter(F.col("_split") == s).drop("_split") for s in ("train", "test"))
    return train, test


def stratified_folds(
    df: DataFrame, key: str, label: str = "label", folds: int = 5, name: str = "fold"
) -> DataFrame:
    """Fold numbers that spread each label evenly: rank by key hash within the label, modulo folds.

    ``key`` is unique. Keys that share a hash are ordered inside one small group; ranks across
    groups come from bucketed running totals, not from a window over a whole label. Reads ``df``
    more than once, so pass a written table.
    """
    hashed = df.withColumn("_hash", row_hash(key))
    per_hash = hashed.groupBy(label, "_hash").agg(F.count("*").alias("_n"))
    ends = running_totals(per_hash, "_hash", {"_n": "_end"}, by=[label])
    tied = Window.partitionBy(label, "_hash").orderBy(key)
    joined = hashed.withColumn("_tie", F.row_number().over(tied)).join(
        ends.withColumn("_start", F.col("_end") - F.col("_n")).drop("_end", "_n"), [label, "_hash"]
    )
    position = F.col("_start") + F.col("_tie") - 1
    return joined.withColumn(name, (position % folds).cast("int")).select(*df.columns, name)

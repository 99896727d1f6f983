"""Gaussian naive Bayes held as sufficient statistics: count, sum and sum of squares per class and column.

Statistics add up, so that one aggregation over the rows by fold serves every model of a cross-validation: a fold's
model is the statistics of all folds less its own. New rows are added, and withdrawn rows taken out, without rereading
the others. Tables of statistics have one row per fold, class and column.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Share of the largest column variance that is added to every variance.
SMOOTHING = 1e-9
#: What is added where all columns are constant.
LEAST_VARIANCE = 1e-9
SUMS = ("n", "total", "squares")


def statistics(df: DataFrame, columns: Sequence[str], label: str = "label", by: Sequence[str] = ()) -> DataFrame:
    """``(by.., label, column, n, total, squares)`` of the rows that have a label, nulls counted as 0.

    Sums are taken per class in one aggregation of plain numbers, whatever the number of columns.
    """
    value = {c: F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in columns}
    cells = [
        F.struct(F.lit(c).alias("column"), F.count("*").alias("n"), F.sum(v).alias("total"), F.sum(v * v).alias("squares"))
        for c, v in value.items()
    ]
    labelled = df.filter(F.col(label).isNotNull()).groupBy(*by, F.col(label).cast("int").alias("label"))
    return labelled.agg(F.array(*cells).alias("cells")).select(*by, "label", F.inline("cells"))


def combined(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Statistics added up over everything that ``by`` does not name."""
    return parts.groupBy(*by, "label", "column").agg(*(F.sum(s).alias(s) for s in SUMS))


def added(left: DataFrame, right: DataFrame) -> DataFrame:
    """Statistics of the rows of both."""
    return combined(left.unionByName(right))


def withdrawn(whole: DataFrame, part: DataFrame) -> DataFrame:
    """Statistics of ``whole`` without the rows of ``part``; classes without rows are left out."""
    negative = part.select("label", "column", *((-F.col(s)).alias(s) for s in SUMS))
    return added(whole, negative).filter("n > 0")


def without_fold(parts: DataFrame, fold: str) -> DataFrame:
    """``(fold, label, column, sums..)`` of all rows but the fold's own, for every fold."""
    own = F.map_from_entries(F.collect_list(F.struct(fold, F.struct(*SUMS)))).alias("_own")
    whole = parts.groupBy("label", "column").agg(*(F.sum(s).alias(s) for s in SUMS), own)
    # A class may be missing in a fold, so its statistics are met with every fold; folds are few.
    met = whole.withColumn(fold, F.explode(parts.agg(F.collect_set(fold)).scalar()))
    rest = [(F.col(s) - F.coalesce(F.try_element_at("_own", F.col(fold))[s], F.lit(0))).alias(s) for s in SUMS]
    return met.select(fold, "label", "column", *rest).filter("n > 0")


def fitted(sums: DataFrame, by: Sequence[str] = (), smoothing: float = SMOOTHING) -> DataFrame:
    """``(by.., label, prior, columns array<(column, mean, variance)>)``: one row per class.

    The variance is the population one of the class plus ``smoothing`` times the largest variance of any column over
    all classes, but ``LEAST_VARIANCE`` at least.
    """
    column = Window.partitionBy(*by, "column")
    model = Window.partitionBy(*by)
    total = {s: F.sum(s).over(column) for s in SUMS}
    overall = total["squares"] / total["n"] - (total["total"] / total["n"]) ** 2
    rows = sums.withColumn("_overall", overall).withColumn("_rows", total["n"])
    rows = rows.withColumn("_floor", F.max("_overall").over(model) * smoothing)
    mean = F.col("total") / F.col("n")
    spread = F.greatest(F.col("squares") / F.col("n") - mean * mean, F.lit(0.0)) + F.greatest(F.col("_floor"), F.lit(LEAST_VARIANCE))
    cell = F.struct(F.col("column"), mean.alias("mean"), spread.alias("variance"))
    return rows.groupBy(*by, "label").agg(
        F.max(F.col("n") / F.col("_rows")).alias("prior"), F.sort_array(F.collect_list(cell)).alias("columns")
    )


def classify(
    df: DataFrame, model: DataFrame, columns: Sequence[str], by: Sequence[str] = (), name: str = "prediction"
) -> DataFrame:
    """``df`` with the likeliest class (ties: the smaller one) and with ``probability`` of class 1.

    The classes of a model are put beside each row, not joined to it: they are a handful of rows per ``by`` group.
    """
    classes = model.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("label", "prior", "columns"))).alias("_model"))
    if by:
        rows = df.join(F.broadcast(classes), list(by), "left")
    else:
        rows = df.withColumn("_model", classes.scalar())

    def score(entry: Column) -> Column:
        total = F.log(entry["prior"])
        for i, column in enumerate(sorted(columns)):
            cell = entry["columns"][i]
            value = F.coalesce(F.col(f"`{column}`").cast("double"), F.lit(0.0))
            total = total - (F.log(2 * F.pi() * cell["variance"]) + (value - cell["mean"]) ** 2 / cell["variance"]) / 2
        return F.struct(total.alias("score"), (-entry["label"]).alias("rank"), entry["label"].alias("label"))

    rows = rows.withColumn("_scores", F.transform("_model", score)).withColumn("_best", F.array_max("_scores"))
    best = F.col("_best.score")

    def weight(s: Column) -> Column:
        # Equal scores weigh the same where all are beyond the range of doubles.
        return F.when(s["score"] == best, 1.0).otherwise(F.exp(s["score"] - best))

    shifted = F.transform("_scores", lambda s: F.struct(s["label"].alias("label"), weight(s).alias("w")))
    whole = F.aggregate(shifted, F.lit(0.0), lambda total, s: total + s["w"])
    ones = F.aggregate(F.filter(shifted, lambda s: s["label"] == 1), F.lit(0.0), lambda total, s: total + s["w"])
    return rows.withColumn(name, F.col("_best.label")).withColumn("probability", ones / whole).drop("_model", "_scores", "_best")

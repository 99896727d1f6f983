"""Classification metrics as aggregations over the scored rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.functions import safe_ratio
from ebbline.operators.ranking import running_totals
from ebbline.sources.scratch import materialize


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    cells = df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")
    )
    return cells.agg(F.count("*").alias("count"))


def _score_columns(tp: Column, fp: Column, tn: Column, fn: Column) -> dict[str, Column]:
    recall, specificity = safe_ratio(tp, tp + fn), safe_ratio(tn, tn + fp)
    return {
        # The area under the curve of hard predictions is the mean of both class rates.
        "AUC": (recall + specificity) / 2,
        "f1": safe_ratio(2 * tp, 2 * tp + fp + fn),
        "recall": recall,
        "precision": safe_ratio(tp, tp + fp),
        "accuracy": safe_ratio(tp + tn, tp + fp + tn + fn),
        "f2": safe_ratio(5 * tp, 5 * tp + 4 * fn + fp),
        "specificity": specificity,
    }


def score_metrics(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    by: Sequence[str] = (),
) -> DataFrame:
    """AUC, f1, recall, precision, accuracy, f2 and specificity of hard 0/1 predictions.

    One aggregation; ``by`` scores several models at once. Undefined ratios are 0.
    """
    truth, guess = F.col(label).cast("int") == 1, F.col(prediction).cast("int") == 1
    counts = df.groupBy(*by).agg(
        F.count_if(truth & guess).alias("tp"),
        F.count_if(~truth & guess).alias("fp"),
        F.count_if(~truth & ~guess).alias("tn"),
        F.count_if(truth & ~guess).alias("fn"),
    )
    scores = _score_columns(*(F.col(c) for c in ("tp", "fp", "tn", "fn")))
    return counts.select(*by, *(score.alias(name) for name, score in scores.items()))


def threshold_table(df: DataFrame, label: str, probability: str, by: Sequence[str] = ()) -> DataFrame:
    """Per distinct score, highest first: positives and negatives at it and at or above it.

    Rows are reduced to distinct scores before they are ordered. Columns: by.., score, pos, neg,
    tp, fp.
    """
    truth = F.col(label).cast("int") == 1
    scores = df.groupBy(*by, (-F.col(probability)).alias("_rank")).agg(
        F.count_if(truth).alias("pos"), F.count_if(~truth).alias("neg")
    )
    scores = materialize(scores, "scores")
    ranked = running_totals(scores, "_rank", {"pos": "tp", "neg": "fp"}, by=by)
    return ranked.select(*by, (-F.col("_rank")).alias("score"), "pos", "neg", "tp", "fp")


def best_thresholds(
    df: DataFrame, label: str = "label", probability: str = "probability"
) -> DataFrame:
    """Highest F1 and F2 over all score thresholds, lowest such threshold on ties."""
    table = threshold_table(df, label, probability)
    total = df.agg(F.count_if(F.col(label).cast("int") == 1)).scalar()
    tp, fp = F.col("tp"), F.col("fp")
    fn = total - tp

    def best(name: str, beta2: int) -> Column:
        value = F.round(safe_ratio((1 + beta2) * tp, (1 + beta2) * tp + beta2 * fn + fp), 12)
        return F.max(F.struct(value.alias("value"), (-F.col("score")).alias("low"))).alias(name)

    picked = table.agg(best("F1", 1), best("F2", 4))
    rows = picked.select(
        F.inline(
            F.array(
                *(
                    F.struct(
                        F.lit(name).alias("metric"),
                        (-F.col(f"{name}.low")).alias("threshold"),
                        F.col(f"{name}.value").alias("value"),
                    )
                    for name in ("F1", "F2")
                )
            )
        )
    )
    return rows


def validation_report(
    df: DataFrame,
    label: str = "label",
    probability: str = "probability",
    predictors: int | None = None,
) -> DataFrame:
    """MSE, RMSE, LogLoss, AUC, AUCPR, Gini and deviances of scored rows, as one row.

    AUC sums, over distinct scores, the trapezoids of the ROC curve; AUCPR those of the
    precision-recall curve, starting at the first point's precision. With ``predictors``, degrees
    of freedom and AIC are added.
    """
    y, p = F.col(label).cast("double"), F.col(probability)
    likely = F.greatest(F.least(p, F.lit(1 - 1e-15)), F.lit(1e-15))
    loss = -(y * F.log(likely) + (1 - y) * F.log(1 - likely))
    plain = df.agg(
        F.avg((y - p) * (y - p)).alias("MSE"),
        F.avg(loss).alias("LogLoss"),
        F.avg(y).alias("rate"),
        F.count("*").alias("n"),
    )
    tp, fp, pos, neg = (F.col(c) for c in ("tp", "fp", "pos", "neg"))
    before = tp - pos
    precision = tp / (tp + fp)
    earlier = F.try_divide(before, before + fp - neg)
    areas = threshold_table(df, label, probability).agg(
        F.sum(neg * (before + pos / 2)).alias("roc"),
        F.sum(pos * (precision + F.coalesce(earlier, precision)) / 2).alias("pr"),
        F.sum(pos).alias("positives"),
        F.sum(neg).alias("negatives"),
    )
    n, rate = F.col("n"), F.col("rate")
    entropy = F.when((rate == 0) | (rate == 1), 0.0).otherwise(
        rate * F.log(rate) + (1 - rate) * F.log(1 - rate)
    )
    joined = plain.withColumn("areas", areas.select(F.struct("*").alias("areas")).scalar())
    positives = F.col("areas.positives")
    auc = F.try_divide(F.col("areas.roc"), positives * F.col("areas.negatives"))
    report = joined.select(
        "n",
        "MSE",
        F.sqrt("MSE").alias("RMSE"),
        "LogLoss",
        auc.alias("AUC"),
        F.try_divide(F.col("areas.pr"), positives).alias("AUCPR"),
        (2 * auc - 1).alias("Gini"),
        (-2 * n * entropy).alias("null_deviance"),
        (2 * n * F.col("LogLoss")).alias("residual_deviance"),
    )
    if predictors is None:
        return report
    return report.withColumns(
        {
            "null_dof": n - 1,
            "residual_dof": n - 1 - predictors,
            "AIC": F.col("residual_deviance") + 2 * (predictors + 1),
        }
    )

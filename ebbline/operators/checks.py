"""Data-quality checks, each a one-row or small table instead of an assertion."""

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbline.functions import flag_in
from ebbline.operators.breakdowns import churn_by_state
from ebbline.schema import CHURN_PAGES, USER


def cancel_unique(log: DataFrame, pages: Iterable[str] = CHURN_PAGES) -> DataFrame:
    """Whether there is exactly one cancel event per churned user."""
    users = log.groupBy(USER).agg(
        F.count_if(F.col("page").isin(list(pages))).alias("events"),
        F.max(flag_in(F.col("page"), pages)).alias("flag"),
    )
    totals = users.agg(
        F.coalesce(F.sum("events"), F.lit(0)).alias("cancel_events"),
        F.coalesce(F.sum("flag"), F.lit(0)).cast("long").alias("flagged_users"),
    )
    return totals.withColumn("matches", F.col("cancel_events") == F.col("flagged_users"))


def state_totals(by_state: DataFrame) -> DataFrame:
    """Per state, users before and after the roll-up."""
    before = by_state.groupBy("state").agg(F.sum("count").alias("users_before"))
    after = churn_by_state(by_state).select("state", F.col("total_count").alias("users_after"))
    joined = before.join(after, "state", "full")
    return joined.withColumn("matches", F.col("users_before").eqNullSafe(F.col("users_after")))


def missing_user_counts(log: DataFrame) -> DataFrame:
    """For each feature, how many users the unfilled feature lacks; one pass over the log."""
    from ebbline.schema import NEGATIVE_PAGES, POSITIVE_PAGES

    present = {
        "song_counts": F.col("artist").isNotNull(),
        "pos_interactions": F.col("page").isin(list(POSITIVE_PAGES)),
        "neg_interactions": F.col("page").isin(list(NEGATIVE_PAGES)),
        "unique_locations": F.col("location").isNotNull(),
        "label": F.col("page").isin(list(CHURN_PAGES)),
    }
    users = log.groupBy(USER).agg(*(F.count_if(has).alias(name) for name, has in present.items()))
    missing = users.agg(*(F.count_if(F.col(name) == 0).alias(name) for name in present))
    return missing.unpivot([], list(present), "feature", "missing_users")

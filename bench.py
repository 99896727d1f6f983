"""Times headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the data folder, ``BENCH_CPUS`` the local threads. Each query runs twice
into a sink that discards rows; the faster run counts. ``comparison`` holds the same user features
built the usual way: one scan, fill and join per feature.
"""

import json
import os
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ebbline import schema
from ebbline.operators import clean
from ebbline.plans.catalog import QUERIES
from ebbline.sources import sample_log

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = 2

HEADLINE = (
    "user_features",
    "user_features_bucketed",
    "feature_matrix",
    "core_features",
    "churn_label",
    "page_pivot",
    "user_agents",
    "session_gaps",
    "event_gaps",
    "flag_cancelled_users",
    "dedup_latest",
    "churn_by_state",
    "churn_by_gender",
    "page_share",
    "avg_page_visits",
    "songs_by_weekday",
    "songs_by_day_hour",
    "null_profile",
    "null_cooccurrence",
    "describe_by_label",
    "winsorize",
    "feature_correlations",
    "feature_skew",
    "outlier_counts",
    "validation_report",
    "knn_classify",
    "train_logistic",
)


def feature_by_feature(spark, sf_dir):
    """Core features as separate filtered aggregations, each zero-filled and then joined."""
    log = clean.clean_log(sample_log(spark, sf_dir))
    users = clean.unique_users(log)
    page = F.col("page")

    def count(rows, name, measure=None):
        table = log.filter(rows).groupBy("userId").agg((F.count("*") if measure is None else measure).alias(name))
        return clean.zero_fill_union(table, users)

    level = clean.latest_rows(log.select("userId", "level", "ts"), ["userId"], [F.desc("ts")])
    wide = count(page.isin(list(schema.CHURN_PAGES)), "label", F.lit(1))
    for table in (
        count(F.col("artist").isNotNull(), "song_counts"),
        level.select("userId", (F.col("level") == "paid").cast("int").alias("level_flag")),
        count(page.isin(list(schema.POSITIVE_PAGES)), "pos_interactions"),
        count(page.isin(list(schema.NEGATIVE_PAGES)), "neg_interactions"),
        count(F.col("location").isNotNull(), "unique_locations", F.count_distinct("location")),
    ):
        wide = wide.join(table, "userId", "outer")
    return wide


def seconds(build, spark) -> float:
    best = float("inf")
    for _ in range(RUNS):
        start = time.perf_counter()
        build(spark, SF_DIR).write.format("noop").mode("overwrite").save()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("ebbline-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["row_count"](spark, SF_DIR).collect()
    queries = {name: seconds(QUERIES[name], spark) for name in HEADLINE}
    comparison = {"core_features_by_feature": seconds(feature_by_feature, spark)}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(queries.values()), 3),
                "unit": "sec",
                "queries": queries,
                "comparison": comparison,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()

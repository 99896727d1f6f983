"""Wide per-user feature rows in one aggregation of the log."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbline.operators import features as f
from ebbline.operators.scalars import with_varied
from ebbline.schema import (
    BROWSER_FAMILIES,
    CHURN_PAGES,
    DEVICE_FAMILIES,
    NEGATIVE_PAGES,
    PIVOT_EXCLUDED_PAGES,
    PIVOT_PAGES,
    POSITIVE_PAGES,
    USER,
)
from ebbline.sources.scratch import materialize


def core_features(
    log: DataFrame,
    label_pages: Iterable[str] = CHURN_PAGES,
    positive_pages: Iterable[str] = POSITIVE_PAGES,
) -> DataFrame:
    """The batch job's row: label and five features for every user."""
    return log.groupBy(USER).agg(
        f._ever(label_pages).alias("label"),
        F.count("artist").alias("song_counts"),
        f._latest_level_flag().alias("level_flag"),
        f._page_hits(positive_pages).alias("pos_interactions"),
        f._page_hits(NEGATIVE_PAGES).alias("neg_interactions"),
        F.count_distinct("location").alias("unique_locations"),
    )


def _distinct_counts(log: DataFrame, **values: Column) -> DataFrame:
    """Distinct non-null values per user. Values ride alone as (user, kind, text), not beside the wide row of counters
    that several distinct aggregates in one would repeat for each kind. An exchange is only needed where the log is
    not already laid out by user."""
    pairs = [F.struct(F.lit(i).alias("kind"), v.cast("string").alias("value")) for i, v in enumerate(values.values())]
    rows = log.select(USER, F.inline(F.array(*pairs))).filter(F.col("value").isNotNull())
    counts = {name: F.count_if(F.col("kind") == i) for i, name in enumerate(values)}
    return rows.distinct().groupBy(USER).agg(*(count.alias(name) for name, count in counts.items()))


def user_features(
    log: DataFrame,
    label_pages: Iterable[str] = CHURN_PAGES,
    positive_pages: Iterable[str] = POSITIVE_PAGES,
) -> DataFrame:
    """Label and every scalar feature for every user; averages without data are null."""
    counters = log.groupBy(USER).agg(
        f._ever(label_pages).alias("label"),
        F.count("artist").alias("song_counts"),
        f._latest_level_flag().alias("level_flag"),
        f._page_hits(positive_pages).alias("pos_interactions"),
        f._page_hits(NEGATIVE_PAGES).alias("neg_interactions"),
        f._tenure_days().alias("days_since_registration"),
    )
    kinds = ("unique_locations", "distinct_artist", "unique_sessions")
    distinct = _distinct_counts(
        log,
        unique_locations=F.col("location"),
        distinct_artist=F.col("artist"),
        unique_sessions=F.col("sessionId"),
        _days=f._play_day(),
    )
    # Both sides lie by user, so joining them moves nothing.
    joined = counters.join(distinct, USER, "left")
    listens = F.round(F.try_divide("song_counts", "_days")).alias("avg_daily_listens")
    counts = {name: F.coalesce(name, F.lit(0)).alias(name) for name in kinds}
    return joined.select(
        USER, "label", "song_counts", listens, "level_flag", "pos_interactions", "neg_interactions",
        counts["unique_locations"], counts["distinct_artist"], "days_since_registration", counts["unique_sessions"],
    )


def feature_matrix(
    log: DataFrame,
    mode: str = "complete_case",
    use_log: bool = False,
    scope: str = "all",
    label_pages: Iterable[str] = CHURN_PAGES,
    positive_pages: Iterable[str] = POSITIVE_PAGES,
    pages: Sequence[str] = PIVOT_PAGES,
    devices: Sequence[str] = DEVICE_FAMILIES,
    browsers: Sequence[str] = BROWSER_FAMILIES,
) -> DataFrame:
    """Training matrix: label, activity, page counts, agent flags, tenure, sessions.

    ``complete_case`` drops users who lack plays, pages or a registration; ``all_users`` keeps
    them with nulls. ``use_log`` takes ``log1p`` of features with more than two distinct values:
    every one, or with ``scope="first"`` only the first column of each feature group.
    """
    if mode not in ("complete_case", "all_users"):
        raise ValueError(f"unknown mode {mode!r}")
    page = F.col("page")
    # Distinct counts shuffle one row per distinct pair. They are aggregated apart from the wide
    # row of counters, which would ride on each of those rows, and agent strings are parsed once
    # per user and string. Every part ends up partitioned by user and reads its own columns of the
    # log, so joining them moves nothing.
    distincts = log.groupBy(USER).agg(
        F.round(f._daily_listens()).alias("avg_daily_listens"),
        F.count_distinct("artist").alias("distinct_artist"),
        F.count_distinct("sessionId").alias("unique_sessions"),
    )
    counters = log.groupBy(USER).agg(
        f._ever(label_pages).alias("label"),
        F.count("artist").alias("song_counts"),
        f._latest_level_flag().alias("level_flag"),
        f._page_hits(positive_pages).alias("pos_interactions"),
        f._page_hits(NEGATIVE_PAGES).alias("neg_interactions"),
        F.count_if(~page.isin(list(PIVOT_EXCLUDED_PAGES))).alias("_pages"),
        *(F.count_if(page == name).alias(name) for name in pages),
        f._tenure_days().alias("days_since_registration"),
    )
    agents = list(f.agent_flags(devices, browsers))
    first, last = ["song_counts", "avg_daily_listens"], ["distinct_artist", "days_since_registration"]
    usage = ["level_flag", "pos_interactions", "neg_interactions"]
    order = [USER, "label", *first, *usage, *pages, *agents, *last, "unique_sessions"]
    matrix = counters.join(distincts, USER).join(f.user_agents(log, devices, browsers), USER)
    visited = F.col("_pages") > 0
    matrix = matrix.withColumns({name: F.when(visited, F.col(f"`{name}`")) for name in pages})
    matrix = matrix.select(*(F.col(f"`{name}`") for name in order))
    if use_log:
        single = [c for c in matrix.columns if c not in (USER, "label", *pages, *agents)]
        groups = [[c] for c in single] + [list(pages), agents]
        logged = [c for g in groups for c in (g if scope == "all" else g[:1])]
        matrix = log_features(
            materialize(matrix, "feature-matrix"), logged, null_counts=["days_since_registration"]
        )
    return matrix.dropna() if mode == "complete_case" else matrix


def log_features(
    df: DataFrame, columns: Sequence[str], null_counts: Sequence[str] = ()
) -> DataFrame:
    """``log1p`` of each column that has more than two distinct values.

    Null is no value, except in columns named in ``null_counts``. Reads ``df`` several times, so
    pass a written table. The columns become doubles.
    """
    varied = with_varied(df, columns, "_varied", null_counts)
    logged = {
        c: F.when(F.col("_varied")[c], F.log1p(F.col(f"`{c}`"))).otherwise(
            F.col(f"`{c}`").cast("double")
        )
        for c in columns
    }
    return varied.withColumns(logged).drop("_varied")

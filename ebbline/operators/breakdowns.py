"""Churn breakdowns by page, level, place, agent and time.

Rows never have a user's churn flag joined to them. Counts are first reduced to (user, dimension),
which combines map-side, and the flag is spread over the few reduced rows a user has left. A null
user (someone not logged in) counts as not churned.
"""

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions import day_name, event_hour, flag_in, state_of, whole_days_between
from ebbline.operators.features import with_agent_families
from ebbline.schema import (
    CHURN_PAGES,
    PLAY_PAGE,
    SERVICE_EXIT_PAGES,
    SERVICE_PAGES,
    THUMBS_PAGES,
    USER,
    WEEKDAYS,
)


def _user_counts(
    log: DataFrame,
    dimensions: Mapping[str, Column],
    hit: Column,
    churn_pages: Iterable[str] = CHURN_PAGES,
) -> DataFrame:
    """Rows (user, dimensions.., cancel_flag, n) with n > 0 hits."""
    page = F.col("page")
    counts = (
        log.filter(hit | page.isin(list(churn_pages)))
        .groupBy(USER, *(column.alias(name) for name, column in dimensions.items()))
        .agg(F.count_if(hit).alias("n"), F.max(flag_in(page, churn_pages)).alias("_churn"))
    )
    flag = F.max("_churn").over(Window.partitionBy(USER))
    return (
        counts.withColumn("cancel_flag", F.when(F.col(USER).isNull(), 0).otherwise(flag))
        .filter("n > 0")
        .drop("_churn")
    )


def _mean_per_user(counts: DataFrame, dimension: str, name: str) -> DataFrame:
    return (
        counts.filter(F.col(dimension).isNotNull())
        .groupBy("cancel_flag", dimension)
        .agg(F.avg("n").alias(name))
    )


def churn_rate(log: DataFrame, pages: Iterable[str] = CHURN_PAGES) -> DataFrame:
    users = log.groupBy(USER).agg(F.max(flag_in(F.col("page"), pages)).alias("flag"))
    totals = users.agg(
        F.coalesce(F.sum("flag"), F.lit(0)).alias("churned_users"), F.count("*").alias("users")
    )
    share = F.try_divide(F.col("churned_users"), F.col("users"))
    return totals.withColumn("churn_percent", F.round(share, 4) * 100)


def _latest_value_per_user(log: DataFrame, column: str) -> DataFrame:
    """(user, value of the latest event, cancel_flag); ties go to the greater value.

    Reduced to one time per (user, value) first, a hash aggregation with map-side combine; only
    those few rows reach the non-hashable ``max_by``.
    """
    seen = log.groupBy(USER, column).agg(
        F.max("ts").alias("_ts"), F.max(flag_in(F.col("page"), CHURN_PAGES)).alias("_churn")
    )
    return seen.groupBy(USER).agg(
        F.max_by(column, F.struct("_ts", column)).alias(column),
        F.max("_churn").alias("cancel_flag"),
    )


def churn_by_gender(log: DataFrame) -> DataFrame:
    users = _latest_value_per_user(log, "gender").dropna(subset=["gender"])
    return users.groupBy("gender", "cancel_flag").agg(F.count("*").alias("count"))


def users_by_state(log: DataFrame) -> DataFrame:
    users = _latest_value_per_user(log, "location").dropna(subset=["location"])
    return users.groupBy(state_of(F.col("location")).alias("state"), "cancel_flag").agg(
        F.count("*").alias("count")
    )


def top_states(by_state: DataFrame, k: int = 5) -> DataFrame:
    order = [F.col("count").desc(), F.col("state"), F.col("cancel_flag")]
    return by_state.orderBy(*order).limit(k).select("state", "cancel_flag", "count")


def churn_by_state(by_state: DataFrame) -> DataFrame:
    """Per state: users, cancellations, share of all cancellations, and rate within the state.

    The total runs over one row per state.
    """
    states = by_state.groupBy("state").agg(
        F.sum("count").alias("total_count"),
        F.sum(F.col("count") * F.col("cancel_flag")).alias("cancellation_count"),
    )
    everywhere = F.sum("cancellation_count").over(Window.partitionBy())
    return states.withColumns(
        {
            "churn_share": F.try_divide(F.col("cancellation_count"), everywhere) * 100,
            "churn_rate": F.col("cancellation_count") / F.col("total_count") * 100,
        }
    )


def cancel_by_agent(log: DataFrame, pages: Iterable[str] = CHURN_PAGES) -> DataFrame:
    cancels = with_agent_families(log.filter(F.col("page").isin(list(pages))))
    return cancels.groupBy("browser", "device").agg(F.count("*").alias("count"))


def distinct_agents(log: DataFrame) -> DataFrame:
    """Distinct (browser, device) pairs; each agent string is parsed once."""
    return with_agent_families(log.select("userAgent").distinct()).select(
        "browser", "device"
    ).distinct()


def page_counts(log: DataFrame) -> DataFrame:
    """Visits per (page, cancel_flag)."""
    counts = _user_counts(log, {"page": F.col("page")}, F.lit(True))
    return counts.groupBy("page", "cancel_flag").agg(F.sum("n").alias("n"))


def page_share(counts: DataFrame) -> DataFrame:
    """Visits by churned and other users for pages both groups visited."""
    churned = F.col("cancel_flag") == 1
    pages = counts.groupBy("page").agg(
        F.sum(F.when(churned, F.col("n"))).alias("cancelled"),
        F.sum(F.when(~churned, F.col("n"))).alias("not_cancelled"),
    )
    return _with_share(pages.dropna(subset=["cancelled", "not_cancelled"]))


def page_share_join(counts: DataFrame) -> DataFrame:
    """``page_share`` as an inner join of the two groups' page counts."""

    def side(flag: int, name: str) -> DataFrame:
        return counts.filter(F.col("cancel_flag") == flag).select("page", F.col("n").alias(name))

    return _with_share(side(1, "cancelled").join(side(0, "not_cancelled"), "page"))


def _with_share(pages: DataFrame) -> DataFrame:
    total = F.col("cancelled") + F.col("not_cancelled")
    return pages.withColumns(
        {"total": total, "percentage_from_cancelled": F.col("cancelled") / total}
    )


def avg_visits_by_level(
    log: DataFrame, pages: Iterable[str] | None = None, name: str = "mean_page_visits"
) -> DataFrame:
    """Mean over users of page visits, by churn flag and level; all pages or only ``pages``."""
    page = F.col("page")
    hit = page.isNotNull() if pages is None else page.isin(list(pages))
    return _mean_per_user(_user_counts(log, {"level": F.col("level")}, hit), "level", name)


def avg_songs_by_level(log: DataFrame) -> DataFrame:
    return avg_visits_by_level(log, [PLAY_PAGE])


def avg_thumbs_by_level(log: DataFrame, rounded: bool = False) -> DataFrame:
    means = avg_visits_by_level(log, THUMBS_PAGES, "mean_thumbs_interactions")
    if not rounded:
        return means
    # Half-even, like the dataframe rounding it replaces.
    return means.withColumn("mean_thumbs_interactions", F.bround("mean_thumbs_interactions", 0))


def service_change_counts(log: DataFrame, pages: Sequence[str] = SERVICE_PAGES) -> DataFrame:
    counts = log.filter(F.col("page").isin(list(pages))).groupBy("page")
    return counts.agg(F.count("*").alias("count")).orderBy(F.desc("count"), "page")


def service_funnel(log: DataFrame, pages: Sequence[str] = SERVICE_EXIT_PAGES) -> DataFrame:
    """Visits of known users per exit page, largest first."""
    known = log.filter(F.col(USER).isNotNull())
    return service_change_counts(known, pages).withColumnsRenamed(
        {"page": "stage", "count": "number"}
    )


def artist_play_histogram(log: DataFrame, more_than: int = 10) -> DataFrame:
    """How many artists have each play count, for counts more than ``more_than`` artists share."""
    plays = log.dropna(subset=["artist"]).groupBy("artist").agg(F.count("*").alias("song_plays"))
    frequencies = plays.groupBy("song_plays").agg(F.count("*").alias("count"))
    return frequencies.filter(F.col("count") > more_than)


def _plays(log: DataFrame, **dimensions: Column) -> DataFrame:
    return _user_counts(log, dimensions, F.col("page").isin([PLAY_PAGE]))


def songs_by_weekday(log: DataFrame) -> DataFrame:
    plays = _plays(log, day_of_week=day_name(F.col("ts")))
    position = F.array_position(F.array(*map(F.lit, WEEKDAYS)), F.col("day_of_week"))
    means = _mean_per_user(plays, "day_of_week", "mean_song_listens")
    return means.orderBy("cancel_flag", position)


def hourly_plays(log: DataFrame) -> DataFrame:
    plays = _plays(log, hour_of_day=event_hour(F.col("ts")))
    return plays.select("cancel_flag", USER, "hour_of_day", F.col("n").alias("sum_hourly_plays"))


def songs_by_hour(log: DataFrame) -> DataFrame:
    plays = _plays(log, hour_of_day=event_hour(F.col("ts")))
    return _mean_per_user(plays, "hour_of_day", "mean_hourly_listens")


def songs_by_day_hour(log: DataFrame) -> DataFrame:
    """Plays per weekday, hour and churn flag, averaged over the flags."""
    listened = F.col("page").isin([PLAY_PAGE]) & F.col("artist").isNotNull()
    slots = {"day_of_week": day_name(F.col("ts")), "hour_of_day": event_hour(F.col("ts"))}
    by_flag = (
        _user_counts(log, slots, listened).groupBy(*slots, "cancel_flag").agg(F.sum("n").alias("n"))
    )
    return by_flag.groupBy(*slots).agg(F.avg("n").alias("mean_hourly_listens"))


def registration_age(log: DataFrame) -> DataFrame:
    """Per event: seconds since registration, and whole days from registration to the last event."""
    last = log.agg(F.max("ts")).scalar()
    return log.withColumns(
        {
            "life_time": (F.col("ts") - F.col("registration")) / 1000,
            "day_since_registration": whole_days_between(F.col("registration"), last),
        }
    )


def songs_listened(log: DataFrame) -> DataFrame:
    """Plays per user with any, users not logged in counted as one."""
    plays = log.filter(F.col("artist").isNotNull())
    return plays.groupBy(USER).agg(F.count("*").alias("count"))


def page_interactions(log: DataFrame, pages: Iterable[str]) -> DataFrame:
    """Visits to ``pages`` per known user with any."""
    visits = log.filter(F.col("page").isin(list(pages)) & F.col(USER).isNotNull())
    return visits.groupBy(USER).agg(F.count("*").alias("count"))

"""Per-user features.

Each feature is one aggregate expression over the whole log grouped by user, so users without the
activity come out as 0 with no fill step, and any set of features is a single aggregation. All
buffers are fixed-width (hash aggregation) and combine map-side, so a user who owns a large share
of the log sends one partial row per task.
"""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbline.functions import agent_text, browser_family, device_family, flag_in, level_flag
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

DAY_MS = 86400000
NO_DAY = -(2**40)


def _page_hits(pages: Iterable[str]) -> Column:
    return F.count_if(F.col("page").isin(list(pages)))


def _ever(pages: Iterable[str]) -> Column:
    return F.max(flag_in(F.col("page"), pages))


def _latest_level_flag() -> Column:
    """Flag of the latest event, ``paid`` on ties: time and flag share one long."""
    flag = level_flag(F.col("level")).cast("long")
    no_time = F.lit(-(2**62))
    return F.pmod(F.max(F.coalesce(F.col("ts") * 2, no_time) + flag), F.lit(2)).cast("int")


def _play_day() -> Column:
    """Day of a play, null for other events; plays without a time share a day of their own."""
    day = F.coalesce(F.floor(F.col("ts") / DAY_MS), F.lit(NO_DAY))
    return F.when(F.col("artist").isNotNull(), day)


def _daily_listens() -> Column:
    """Mean over play days of plays per day = plays / distinct play days."""
    return F.try_divide(F.count("artist"), F.count_distinct(_play_day()))


def _tenure_days() -> Column:
    return F.round(F.max(F.col("ts") - F.col("registration")) / DAY_MS)


def _per_user(log: DataFrame, **features: Column) -> DataFrame:
    return log.groupBy(USER).agg(*(column.alias(name) for name, column in features.items()))


def churn_label(log: DataFrame, pages: Iterable[str] = CHURN_PAGES) -> DataFrame:
    return _per_user(log, label=_ever(pages))


def song_counts(log: DataFrame) -> DataFrame:
    return _per_user(log, song_counts=F.count("artist"))


def distinct_artist(log: DataFrame) -> DataFrame:
    return _per_user(log, distinct_artist=F.count_distinct("artist"))


def unique_locations(log: DataFrame) -> DataFrame:
    return _per_user(log, unique_locations=F.count_distinct("location"))


def unique_sessions(log: DataFrame) -> DataFrame:
    return _per_user(log, unique_sessions=F.count_distinct("sessionId"))


def positive_usage(log: DataFrame, pages: Iterable[str] = POSITIVE_PAGES) -> DataFrame:
    return _per_user(log, pos_interactions=_page_hits(pages))


def negative_usage(log: DataFrame, pages: Iterable[str] = NEGATIVE_PAGES) -> DataFrame:
    return _per_user(log, neg_interactions=_page_hits(pages))


def user_level(log: DataFrame) -> DataFrame:
    return _per_user(log, level_flag=_latest_level_flag())


def avg_daily_listens(log: DataFrame, rounded: bool = True, zero_filled: bool = False) -> DataFrame:
    """Null for users without plays unless ``zero_filled``."""
    mean = F.round(_daily_listens()) if rounded else _daily_listens()
    return _per_user(log, avg_daily_listens=F.coalesce(mean, F.lit(0.0)) if zero_filled else mean)


def days_since_registration(log: DataFrame) -> DataFrame:
    return _per_user(log, days_since_registration=_tenure_days())


def page_pivot(
    log: DataFrame,
    pages: Sequence[str] = PIVOT_PAGES,
    excluded: Iterable[str] | None = PIVOT_EXCLUDED_PAGES,
) -> DataFrame:
    """Visits per user and page, pages as columns.

    Users have a row if they visited any page outside ``excluded`` (any of ``pages`` if that is
    None), whether or not it has a column.
    """
    page = F.col("page")
    rows = page.isin(list(pages)) if excluded is None else ~page.isin(list(excluded))
    return (
        log.filter(rows).groupBy(USER).agg(*(F.count_if(page == name).alias(name) for name in pages))
    )


def discover_pages(
    log: DataFrame, excluded: Iterable[str] = PIVOT_EXCLUDED_PAGES, at_most: int | None = None
) -> list[str]:
    """Sorted page names in the log, for ``page_pivot`` over a log with unknown pages.

    Page names become columns; more than ``at_most`` of them, if given, is an error, never a cut.
    """
    names = log.filter(~F.col("page").isin(list(excluded))).select("page").distinct()
    found = [row.page for row in (names if at_most is None else names.limit(at_most + 1)).collect()]
    if at_most is not None and len(found) > at_most:
        raise ValueError(f"more than {at_most} distinct pages")
    return sorted(found)


def with_agent_families(log: DataFrame) -> DataFrame:
    """Add ``device`` and ``browser``; the text is cleaned once, in a step of its own."""
    text = F.col("_agent")
    families = {"device": device_family(text), "browser": browser_family(text)}
    return (
        log.withColumn("_agent", agent_text(F.col("userAgent"))).withColumns(families).drop("_agent")
    )


def agent_flags(
    devices: Sequence[str] = DEVICE_FAMILIES, browsers: Sequence[str] = BROWSER_FAMILIES
) -> dict[str, Column]:
    """Whether a user ever used each device and browser family."""
    return {
        f"{kind}_{name}": F.max((F.col(kind) == name).cast("int"))
        for kind, names in (("device", devices), ("browser", browsers))
        for name in names
    }


def user_agents(
    log: DataFrame,
    devices: Sequence[str] = DEVICE_FAMILIES,
    browsers: Sequence[str] = BROWSER_FAMILIES,
) -> DataFrame:
    """Device and browser flags per user; each (user, agent string) is parsed once."""
    pairs = with_agent_families(log.select(USER, "userAgent").distinct())
    return _per_user(pairs, **agent_flags(devices, browsers))


def user_agents_discovered(log: DataFrame) -> DataFrame:
    """``user_agents`` with a flag for every family that occurs in the log, so no user is left without one."""
    pairs = with_agent_families(log.select(USER, "userAgent").distinct())
    found = pairs.agg(F.collect_set("device").alias("device"), F.collect_set("browser").alias("browser")).first()
    return _per_user(pairs, **agent_flags(sorted(found.device), sorted(found.browser)))


def session_gaps(log: DataFrame, unit: int = 10000, zero_filled: bool = False) -> DataFrame:
    """Mean gap between a user's consecutive events within sessions, in ``unit`` milliseconds.

    The gaps of a session add up to last - first over one less than its events, so no ordered
    window is needed and sessions of any length combine map-side.
    """
    sessions = log.groupBy(USER, "sessionId").agg(
        (F.max("ts") - F.min("ts")).alias("span"), (F.count("ts") - 1).alias("gaps")
    )
    gaps = F.sum(F.when(F.col("gaps") > 0, F.col("gaps")))
    mean = F.round(F.try_divide(F.sum("span") / unit, gaps))
    return _per_user(
        sessions,
        avg_time_between_sessions=F.coalesce(mean, F.lit(0.0)) if zero_filled else mean,
    )


def between_session_gaps(log: DataFrame, unit: int = DAY_MS) -> DataFrame:
    """Mean time from one session's first event to the next one's, per user."""
    sessions = log.groupBy(USER, "sessionId").agg(F.min("ts").alias("start"))
    starts = F.max("start") - F.min("start")
    return _per_user(
        sessions, avg_session_interval=F.try_divide(starts / unit, F.count("start") - 1)
    )


def event_gaps(log: DataFrame, event_key: str, unit: int = 10000, slice_ms: int = 60000) -> DataFrame:
    """Time since the previous event of the same user and session, on every event.

    Events are first reduced to distinct instants. Instants are ordered within slices of
    ``slice_ms``, so no window holds more than ``slice_ms`` rows, and the first instant of a slice
    looks up the last one of the previous slice. Events sharing an instant follow each other in
    ``event_key`` order with gap 0.
    """
    session = [USER, "sessionId"]
    instants = materialize(
        log.filter(F.col("ts").isNotNull())
        .groupBy(*session, "ts")
        .agg(F.min(event_key).alias("_first"))
        .withColumn("_slice", F.floor(F.col("ts") / slice_ms)),
        "instants",
    )
    in_slice = Window.partitionBy(*session, "_slice").orderBy("ts")
    slices = instants.groupBy(*session, "_slice").agg(F.max("ts").alias("_last"))
    across = Window.partitionBy(*session).orderBy("_slice")
    heads = slices.withColumn("_before", F.lag("_last").over(across)).drop("_last")
    previous = F.coalesce(F.lag("ts").over(in_slice), F.col("_before"))
    # Null users and sessions are groups of their own, as in a window.
    heads = heads.select(*(F.col(c).alias(f"_h_{c}") for c in (*session, "_slice")), "_before")
    own = [F.col(c).eqNullSafe(F.col(f"_h_{c}")) for c in session] + [F.col("_slice") == F.col("_h__slice")]
    gaps = instants.join(heads, own).select(*session, "ts", "_first", (F.col("ts") - previous).alias("_gap"))
    keyed = log.select(event_key, *session, "ts")
    same = [keyed[c].eqNullSafe(gaps[c]) for c in (*session, "ts")]
    gap = F.when(F.col(event_key).eqNullSafe(F.col("_first")), F.col("_gap")).otherwise(F.lit(0))
    return keyed.join(gaps, same, "left").select(
        *(keyed[c] for c in keyed.columns),
        F.when(keyed["ts"].isNotNull(), gap / unit).alias("session_duration"),
    )

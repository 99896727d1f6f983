"""The same results as SQL for an independent engine, by query name."""

from itertools import combinations

from ebbline import schema
from ebbline.plans.catalog import FEATURES, KNN_FEATURES, LOG_COLUMNS, POSITIONS
from ebbline.sources.sample_log import (
    CLICK_PAGES,
    DAY_MS,
    FIRST_REGISTRATION,
    PURCHASE_PAGES,
    STATES,
    USER_AGENTS,
)

ORACLES: dict[str, str] = {}


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "(" + ", ".join(_text(v) for v in values) + ")"


def _pick(values, index: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {_text(v)}" for i, v in enumerate(values))
    return f"CASE {index} {cases} END"


def _name(name: str) -> str:
    return '"' + name + '"'


LOG = f"""
WITH keyed AS (
  SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k
  FROM events
), user_log AS (
  SELECT event_id,
    CASE WHEN user_id % 29 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS userId,
    us // 1000 AS ts,
    CASE event_type
      WHEN 'view' THEN 'NextSong'
      WHEN 'click' THEN {_pick(CLICK_PAGES, "k % 5")}
      WHEN 'error' THEN CASE WHEN k % 2 = 0 THEN 'Error' ELSE 'Help' END
      WHEN 'purchase' THEN {_pick(PURCHASE_PAGES, "k % 4")}
      ELSE CASE WHEN value > 200 THEN 'Cancellation Confirmation'
                WHEN value > 180 THEN 'Cancel' ELSE 'Settings' END
    END AS page,
    CASE WHEN event_type = 'view' THEN 'artist_' || k END AS artist,
    CASE WHEN k % 3 = 0 THEN 'free' ELSE 'paid' END AS level,
    CASE WHEN user_id % 29 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CASE WHEN k <> 0 THEN 'City' || (user_id % 7) || ', ' || {_pick(STATES, "(user_id + k % 2) % 4")}
    END AS location,
    CASE WHEN user_id % 29 <> 0
      THEN {FIRST_REGISTRATION} + (user_id % 100) * {DAY_MS} END AS registration,
    us // 86400000000 AS sessionId,
    {_pick(USER_AGENTS, "k % 6")} AS userAgent
  FROM keyed
), raw AS (SELECT * REPLACE (nullif(userId, '') AS userId) FROM user_log),
log AS (SELECT * FROM user_log WHERE userId <> ''),
users AS (SELECT DISTINCT userId FROM log),
flags AS (
  SELECT userId, max(CAST(page = 'Cancellation Confirmation' AS INTEGER)) AS cancel_flag
  FROM log GROUP BY userId
), flagged AS (
  SELECT raw.*, coalesce(cancel_flag, 0) AS cancel_flag FROM raw LEFT JOIN flags USING (userId)
)"""

POSITIVE, NEGATIVE = _list(schema.POSITIVE_PAGES), _list(schema.NEGATIVE_PAGES)
TENURE = "round(max((ts - registration) / 86400000.0))"
LEVEL_FLAG = "CAST(coalesce(last(level ORDER BY ts, level) = 'paid', false) AS INTEGER)"
LISTENS = (
    "count(artist) / CAST(nullif(count(DISTINCT CASE WHEN artist IS NOT NULL THEN ts // 86400000 END), 0)"
    " AS DOUBLE)"
)
SCALARS = {
    "label": "max(CAST(page = 'Cancellation Confirmation' AS INTEGER))",
    "song_counts": "count(artist)",
    "avg_daily_listens": f"round({LISTENS})",
    "level_flag": LEVEL_FLAG,
    "pos_interactions": f"count(*) FILTER (page IN {POSITIVE})",
    "neg_interactions": f"count(*) FILTER (page IN {NEGATIVE})",
    "unique_locations": "count(DISTINCT location)",
    "distinct_artist": "count(DISTINCT artist)",
    "days_since_registration": TENURE,
    "unique_sessions": "count(DISTINCT sessionId)",
}
CORE = ("label", "song_counts", "level_flag", "pos_interactions", "neg_interactions", "unique_locations")


def _aliased(names) -> str:
    return ", ".join(f"{SCALARS[n]} AS {n}" for n in names)


UF = LOG + f""", uf AS (SELECT userId, {_aliased(SCALARS)} FROM log GROUP BY userId)"""
CF = LOG + f""", cf AS (SELECT userId, {_aliased(CORE)} FROM log GROUP BY userId)"""


def _oracle(name: str, body: str, head: str = LOG) -> None:
    ORACLES[name] = f"{head}\n{body}"


# Scans and sinks

_oracle("scan_json", f"SELECT {', '.join(LOG_COLUMNS)} FROM user_log")
_oracle(
    "scan_csv",
    # An empty CSV field reads as null.
    "SELECT " + ", ".join(f"nullif(CAST({c} AS VARCHAR), '') AS {c}" for c in LOG_COLUMNS) + " FROM user_log",
)
_oracle(
    "load_feature_file",
    """SELECT format, CAST(song_counts AS DOUBLE) AS song_counts, CAST(level_flag AS DOUBLE) AS level_flag,
    CAST(unique_locations AS DOUBLE) AS unique_locations, CAST(label AS DOUBLE) AS label
    FROM cf, (VALUES ('csv'), ('json'), ('parquet')) AS formats(format)""",
    CF,
)
_oracle(
    "sink_roundtrip",
    """SELECT CASE WHEN sink <> 'append' THEN userId END AS userId, cf.* EXCLUDE (userId), sink
    FROM cf, (VALUES ('csv'), ('json'), ('append')) AS sinks(sink)""",
    CF,
)
_oracle(
    "sql_view",
    """SELECT page, count(*) AS visits, count(DISTINCT userId) AS users,
    (SELECT count(*) FROM raw) AS all_rows FROM log GROUP BY page""",
)

# Cleaning, flags, filling

_oracle(
    "clean_log",
    """SELECT event_id, userId, artist, ts, page, level, location, CAST(userId AS INTEGER) AS user_number
    FROM log""",
)
_oracle(
    "clean_log_keep_blank",
    "SELECT userId, max(CAST(page = 'Cancellation Confirmation' AS INTEGER)) AS label FROM user_log GROUP BY 1",
)
_oracle(
    "limit_rows",
    f"SELECT event_id, {', '.join(LOG_COLUMNS)} FROM user_log ORDER BY event_id LIMIT 10",
)
_oracle(
    "flag_rows",
    f"""SELECT event_id, artist, page, CAST(page IN {NEGATIVE} AS INTEGER) AS negative_flag,
    CAST(coalesce(artist IN ('artist_1', 'artist_2'), false) AS INTEGER) AS artist_flag FROM raw""",
)
_oracle("flag_cancelled_users", "SELECT event_id, userId, page, cancel_flag FROM flagged")
_oracle("zero_fill", 'SELECT userId, count(artist) AS "count" FROM log GROUP BY userId')
_oracle(
    "zero_fill_union",
    """SELECT userId, count(*) FILTER (page = 'Error') AS "count" FROM log GROUP BY userId""",
)
_oracle(
    "missing_users",
    """SELECT userId FROM users EXCEPT
    SELECT userId FROM log WHERE page = 'Cancellation Confirmation'""",
)
_oracle(
    "dedup_latest",
    """SELECT userId, ts, event_id, page, level, location FROM log
    QUALIFY row_number() OVER (PARTITION BY userId ORDER BY ts DESC, event_id DESC) = 1""",
)
_oracle(
    "index_select",
    f"""SELECT event_id, userId, ts, page FROM user_log
    QUALIFY row_number() OVER (ORDER BY event_id) - 1 IN {POSITIONS}""",
)

# Per-user features


def _per_user(name: str, **columns: str) -> None:
    aliased = ", ".join(f"{sql} AS {_name(n)}" for n, sql in columns.items())
    _oracle(name, f"SELECT userId, {aliased} FROM log GROUP BY userId")


for _query, _column in {
    "song_counts": "song_counts",
    "distinct_artist": "distinct_artist",
    "unique_locations": "unique_locations",
    "unique_sessions": "unique_sessions",
    "positive_usage": "pos_interactions",
    "negative_usage": "neg_interactions",
    "user_level": "level_flag",
    "avg_daily_listens": "avg_daily_listens",
    "days_since_registration": "days_since_registration",
    "churn_label": "label",
}.items():
    _per_user(_query, **{_column: SCALARS[_column]})

_per_user(
    "churn_label_wide",
    label=f"max(CAST(page IN {_list(schema.CHURN_PAGES_WIDE)} AS INTEGER))",
)
_per_user(
    "positive_usage_misspelt",
    pos_interactions=f"count(*) FILTER (page IN {_list(schema.POSITIVE_PAGES_MISSPELT)})",
)
_per_user(
    "avg_daily_listens_filled",
    avg_daily_listens=f"coalesce(round({LISTENS}, 6), 0.0::DOUBLE)",
)
PAGES = {p: f"count(*) FILTER (page = {_text(p)})" for p in schema.PIVOT_PAGES}
EXIT_PAGES = {p: f"count(*) FILTER (page = {_text(p)})" for p in schema.SERVICE_EXIT_PAGES}
PAGE_COLUMNS = ", ".join(f"{sql} AS {_name(p)}" for p, sql in PAGES.items())
EXIT_COLUMNS = ", ".join(f"{sql} AS {_name(p)}" for p, sql in EXIT_PAGES.items())
NOT_EXCLUDED = f"page NOT IN {_list(schema.PIVOT_EXCLUDED_PAGES)}"
PIVOT = f"SELECT userId, {PAGE_COLUMNS} FROM log WHERE {NOT_EXCLUDED} GROUP BY userId"
EXIT_PIVOT = f"""SELECT userId, {EXIT_COLUMNS} FROM log
  WHERE page IN {_list(schema.SERVICE_EXIT_PAGES)} GROUP BY userId"""
_oracle("page_pivot", PIVOT)
_oracle("service_change_pivot", EXIT_PIVOT)
_oracle("service_change_ranked", f'SELECT * FROM ({EXIT_PIVOT}) WHERE "Submit Downgrade" = 1')


# Families of the log's agent strings, in their order, read from the strings by hand.
AGENT_DEVICES = ("Windows", "Mac OS X", "Ubuntu", "iOS", "Windows")
AGENT_BROWSERS = ("Chrome", "Safari", "Firefox", "Mobile Safari", "IE")


def _family(names) -> str:
    cases = " ".join(f"WHEN {_text(agent)} THEN {_text(name)}" for agent, name in zip(USER_AGENTS, names, strict=True))
    return f"CASE userAgent {cases} ELSE 'Other' END"


DEVICE, BROWSER = _family(AGENT_DEVICES), _family(AGENT_BROWSERS)
AGENT_FLAGS = {
    f"{kind}_{family}": f"max(CAST({sql} = {_text(family)} AS INTEGER))"
    for kind, sql, families in (
        ("device", DEVICE, schema.DEVICE_FAMILIES),
        ("browser", BROWSER, schema.BROWSER_FAMILIES),
    )
    for family in families
}
_per_user("user_agents", **AGENT_FLAGS)
_per_user(
    "user_agents_discovered",
    **{
        f"{kind}_{name}": f"max(CAST({sql} = {_text(name)} AS INTEGER))"
        for kind, sql, names in (("device", DEVICE, AGENT_DEVICES), ("browser", BROWSER, AGENT_BROWSERS))
        for name in sorted({*names, "Other"})
    },
)
LOG_PAGES = sorted({*CLICK_PAGES, *PURCHASE_PAGES, "Error", "Help", "Settings"})
_oracle(
    "page_pivot_discovered",
    "SELECT userId, "
    + ", ".join(f"count(*) FILTER (WHERE page = {_text(p)}) AS {_name(p)}" for p in LOG_PAGES)
    + f" FROM log WHERE {NOT_EXCLUDED} GROUP BY userId",
)
GAPS = """gaps AS (SELECT event_id, userId, sessionId, ts,
  (ts - lag(ts) OVER (PARTITION BY userId, sessionId ORDER BY ts, event_id)) / 10000.0 AS session_duration
  FROM log)"""
_oracle(
    "session_gaps",
    "SELECT userId, round(avg(session_duration)) AS avg_time_between_sessions FROM gaps GROUP BY userId",
    f"{LOG}, {GAPS}",
)
_oracle(
    "event_gaps",
    "SELECT event_id, userId, sessionId, ts, round(session_duration, 6) AS session_duration FROM gaps",
    f"{LOG}, {GAPS}",
)
_oracle(
    "event_gaps_raw",
    "SELECT event_id, userId, sessionId, ts, round(session_duration, 6) AS session_duration FROM gaps",
    f"{LOG}, {GAPS.replace('FROM log)', 'FROM raw)')}",
)
_oracle(
    "drop_duplicates",
    "SELECT DISTINCT userId, sessionId, level, location, page FROM raw",
    LOG,
)
_oracle(
    "between_session_gaps",
    """, starts AS (SELECT userId, sessionId, min(ts) AS start FROM log GROUP BY ALL),
    steps AS (SELECT userId, (start - lag(start) OVER (PARTITION BY userId ORDER BY start)) / 86400000.0 AS d
      FROM starts)
    SELECT userId, round(avg(d), 6) AS avg_session_interval FROM steps GROUP BY userId""",
)
_oracle("core_features", "SELECT * FROM cf", CF)
_oracle("features_outer", "SELECT * FROM cf", CF)
_oracle("user_features", "SELECT * FROM uf", UF)
MATRIX = UF + (
    ", agents AS (SELECT userId, "
    + ", ".join(f"{sql} AS {_name(n)}" for n, sql in AGENT_FLAGS.items())
    + f" FROM log GROUP BY userId), pages AS ({PIVOT}), matrix AS ("
    + """SELECT uf.* EXCLUDE (unique_locations), pages.* EXCLUDE (userId), agents.* EXCLUDE (userId)
    FROM uf LEFT JOIN pages USING (userId) LEFT JOIN agents USING (userId))"""
)
MATRIX_COLUMNS = [c for c in SCALARS if c != "unique_locations"] + [*PAGES, *AGENT_FLAGS]
COMPLETE = " AND ".join(f"{_name(c)} IS NOT NULL" for c in MATRIX_COLUMNS)
_oracle("feature_matrix", f"SELECT * FROM matrix WHERE {COMPLETE}", MATRIX)
_oracle(
    "feature_matrix_left",
    f"""SELECT l.userId, l.label, s."count", p.* EXCLUDE (userId), d.days_since_registration
    FROM (SELECT userId, {SCALARS["label"]} AS label FROM log GROUP BY 1) l
    LEFT JOIN (SELECT userId, count(*) AS "count" FROM log WHERE artist IS NOT NULL GROUP BY 1) s USING (userId)
    LEFT JOIN ({PIVOT}) p USING (userId)
    LEFT JOIN (SELECT userId, {TENURE} AS days_since_registration FROM log GROUP BY 1) d USING (userId)""",
)


def _logged(name: str, null_counts: bool) -> str:
    column = _name(name)
    kinds = f"(SELECT count(DISTINCT {column})" + (
        f" + max(CAST({column} IS NULL AS INTEGER))" if null_counts else ""
    ) + " FROM matrix)"
    return f"CASE WHEN {kinds} > 2 THEN round(ln(1 + {column}), 6) ELSE CAST({column} AS DOUBLE) END AS {column}"


def _log_matrix(logged) -> str:
    columns = [
        _logged(c, c == "days_since_registration") if c in logged else _name(c) for c in MATRIX_COLUMNS
    ]
    return "SELECT userId, " + ", ".join(columns) + " FROM matrix"


_oracle("log_features", _log_matrix([c for c in MATRIX_COLUMNS if c != "label"]), MATRIX)
_first = [c for c in SCALARS if c not in ("label", "unique_locations")]
_first += [schema.PIVOT_PAGES[0], schema.DEVICE_COLUMNS[0]]
_oracle("log_features_first", f"{_log_matrix(_first)} WHERE {COMPLETE}", MATRIX)

# Scalar functions

_oracle(
    "time_parts",
    """SELECT event_id, strftime(make_timestamp(ts * 1000), '%Y-%m-%d') AS date,
    CAST(hour(make_timestamp(ts * 1000)) AS INTEGER) AS hour_of_day,
    dayname(make_timestamp(ts * 1000)) AS day_of_week, ts AS millis FROM user_log""",
)
_oracle("ua_families", f"SELECT event_id, {DEVICE} AS device, {BROWSER} AS browser FROM user_log")
_oracle(
    "one_hot",
    "SELECT event_id, "
    + ", ".join(
        f"CAST(({sql}) = {_text(v)} AS INTEGER) AS {_name(f'{kind}_{v}')}"
        for kind, sql, values in (
            ("device", DEVICE, schema.DEVICE_FAMILIES),
            ("level", "level", ("free", "paid")),
        )
        for v in values
    )
    + " FROM user_log",
)
_oracle(
    "one_hot_discovered",
    "SELECT event_id, "
    + ", ".join(
        f"CAST(({sql}) = {_text(v)} AS INTEGER) AS {_name(f'{kind}_{v}')}"
        for kind, sql, values in (
            ("device", DEVICE, sorted({*AGENT_DEVICES, "Other"})),
            ("level", "level", ("free", "paid")),
        )
        for v in values
    )
    + " FROM user_log",
)
DAYS_SINCE = "CAST(floor(((SELECT max(ts) FROM user_log) - registration) / 86400000.0) AS INTEGER)"
_oracle(
    "registration_age",
    f"""SELECT event_id, (ts - registration) / 1000.0 AS life_time,
    {DAYS_SINCE} AS day_since_registration FROM user_log""",
)
_oracle(
    "soft_clip",
    "SELECT userId, "
    + ", ".join(f"round(tanh({c} / 3.0) * 3.0, 6) AS {_name(c + '_softClip')}"
                for c in ("song_counts", "avg_daily_listens"))
    + " FROM uf",
    UF,
)


def _clipped(sql: str, table: str = "uf") -> str:
    low, high = (f"(SELECT quantile_cont(CAST({sql} AS DOUBLE), {p}) FROM {table})" for p in (0.01, 0.99))
    return f"CASE WHEN {sql} IS NOT NULL THEN round(least(greatest({sql}, {low}), {high}), 6) END"


_oracle(
    "winsorize",
    "SELECT userId, "
    + ", ".join(f"{_clipped(c)} AS {_name(c + '_clipped')}"
                for c in ("song_counts", "avg_daily_listens", "days_since_registration"))
    + " FROM uf",
    UF,
)
_oracle(
    "winsorize_log",
    "SELECT userId, "
    + ", ".join(
        f"round(ln(1 + {c}), 6) AS {_name(c + '_log')}, {_clipped(f'ln(1 + {c})')} AS {_name(c + '_logClip')}"
        for c in ("song_counts", "unique_sessions")
    )
    + " FROM uf",
    UF,
)
_oracle(
    "log_and_clip",
    f"""SELECT userId, song_counts, unique_sessions AS sessions_log,
    {_clipped("song_counts")} AS song_counts_clipped, {_clipped("unique_sessions")} AS sessions_log_clipped,
    round(ln(1 + song_counts), 6) AS song_counts_log, round(ln(1 + unique_sessions), 6) AS sessions_log_log,
    {_clipped("unique_sessions")} AS "sessions_log_logClip" FROM uf""",
    UF,
)

# Churn breakdowns

_oracle(
    "churn_rate",
    """SELECT CAST(sum(cancel_flag) AS BIGINT) AS churned_users, count(*) AS users,
    round(round(sum(cancel_flag) / CAST(count(*) AS DOUBLE), 4) * 100, 6) AS churn_percent FROM flags""",
)


def _latest(column: str) -> str:
    return f"""latest AS (SELECT userId, {column}, cancel_flag FROM log JOIN flags USING (userId)
    QUALIFY row_number() OVER (PARTITION BY userId ORDER BY ts DESC, {column} DESC NULLS LAST) = 1)"""


_oracle(
    "churn_by_gender",
    """SELECT gender, cancel_flag, count(*) AS "count" FROM latest WHERE gender IS NOT NULL GROUP BY ALL""",
    f"{LOG}, {_latest('gender')}",
)
STATE = f"""{LOG}, {_latest('location')}, states AS (
  SELECT right(location, 2) AS state, cancel_flag, count(*) AS "count" FROM latest
  WHERE location IS NOT NULL GROUP BY ALL
), churn AS (
  SELECT state, CAST(sum("count") AS BIGINT) AS total_count,
    CAST(sum("count" * cancel_flag) AS BIGINT) AS cancellation_count,
    sum("count" * cancel_flag) / CAST((SELECT sum("count" * cancel_flag) FROM states) AS DOUBLE) * 100
      AS churn_share,
    sum("count" * cancel_flag) / CAST(sum("count") AS DOUBLE) * 100 AS churn_rate
  FROM states GROUP BY state
)"""
_oracle("users_by_state", "SELECT * FROM states", STATE)
_oracle("top_states", 'SELECT * FROM states ORDER BY "count" DESC, state, cancel_flag LIMIT 5', STATE)
_oracle(
    "churn_by_state",
    """SELECT state, total_count, cancellation_count, round(churn_share, 6) AS churn_share,
    round(churn_rate, 6) AS churn_rate FROM churn""",
    STATE,
)


def _describe(column: str, table: str, value: str, where: str = "true") -> str:
    v = f"CAST({value} AS DOUBLE)"
    return f"""SELECT {_text(column)} AS "column", count({value}) AS "count", round(avg({v}), 6) AS mean,
    round(stddev_samp({v}), 6) AS std, round(min({v}), 6) AS min, round(quantile_cont({v}, 0.25), 6) AS q25,
    round(quantile_cont({v}, 0.5), 6) AS q50, round(quantile_cont({v}, 0.75), 6) AS q75,
    round(max({v}), 6) AS max FROM {table} WHERE {where}"""


_oracle(
    "state_summary",
    " UNION ALL ".join(_describe(c, "churn", c) for c in ("total_count", "churn_share")),
    STATE,
)
_oracle(
    "cancel_by_agent",
    f"""SELECT {BROWSER} AS browser, {DEVICE} AS device, count(*) AS "count" FROM raw
    WHERE page = 'Cancellation Confirmation' GROUP BY 1, 2""",
)
_oracle("distinct_agents", f"SELECT DISTINCT {BROWSER} AS browser, {DEVICE} AS device FROM raw")
PAGE_SHARE = """SELECT page, cancelled, not_cancelled, cancelled + not_cancelled AS total,
    round(cancelled / CAST(cancelled + not_cancelled AS DOUBLE), 6) AS percentage_from_cancelled
    FROM (SELECT page, count(*) AS cancelled FROM flagged WHERE cancel_flag = 1 GROUP BY 1)
    JOIN (SELECT page, count(*) AS not_cancelled FROM flagged WHERE cancel_flag = 0 GROUP BY 1) USING (page)"""
_oracle("page_share", PAGE_SHARE)
_oracle("page_share_join", PAGE_SHARE)


def _mean(name: str, dimension: str, sql: str, where: str, value: str, places: str = "round(avg(n), 6)") -> None:
    _oracle(
        name,
        f"""SELECT cancel_flag, {dimension}, {places} AS {value} FROM (
          SELECT cancel_flag, userId, {sql} AS {dimension}, count(page) AS n FROM flagged
          WHERE userId IS NOT NULL AND {where} GROUP BY ALL) GROUP BY ALL""",
    )


HOUR, DAY = "CAST(hour(make_timestamp(ts * 1000)) AS INTEGER)", "dayname(make_timestamp(ts * 1000))"
THUMBS = f"page IN {_list(schema.THUMBS_PAGES)}"
_mean("avg_page_visits", "level", "level", "true", "mean_page_visits")
_mean("avg_songs_by_level", "level", "level", "page = 'NextSong'", "mean_page_visits")
_mean("avg_thumbs_by_level", "level", "level", THUMBS, "mean_thumbs_interactions")
_mean(
    "avg_thumbs_rounded", "level", "level", THUMBS, "mean_thumbs_interactions",
    "CAST(round_even(avg(n), 0) AS DOUBLE)",
)
_mean("songs_by_weekday", "day_of_week", DAY, "page = 'NextSong'", "mean_song_listens")
_mean("songs_by_hour", "hour_of_day", HOUR, "page = 'NextSong'", "mean_hourly_listens")
_oracle(
    "hourly_plays",
    f"""SELECT cancel_flag, userId, {HOUR} AS hour_of_day, count(*) AS sum_hourly_plays FROM flagged
    WHERE userId IS NOT NULL AND page = 'NextSong' GROUP BY ALL""",
)
_oracle(
    "songs_by_day_hour",
    f"""SELECT day_of_week, hour_of_day, round(avg(n), 6) AS mean_hourly_listens FROM (
      SELECT {DAY} AS day_of_week, {HOUR} AS hour_of_day, cancel_flag, count(*) AS n FROM flagged
      WHERE artist IS NOT NULL AND page = 'NextSong' GROUP BY ALL) GROUP BY ALL""",
)
_oracle(
    "service_change_counts",
    f"""SELECT page, count(*) AS "count" FROM raw WHERE page IN {_list(schema.SERVICE_PAGES)} GROUP BY page""",
)
_oracle(
    "service_funnel",
    f"""SELECT page AS stage, count(*) AS number FROM log
    WHERE page IN {_list(schema.SERVICE_EXIT_PAGES)} GROUP BY page""",
)
_oracle(
    "artist_play_histogram",
    """SELECT song_plays, count(*) AS "count" FROM (
      SELECT artist, count(*) AS song_plays FROM raw WHERE artist IS NOT NULL GROUP BY artist)
    GROUP BY song_plays HAVING count(*) > 1""",
)
_oracle("songs_listened", 'SELECT userId, count(*) AS "count" FROM raw WHERE artist IS NOT NULL GROUP BY userId')
_oracle("page_interactions", f'SELECT userId, count(*) AS "count" FROM log WHERE page IN {POSITIVE} GROUP BY userId')


def _histogram(column: str, table: str, value: str) -> str:
    return f"""SELECT {_text(column)} AS "column", b AS bin, round(low + b * width, 6) AS bin_start,
    round(low + b * width + width, 6) AS bin_end,
    (SELECT count(*) FROM {table} WHERE {value} IS NOT NULL AND least(CAST(floor(({value} - low) / width) AS BIGINT), 9) = b) AS "count"
    FROM (SELECT CASE WHEN min({value}) = max({value}) THEN min({value}) - 0.5
                 ELSE CAST(min({value}) AS DOUBLE) END AS low,
          CASE WHEN min({value}) = max({value}) THEN 1.0 ELSE CAST(max({value}) - min({value}) AS DOUBLE) END
            / 10 AS width FROM {table}) AS bounds, range(10) AS bins(b)"""


_oracle(
    "registration_histogram",
    _histogram("day_since_registration", "cancels", "d"),
    f"""{LOG}, cancels AS (
      SELECT {DAYS_SINCE} AS d FROM user_log WHERE page = 'Cancellation Confirmation')""",
)
_oracle("feature_histogram", " UNION ALL ".join(_histogram(c, "uf", c) for c in FEATURES), UF)

# Profile and distributions

_oracle("row_count", "SELECT count(*) AS n_rows FROM raw")
KINDS = {"event_id": "bigint", **{f.name: f.dataType.simpleString() for f in schema.EVENT_LOG_SCHEMA}}


def _profile(count_null: bool) -> str:
    extra = " + CAST(count(*) > count({c}) AS INTEGER)" if count_null else ""
    return " UNION ALL ".join(
        f"""SELECT {_text(c)} AS "column", count(DISTINCT {c}){extra.format(c=c)} AS unique_count,
        count(*) - count({c}) AS null_count, {_text(kind)} AS type FROM raw"""
        for c, kind in KINDS.items()
    )


_oracle("null_profile", _profile(False))
_oracle("null_profile_counting_null", _profile(True))
NULL_MAP = "SELECT " + ", ".join(f"CAST({c} IS NULL AS INTEGER) AS {c}" for c in LOG_COLUMNS) + " FROM raw"
_oracle("null_map", NULL_MAP)
_oracle("null_patterns", f"SELECT *, count(*) AS n_rows FROM ({NULL_MAP}) GROUP BY ALL")
CO_NULL = " UNION ALL ".join(
    f"""SELECT {_text(a)} AS src, {_text(b)} AS dst, count(*) AS n_rows FROM raw
    WHERE {a} IS NULL AND {b} IS NULL HAVING count(*) > 0"""
    for a in LOG_COLUMNS
    for b in LOG_COLUMNS
)
_oracle("null_cooccurrence", CO_NULL)
_oracle(
    "null_edges",
    "SELECT src, dst FROM (VALUES "
    + ", ".join(f"({_text(c)})" for c in LOG_COLUMNS)
    + f") AS nodes(src) LEFT JOIN ({CO_NULL}) USING (src)",
)
_oracle(
    "describe_by_label",
    f""", d AS ({" UNION ALL ".join(
        _describe(c, "uf", c, f"label = {k}").replace("SELECT", f"SELECT {k} AS label,", 1)
        for c in FEATURES for k in (0, 1))}),
    u AS (UNPIVOT (SELECT * REPLACE (CAST("count" AS DOUBLE) AS "count") FROM d)
      ON "count", mean, std, min, q25, q50, q75, max INTO NAME statistic VALUE v)
    SELECT "column", statistic, max(v) FILTER (label = 1) AS value_1, max(v) FILTER (label = 0) AS value_0
    FROM u GROUP BY ALL""",
    UF,
)


def _each(template: str, columns=("label", *FEATURES)) -> str:
    return " UNION ALL ".join(template.format(c=c) for c in columns)


_oracle(
    "feature_means_by_label",
    _each(
        """SELECT label, '{c}' AS "column", round(avg({c}), 6) AS mean,
        round(CAST(sum({c}) AS DOUBLE), 6) AS total FROM uf GROUP BY label""",
        FEATURES,
    ),
    UF,
)
_oracle("label_counts", 'SELECT cancel_flag AS label, count(*) AS "count" FROM flags GROUP BY 1')
_oracle("label_by_level", 'SELECT label, level_flag, count(*) AS "count" FROM cf GROUP BY ALL', CF)
_oracle(
    "value_counts",
    _each(
        """SELECT '{c}' AS "column", CAST({c} AS DOUBLE) AS value, count(*) AS "count" FROM uf
        WHERE {c} IS NOT NULL AND (SELECT count(DISTINCT {c}) FROM uf) > 2 GROUP BY {c}"""
    ),
    UF,
)
_oracle(
    "box_stats",
    _each(
        """SELECT '{c}' AS "column", round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
        round(min(v) FILTER (v BETWEEN q1 - reach AND q3 + reach), 6) AS whisker_low,
        round(max(v) FILTER (v BETWEEN q1 - reach AND q3 + reach), 6) AS whisker_high,
        count(*) FILTER (v NOT BETWEEN q1 - reach AND q3 + reach) AS fliers
        FROM (SELECT CAST({c} AS DOUBLE) AS v FROM uf WHERE {c} IS NOT NULL) cells,
        (SELECT *, (q3 - q1) * 1.5 AS reach FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
          quantile_cont(CAST({c} AS DOUBLE), 0.5) AS median,
          quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM uf)) quarters
        GROUP BY q1, median, q3"""
    ),
    UF,
)
_oracle(
    "feature_skew",
    _each(
        """SELECT '{c}' AS "column", CASE WHEN count({c}) < 3 THEN NULL WHEN min({c}) = max({c}) THEN 0.0
        ELSE round(skewness({c}), 6) END AS skew FROM uf"""
    ),
    UF,
)
_oracle(
    "outlier_counts",
    "SELECT * FROM ("
    + _each(
        """SELECT '{c}' AS "column", count(*) FILTER (abs(({c} - m) / nullif(s, 0)) > 3) AS outliers,
        count(*) AS total_samples FROM uf,
        (SELECT avg({c}) AS m, stddev_samp({c}) AS s, count(DISTINCT {c}) AS d FROM uf) stats
        WHERE d > 2 HAVING count(*) > 0"""
    )
    + ")",
    UF,
)


def _correlations(columns, table: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT {_text(a)} AS column_1, {_text(b)} AS column_2, CASE WHEN isnan(r) THEN NULL
        ELSE round(r, 6) END AS r FROM (SELECT corr({_name(a)}, {_name(b)}) AS r FROM {table})"""
        for a in columns
        for b in columns
    )


_oracle("feature_correlations", _correlations(["label", *FEATURES], "uf"), UF)
_oracle("page_correlations", _correlations(schema.PIVOT_PAGES, "pages"), f"{LOG}, pages AS ({PIVOT})")
_oracle(
    "service_page_correlations",
    _correlations(schema.SERVICE_EXIT_PAGES, "exits"),
    f"{LOG}, exits AS ({EXIT_PIVOT})",
)
_oracle(
    "correlated_pairs",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS column_1, '{b}' AS column_2, round(r, 6) AS r
        FROM (SELECT corr({a}, {b}) AS r FROM uf) WHERE r > 0.8 AND NOT isnan(r)"""
        for a, b in combinations(["label", *FEATURES], 2)
    ),
    UF,
)

# Checks

_oracle(
    "dq_cancel_unique",
    """SELECT n AS cancel_events, u AS flagged_users, n = u AS matches FROM (
    SELECT count(*) AS n, count(DISTINCT userId) AS u FROM log WHERE page = 'Cancellation Confirmation')""",
)
_oracle(
    "dq_state_totals",
    """SELECT state, b.users_before, a.users_after, b.users_before IS NOT DISTINCT FROM a.users_after AS matches
    FROM (SELECT state, CAST(sum("count") AS BIGINT) AS users_before FROM states GROUP BY state) b
    FULL JOIN (SELECT right(location, 2) AS state, count(*) AS users_after FROM latest WHERE location IS NOT NULL GROUP BY 1) a
    USING (state)""",
    STATE,
)
_oracle(
    "dq_missing_users",
    " UNION ALL ".join(
        f"""SELECT '{name}' AS feature, (SELECT count(*) FROM users) - count(DISTINCT userId) AS missing_users
        FROM log WHERE {where}"""
        for name, where in {
            "song_counts": "artist IS NOT NULL",
            "pos_interactions": f"page IN {POSITIVE}",
            "neg_interactions": f"page IN {NEGATIVE}",
            "unique_locations": "location IS NOT NULL",
            "label": "page = 'Cancellation Confirmation'",
        }.items()
    ),
)

# Model preparation and metrics

HASH = "CAST('0x' || substr(md5(userId), 1, 8) AS BIGINT)"
SPLIT = f"CASE WHEN {HASH} % 100 < 20 THEN 'test' ELSE 'train' END"
_oracle("train_test_split", f"SELECT userId, cancel_flag AS label, {SPLIT} AS split FROM flags")
_oracle(
    "stratified_folds",
    f"""SELECT userId, cancel_flag AS label,
    CAST((row_number() OVER (PARTITION BY cancel_flag ORDER BY {HASH}, userId) - 1) % 5 AS INTEGER) AS fold
    FROM flags""",
)
SCALED = ("song_counts", "days_since_registration", "unique_sessions")


def _scaled(top: str, bottom: str, constant: float) -> str:
    return ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN round(coalesce(({c} - {top.format(c=c)}) / "
        f"nullif({bottom.format(c=c)}, 0), {constant}), 6) END AS {c}_scaled"
        for c in SCALED
    )


_oracle(
    "minmax_scale",
    "SELECT userId, "
    + _scaled(
        "(SELECT min({c}) FROM train)", "CAST((SELECT max({c}) - min({c}) FROM train) AS DOUBLE)", 0.5
    )
    + " FROM uf",
    f"{UF}, train AS (SELECT * FROM uf WHERE {SPLIT} = 'train')",
)
_oracle(
    "standard_scale",
    "SELECT userId, "
    + _scaled("(SELECT avg({c}) FROM uf)", "(SELECT stddev_pop({c}) FROM uf)", 0.0)
    + " FROM uf",
    UF,
)
SCORED = f"""{UF}, scored AS (
  SELECT label, probability, CAST(probability >= 0.5 AS INTEGER) AS prediction FROM (
    SELECT label, ((song_counts * 7 + unique_sessions * 13 + neg_interactions * 5) % 97 + 1)
      / CAST(99 AS DOUBLE) AS probability FROM uf)
), cells AS (
  SELECT CAST(count(*) FILTER (label = 1 AND prediction = 1) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (label = 0 AND prediction = 1) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (label = 0 AND prediction = 0) AS DOUBLE) AS tn,
    CAST(count(*) FILTER (label = 1 AND prediction = 0) AS DOUBLE) AS fn FROM scored
), points AS (
  SELECT probability AS score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
  FROM scored GROUP BY 1
), curve AS (
  SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
    (SELECT CAST(sum(pos) AS DOUBLE) FROM points) AS p, (SELECT CAST(sum(neg) AS DOUBLE) FROM points) AS q
  FROM points
)"""
_oracle("confusion_matrix", 'SELECT label, prediction, count(*) AS "count" FROM scored GROUP BY ALL', SCORED)


def _ratio(a: str, b: str) -> str:
    return f"coalesce(({a}) / nullif(({b}), 0), 0.0)"


_oracle(
    "score_metrics",
    f"""SELECT round(({_ratio("tp", "tp + fn")} + {_ratio("tn", "tn + fp")}) / 2, 6) AS "AUC",
    round({_ratio("2 * tp", "2 * tp + fp + fn")}, 6) AS f1, round({_ratio("tp", "tp + fn")}, 6) AS recall,
    round({_ratio("tp", "tp + fp")}, 6) AS precision, round({_ratio("tp + tn", "tp + fp + tn + fn")}, 6) AS accuracy,
    round({_ratio("5 * tp", "5 * tp + 4 * fn + fp")}, 6) AS f2, round({_ratio("tn", "tn + fp")}, 6) AS specificity
    FROM cells""",
    SCORED,
)
_oracle(
    "validation_report",
    """, losses AS (
      SELECT count(*) AS n, avg((label - probability) ** 2) AS mse, avg(label) AS rate,
        -avg(label * ln(probability) + (1 - label) * ln(1 - probability)) AS logloss FROM scored
    ), areas AS (
      SELECT sum(neg * (tp - pos + pos / 2.0)) / max(p * q) AS auc,
        sum(pos * (tp / CAST(tp + fp AS DOUBLE)
          + coalesce((tp - pos) / CAST(nullif(tp - pos + fp - neg, 0) AS DOUBLE), tp / CAST(tp + fp AS DOUBLE)))
          / 2) / max(p) AS aucpr FROM curve
    )
    SELECT n, round(mse, 6) AS "MSE", round(sqrt(mse), 6) AS "RMSE", round(logloss, 6) AS "LogLoss",
      round(auc, 6) AS "AUC", round(aucpr, 6) AS "AUCPR", round(2 * auc - 1, 6) AS "Gini",
      round(-2 * n * CASE WHEN rate IN (0, 1) THEN 0 ELSE rate * ln(rate) + (1 - rate) * ln(1 - rate) END, 6)
        AS null_deviance,
      round(2 * n * logloss, 6) AS residual_deviance, n - 1 AS null_dof, n - 4 AS residual_dof,
      round(2 * n * logloss + 8, 6) AS "AIC" FROM losses, areas""",
    SCORED,
)


def _best(metric: str, beta2: int) -> str:
    value = f"{1 + beta2} * tp / ({1 + beta2} * tp + {beta2} * (p - tp) + fp)"
    return f"""(SELECT '{metric}' AS metric, round(score, 6) AS threshold, round({value}, 6) AS value FROM curve
    ORDER BY round({value}, 12) DESC, score LIMIT 1)"""


_oracle("best_thresholds", f"{_best('F1', 1)} UNION ALL {_best('F2', 4)}", SCORED)
_square = " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in KNN_FEATURES)
_oracle(
    "knn_classify",
    f""", near AS (
      SELECT a.userId, b.label FROM uf a, uf b
      WHERE {SPLIT.replace('userId', 'a.userId')} = 'test' AND {SPLIT.replace('userId', 'b.userId')} = 'train'
      QUALIFY row_number() OVER (PARTITION BY a.userId ORDER BY {_square}, b.userId) <= 5)
    SELECT userId, CAST(2 * sum(label) > count(*) AS INTEGER) AS prediction FROM near GROUP BY userId""",
    UF,
)
_oracle(
    "assemble",
    "SELECT userId, "
    + ", ".join(f"coalesce(CAST({c} AS DOUBLE), 0.0) AS {c}" for c in FEATURES)
    + " FROM uf",
    UF,
)
_oracle(
    "covariance_matrix",
    " UNION ALL ".join(
        f"""SELECT '{a}' AS column_1, '{b}' AS column_2,
        round(CASE WHEN stddev_pop({a}) = 0 OR stddev_pop({b}) = 0 THEN 0.0 ELSE corr({a}, {b}) END
          * count(*) / (count(*) - 1.0), 6) AS covariance FROM distinct_rows"""
        for a in FEATURES
        for b in FEATURES
    ),
    UF + ", distinct_rows AS (SELECT DISTINCT " + ", ".join(f"coalesce({c}, 0) AS {c}" for c in FEATURES) + " FROM uf)",
)


def _jacobi(size: int, sweeps: int = 12) -> str:
    """Eigenvalues of the symmetric matrix ``m`` (a list by rows in ``matrix``) by rotations that clear one pair at a time."""
    pairs = [(p, q) for p in range(size) for q in range(p + 1, size)]
    p = f"[{', '.join(str(a) for a, _ in pairs)}][step % {len(pairs)} + 1]"
    q = f"[{', '.join(str(b) for _, b in pairs)}][step % {len(pairs)} + 1]"

    def at(i: str, j: str, m: str = "m") -> str:
        return f"{m}[({i}) * {size} + ({j}) + 1]"

    cells = f"range(0, {size * size})"
    columns = f"""list_transform({cells}, lambda k: CASE WHEN k % {size} = p THEN c * {at(f'k // {size}', 'p')} - s * {at(f'k // {size}', 'q')}
      WHEN k % {size} = q THEN s * {at(f'k // {size}', 'p')} + c * {at(f'k // {size}', 'q')} ELSE m[k + 1] END)"""
    rows = f"""list_transform({cells}, lambda k: CASE WHEN k // {size} = p THEN c * {at('p', f'k % {size}', 'half')} - s * {at('q', f'k % {size}', 'half')}
      WHEN k // {size} = q THEN s * {at('p', f'k % {size}', 'half')} + c * {at('q', f'k % {size}', 'half')} ELSE half[k + 1] END)"""
    return f"""turned AS (
      SELECT 0 AS step, m FROM matrix
      UNION ALL
      SELECT step + 1, {rows} FROM (
        SELECT step, p, q, c, s, {columns} AS half FROM (
          SELECT *, t / sqrt(t * t + 1) AS s, 1 / sqrt(t * t + 1) AS c FROM (
            SELECT *, CASE WHEN abs({at('p', 'q')}) < 1e-300 THEN 0.0
              ELSE (CASE WHEN w < 0 THEN -1 ELSE 1 END) / (abs(w) + sqrt(w * w + 1)) END AS t FROM (
              SELECT *, ({at('q', 'q')} - {at('p', 'p')}) / (2 * CASE WHEN abs({at('p', 'q')}) < 1e-300 THEN 1 ELSE {at('p', 'q')} END) AS w FROM (
                SELECT step, m, {p} AS p, {q} AS q FROM turned WHERE step < {sweeps * len(pairs)})))))
    )"""


_size = len(FEATURES)
_cells = ", ".join(
    f"CASE WHEN stddev_pop({a}) = 0 OR stddev_pop({b}) = 0 THEN 0.0 ELSE corr({a}, {b}) END" for a in FEATURES for b in FEATURES
)
_oracle(
    "pca_variance",
    f"""SELECT CAST(row_number() OVER (ORDER BY value DESC) AS INTEGER) AS component, round(value / sum(value) OVER (), 6) AS ratio
    FROM (SELECT greatest(m[i * {_size + 1} + 1], 0) AS value FROM turned, unnest(range(0, {_size})) AS r(i)
      WHERE step = (SELECT max(step) FROM turned))""",
    UF.replace("WITH", "WITH RECURSIVE", 1)
    + ", distinct_rows AS (SELECT DISTINCT "
    + ", ".join(f"coalesce({c}, 0) AS {c}" for c in FEATURES)
    + f" FROM uf), matrix AS (SELECT [{_cells}] AS m FROM distinct_rows), {_jacobi(_size)}",
)


def _bayes(by: str) -> str:
    """``class`` (by, label, column, prior, mean, variance) from ``rows`` (by, label, column, x): one model per ``by``."""
    return f"""sums AS (
      SELECT {by}, label, col, count(*) AS n, avg(x) AS mean, sum(x * x) AS squares, sum(x) AS total FROM learn GROUP BY ALL
    ), overall AS (
      SELECT {by}, greatest(1e-9 * max(v), 1e-9) AS least FROM (
        SELECT {by}, col, sum(squares) / sum(n) - (sum(total) / sum(n)) ** 2 AS v FROM sums GROUP BY ALL) GROUP BY ALL
    ), class AS (
      SELECT {by}, label, col, n / CAST(sum(n) OVER (PARTITION BY {by}, col) AS DOUBLE) AS prior, mean,
        greatest(squares / n - mean * mean, 0) + least AS variance FROM sums JOIN overall USING ({by})
    ), scores AS (
      SELECT userId, any_value(t.label) AS label, c.label AS class, max(ln(prior)) - sum(ln(2 * pi() * variance) + (x - mean) ** 2 / variance) / 2 AS score
      FROM guess t JOIN class c USING ({by}, col) GROUP BY userId, c.label
    ), best AS (
      SELECT userId, any_value(label) AS label, arg_max(class, (score, -class)) AS prediction,
        coalesce(sum(exp(score - top)) FILTER (class = 1), 0) / sum(exp(score - top)) AS probability
      FROM (SELECT *, max(score) OVER (PARTITION BY userId) AS top FROM scores) GROUP BY userId
    )"""


_long = " UNION ALL ".join(f"SELECT userId, label, '{c}' AS col, coalesce(CAST({c} AS DOUBLE), 0.0) AS x FROM uf" for c in FEATURES)
_oracle(
    "naive_bayes_predictions",
    "SELECT userId, label, prediction, round(probability, 6) AS probability FROM best",
    UF
    + f""", cells AS ({_long}), learn AS (SELECT 0 AS model, * FROM cells WHERE {SPLIT} = 'train'),
    guess AS (SELECT 0 AS model, * FROM cells WHERE {SPLIT} = 'test'), {_bayes('model')}""",
)
_oracle(
    "naive_bayes_folds",
    f"""SELECT CAST({HASH} % 4 AS INTEGER) AS fold, count(*) AS rows, count(*) FILTER (label = prediction) AS hits FROM best GROUP BY 1""",
    UF
    + f""", cells AS ({_long}), guess AS (SELECT {HASH} % 4 AS model, * FROM cells),
    learn AS (SELECT f AS model, userId, label, col, x FROM guess, unnest(range(0, 4)) AS r(f) WHERE model <> f), {_bayes('model')}""",
)

ORACLES["user_features_bucketed"] = ORACLES["user_features"]

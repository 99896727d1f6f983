"""User-activity log derived from the ``events`` table (rules in FIXTURES.md section 3)."""

from pyspark.sql import DataFrame, SparkSession

# User-agent strings by ``k % 6``.
USER_AGENTS = (
    "Mozilla/5.0 (Windows NT 6.1; WOW64) AppleWebKit/537.36 (KHTML, like Gecko) "
    "Chrome/36.0.1985.143 Safari/537.36",
    "Mozilla/5.0 (Macintosh; Intel Mac OS X 10_9_4) AppleWebKit/537.77.4 (KHTML, like Gecko) "
    "Version/7.0.5 Safari/537.77.4",
    "Mozilla/5.0 (X11; Ubuntu; Linux x86_64; rv:31.0) Gecko/20100101 Firefox/31.0",
    "Mozilla/5.0 (iPhone; CPU iPhone OS 7_1_2 like Mac OS X) AppleWebKit/537.51.2 (KHTML, like "
    "Gecko) Version/7.0 Mobile/11D257 Safari/9537.53",
    "Mozilla/5.0 (compatible; MSIE 9.0; Windows NT 6.1; WOW64; Trident/5.0)",
)
CLICK_PAGES = ("Thumbs Up", "Thumbs Down", "Add Friend", "Add to Playlist", "Home")
PURCHASE_PAGES = ("Upgrade", "Submit Upgrade", "Downgrade", "Submit Downgrade")
STATES = ("CA", "TX", "NY", "WA")
FIRST_REGISTRATION = 1696118400000
DAY_MS = 86400000


def _pick(values: tuple[str, ...], index: str) -> str:
    """``values[index]``, null past the end."""
    listed = ", ".join(f"'{value}'" for value in values)
    return f"get(array({listed}), CAST({index} AS INT))"


def sample_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The derived log, one row per event; a pure projection, so scans stay pruned."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id",
        "user_id",
        "event_type",
        "value",
        # Wall-clock micros, whatever the session time zone is.
        "unix_micros(from_utc_timestamp(CAST(ts AS TIMESTAMP), current_timezone())) AS us",
        "CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS k",
    )
    return events.selectExpr(
        "event_id",
        "CASE WHEN user_id % 29 = 0 THEN '' ELSE CAST(user_id AS STRING) END AS userId",
        "us div 1000 AS ts",
        f"""CASE event_type
            WHEN 'view' THEN 'NextSong'
            WHEN 'click' THEN {_pick(CLICK_PAGES, "k % 5")}
            WHEN 'error' THEN CASE WHEN k % 2 = 0 THEN 'Error' ELSE 'Help' END
            WHEN 'purchase' THEN {_pick(PURCHASE_PAGES, "k % 4")}
            ELSE CASE WHEN value > 200 THEN 'Cancellation Confirmation'
                      WHEN value > 180 THEN 'Cancel' ELSE 'Settings' END
        END AS page""",
        "CASE WHEN event_type = 'view' THEN concat('artist_', k) END AS artist",
        "CASE WHEN k % 3 = 0 THEN 'free' ELSE 'paid' END AS level",
        """CASE WHEN user_id % 29 <> 0 THEN CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END
        END AS gender""",
        f"""CASE WHEN k <> 0
            THEN concat('City', user_id % 7, ', ', {_pick(STATES, "(user_id + k % 2) % 4")})
        END AS location""",
        f"""CASE WHEN user_id % 29 <> 0
            THEN {FIRST_REGISTRATION} + (user_id % 100) * {DAY_MS} END AS registration""",
        "us div 86400000000 AS sessionId",
        f"{_pick(USER_AGENTS, 'k % 6')} AS userAgent",
    )

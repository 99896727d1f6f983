"""Small hand-made logs: ties, blanks, gaps and empty inputs."""

import pytest
from pyspark.sql import functions as F

from ebbline.operators import clean
from ebbline.operators import features as f
from ebbline.plans import feature_matrix as fm
from ebbline.schema import EVENT_LOG_SCHEMA

DAY = 86400000


def log_of(spark, *rows):
    """Rows of (userId, ts, page, more columns by name)."""
    names = EVENT_LOG_SCHEMA.fieldNames()
    full = []
    for user, ts, page, *rest in rows:
        row = {"userId": user, "ts": ts, "page": page, "level": "free", "sessionId": 1}
        row.update(rest[0] if rest else {})
        full.append(tuple(row.get(name) for name in names))
    return spark.createDataFrame(full, EVENT_LOG_SCHEMA)


def by_user(df):
    return {row.userId: row for row in df.collect()}


def test_blank_users_are_dropped_or_kept(spark):
    log = log_of(spark, ("", 1, "Home"), (None, 2, "Home"), ("1", 3, "Home"))
    assert set(by_user(clean.clean_log(log))) == {"1"}
    assert set(by_user(clean.clean_log(log, keep_blank=True))) == {"", "1"}


def test_integer_users_are_null_when_malformed(spark):
    log = log_of(spark, ("", 1, "Home"), ("x", 2, "Home"), ("7", 3, "Home"))
    ids = {row.ts: row.userId for row in clean.integer_users(log).collect()}
    assert ids == {1: None, 2: None, 3: 7}


def test_latest_level_ties_go_to_paid(spark):
    log = log_of(
        spark,
        ("1", 5, "Home", {"level": "free"}),
        ("1", 5, "Home", {"level": "paid"}),
        ("2", 5, "Home", {"level": "paid"}),
        ("2", 6, "Home", {"level": "free"}),
        ("3", None, "Home", {"level": "paid"}),
        ("3", -4, "Home", {"level": "free"}),
    )
    assert {u: r.level_flag for u, r in by_user(f.user_level(log)).items()} == {"1": 1, "2": 0, "3": 0}


def test_users_without_plays(spark):
    log = log_of(spark, ("1", 5, "Home"), ("2", 5, "NextSong", {"artist": "a"}))
    rows = by_user(fm.user_features(log))
    assert rows["1"].song_counts == 0 and rows["1"].avg_daily_listens is None
    assert rows["2"].avg_daily_listens == 1.0
    assert by_user(f.avg_daily_listens(log, zero_filled=True))["1"].avg_daily_listens == 0.0


def test_plays_without_time_count_as_one_more_day(spark):
    play = {"artist": "a"}
    log = log_of(
        spark,
        ("1", 0, "NextSong", play),
        ("1", 1, "NextSong", play),
        ("1", 2, "NextSong", play),
        ("1", None, "NextSong", play),
    )
    listens = by_user(f.avg_daily_listens(log, rounded=False))
    assert listens["1"].avg_daily_listens == 2.0


def test_null_registration_gives_null_tenure(spark):
    log = log_of(spark, ("1", 3 * DAY, "Home"), ("2", 3 * DAY, "Home", {"registration": DAY // 2}))
    tenure = by_user(f.days_since_registration(log))
    assert tenure["1"].days_since_registration is None
    assert tenure["2"].days_since_registration == 3.0


def test_session_gaps(spark):
    log = log_of(
        spark,
        ("1", 0, "Home"),
        ("1", 30000, "Home"),
        ("1", 90000, "Home"),
        ("1", 500000, "Home", {"sessionId": 2}),
        ("2", 7, "Home"),
    )
    gaps = by_user(f.session_gaps(log, unit=1000))
    assert gaps["1"].avg_time_between_sessions == 45.0
    assert gaps["2"].avg_time_between_sessions is None
    assert by_user(f.session_gaps(log, zero_filled=True))["2"].avg_time_between_sessions == 0.0


def test_event_gaps_equal_a_plain_lag(spark):
    from pyspark.sql import Window

    rows = [("1", t, "Home") for t in (0, 5, 5, 5, 59999, 60000, 60000, 400000)]
    rows += [("2", 3, "Home"), ("2", None, "Home")]
    log = log_of(spark, *rows).coalesce(1).withColumn("event_id", F.monotonically_increasing_id())
    got = {r.event_id: r.session_duration for r in f.event_gaps(log, "event_id", unit=1).collect()}
    window = Window.partitionBy("userId", "sessionId").orderBy("ts", "event_id")
    plain = log.withColumn("gap", F.col("ts") - F.lag("ts").over(window))
    assert got == {r.event_id: r.gap for r in plain.collect()}


def test_page_pivot_totals_equal_filtered_counts(spark):
    log = log_of(
        spark,
        ("1", 1, "Home"),
        ("1", 2, "Home"),
        ("1", 3, "NextSong"),
        ("2", 4, "Cancel"),
        ("3", 5, "Unheard Of"),
    )
    rows = by_user(f.page_pivot(log))
    assert set(rows) == {"1", "3"}
    assert rows["1"].Home == 2 and sum(v for k, v in rows["1"].asDict().items() if k != "userId") == 2
    assert f.discover_pages(log) == ["Home", "Unheard Of"]
    found = by_user(f.page_pivot(log, f.discover_pages(log)))
    assert found["3"]["Unheard Of"] == 1


def test_complete_case_drops_users_without_plays_pages_or_registration(spark):
    known = {"registration": 0}
    log = log_of(
        spark,
        ("all", 1, "Home", known),
        ("all", 2, "NextSong", known | {"artist": "a"}),
        ("no plays", 1, "Home", known),
        ("no pages", 1, "NextSong", known | {"artist": "a"}),
        ("no registration", 1, "Home"),
        ("no registration", 2, "NextSong", {"artist": "a"}),
    )
    assert set(by_user(fm.feature_matrix(log))) == {"all"}
    kept = by_user(fm.feature_matrix(log, mode="all_users"))
    assert len(kept) == 4 and kept["no pages"].Home is None and kept["no plays"].Home == 1
    with pytest.raises(ValueError):
        fm.feature_matrix(log, mode="some")


def test_label_parameters(spark):
    log = log_of(spark, ("1", 1, "Cancel"), ("2", 1, "Cancellation Confirmation"), ("3", 1, "Home"))
    narrow = {u: r.label for u, r in by_user(f.churn_label(log)).items()}
    wide = {u: r.label for u, r in by_user(f.churn_label(log, ["Cancel", "Cancellation Confirmation"])).items()}
    assert narrow == {"1": 0, "2": 1, "3": 0} and wide == {"1": 1, "2": 1, "3": 0}


def test_agents(spark):
    agents = {
        "windows chrome": "Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 Chrome/99.0 Safari/537.36",
        "ubuntu chromium": "Mozilla/5.0 (X11; Linux x86_64) Ubuntu Chromium/34.0 Chrome/34.0 Safari/537.36",
        "ie 11": "Mozilla/5.0 (Windows NT 6.1; WOW64; Trident/7.0; rv:11.0) like Gecko",
        "iphone": r"\"Mozilla/5.0 (iPhone; CPU OS 7_1 like Mac OS X) Version/7.0 Mobile/11D Safari/9537\"",
        "blank": "",
        "none": None,
    }
    log = log_of(spark, *((name, 1, "Home", {"userAgent": ua}) for name, ua in agents.items()))
    got = {u: (r.device, r.browser) for u, r in by_user(f.with_agent_families(log)).items()}
    assert got == {
        "windows chrome": ("Windows", "Chrome"),
        "ubuntu chromium": ("Ubuntu", "Chromium"),
        "ie 11": ("Windows", "IE"),
        "iphone": ("iOS", "Mobile Safari"),
        "blank": ("Other", "Other"),
        "none": ("Other", "Other"),
    }
    flags = by_user(f.user_agents(log))
    assert flags["iphone"]["browser_Mobile Safari"] == 1 and flags["none"]["device_Other"] == 1


def test_empty_log(spark):
    log = log_of(spark)
    assert fm.user_features(log).count() == 0
    assert fm.feature_matrix(log).count() == 0
    assert f.event_gaps(log.withColumn("event_id", F.lit(1)), "event_id").count() == 0


def test_zero_fill_gives_exactly_the_users(spark):
    users = spark.createDataFrame([("1",), ("2",)], "userId string")
    feature = spark.createDataFrame([("1", None), ("9", 4)], "userId string, n int")
    filled = by_user(clean.zero_fill(feature, users, fill=7))
    assert {u: r.n for u, r in filled.items()} == {"1": None, "2": 7}
    union = by_user(clean.zero_fill_union(feature.filter("n is null"), users))
    assert {u: r.n for u, r in union.items()} == {"1": None, "2": 0}


def test_flag_rows_counts_null_as_zero(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert [r.f for r in clean.flag_rows(df, "x", ["a"], "f").orderBy(F.asc_nulls_last("x")).collect()] == [1, 0, 0]


def test_log_first_scope_logs_one_column_per_group(spark):
    play = {"artist": "a", "registration": 0}
    rows = [(str(u), i, "Help", play) for u in range(5) for i in range(u + 1)]
    rows += [(str(u), i, "Home", play) for u in range(5) for i in range(u + 1)]
    plain = by_user(fm.feature_matrix(log_of(spark, *rows)))
    first = by_user(fm.feature_matrix(log_of(spark, *rows), use_log=True, scope="first"))
    every = by_user(fm.feature_matrix(log_of(spark, *rows), use_log=True))
    assert first["4"].Home == plain["4"].Home == 5
    assert every["4"].Home == pytest.approx(1.791759, abs=1e-6)
    assert first["4"].song_counts == pytest.approx(2.397895, abs=1e-6)
    assert every["4"].level_flag == 0.0


def test_event_gaps_with_null_users_and_sessions(spark):
    rows = [(1, "a", None, 0), (2, "a", None, 20_000), (3, None, 7, 0), (4, None, 7, 70_000), (5, None, None, 5), (6, "a", 7, None)]
    log = spark.createDataFrame(rows, "event_id long, userId string, sessionId long, ts long")
    got = {r.event_id: r.session_duration for r in f.event_gaps(log, "event_id").collect()}
    assert got == {1: None, 2: 2.0, 3: None, 4: 7.0, 5: None, 6: None}


def test_flags_of_rows_without_a_user(spark):
    rows = [("a", "Cancellation Confirmation"), ("a", "Home"), (None, "Cancellation Confirmation"), ("b", "Home")]
    log = spark.createDataFrame(rows, "userId string, page string")
    got = clean.flag_cancelled_users(log)
    assert sorted((r.userId or "", r.page, r.cancel_flag) for r in got.collect()) == [
        ("", "Cancellation Confirmation", 0),
        ("a", "Cancellation Confirmation", 1),
        ("a", "Home", 1),
        ("b", "Home", 0),
    ]


def test_discovered_agents_leave_no_user_without_a_family(spark):
    agents = [
        ("a", "Mozilla/5.0 (Linux; Android 9; Pixel) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/80.0 Mobile Safari/537.36"),
        ("b", "Mozilla/5.0 (Windows NT 10.0) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/80.0 Safari/537.36 Edg/80.0"),
        ("c", "strange robot"),
        ("d", "Mozilla/5.0 (Android 10; Mobile; rv:68.0) Gecko/68.0 Firefox/68.0"),
        ("e", "Mozilla/5.0 (X11; CrOS x86_64 12871.102.0) AppleWebKit/537.36 (KHTML, like Gecko) Chrome/81.0 Safari/537.36"),
        ("f", None),
    ]
    rows = f.user_agents_discovered(spark.createDataFrame(agents, "userId string, userAgent string")).collect()
    names = {r.userId: sorted(k for k, v in r.asDict().items() if v == 1) for r in rows}
    assert names == {
        "a": ["browser_Chrome Mobile", "device_Android"],
        "b": ["browser_Edge", "device_Windows"],
        "c": ["browser_Other", "device_Other"],
        "d": ["browser_Firefox Mobile", "device_Android"],
        "e": ["browser_Chrome", "device_Chrome OS"],
        "f": ["browser_Other", "device_Other"],
    }

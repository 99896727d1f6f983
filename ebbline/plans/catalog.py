"""Every query by name: callables taking a session and a data folder."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbline import functions as fn
from ebbline import schema
from ebbline.operators import breakdowns as b
from ebbline.operators import checks, clean, metrics, near_points, neighbours, profile, sketches, transform
from ebbline.operators import correlation as corr
from ebbline.operators import features as f
from ebbline.plans import bayes
from ebbline.plans import feature_matrix as fm
from ebbline.plans import training as t
from ebbline.schema import USER
from ebbline.sources import (
    append_csv,
    export,
    load_features,
    materialize,
    read_csv,
    read_json,
    register_view,
    sample_log,
    scratch_path,
    write_bucketed,
)

FEATURES = (
    "song_counts",
    "avg_daily_listens",
    "level_flag",
    "pos_interactions",
    "neg_interactions",
    "unique_locations",
    "distinct_artist",
    "days_since_registration",
    "unique_sessions",
)
LOG_COLUMNS = tuple(field.name for field in schema.EVENT_LOG_SCHEMA)
POSITIONS = (0, 1, 10, 100, 500, 999)
KNN_FEATURES = ("song_counts", "pos_interactions", "neg_interactions", "unique_sessions")
ROUNDED = 6
BUCKETS = 8
#: Fits of a grid that run side by side.
FITS_AT_ONCE = 16

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def _round(df: DataFrame) -> DataFrame:
    """Doubles to six places, so that results compare across engines."""
    return df.select(
        *(
            F.round(F.col(f"`{name}`"), ROUNDED).alias(name) if kind == "double" else F.col(f"`{name}`")
            for name, kind in df.dtypes
        )
    )


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole log; users not logged in are null."""
    return clean.blank_users_to_null(sample_log(spark, sf_dir))


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_log(sample_log(spark, sf_dir), columns=None)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User features as a table, for queries that read them more than once."""
    return materialize(fm.user_features(_log(spark, sf_dir)), "user-features")


# Scans and sinks


@query
def scan_json(spark, sf_dir):
    path = scratch_path(spark, "log-json")
    export(sample_log(spark, sf_dir).select(*LOG_COLUMNS), path, "json")
    return read_json(spark, path)


@query
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "log-csv")
    export(sample_log(spark, sf_dir).select(*LOG_COLUMNS), path, "csv")
    return read_csv(spark, path)


@query
def load_feature_file(spark, sf_dir):
    """All three formats of the same features, loaded as doubles."""
    features = materialize(fm.core_features(_log(spark, sf_dir)), "core-features")
    loaded = []
    for kind in ("csv", "json", "parquet"):
        path = f"{scratch_path(spark, 'features')}.{kind}"
        export(features, path, kind)
        rows = load_features(spark, path, ["song_counts", "level_flag", "unique_locations"])
        loaded.append(rows.withColumn("format", F.lit(kind)))
    return loaded[0].unionByName(loaded[1]).unionByName(loaded[2])


@query
def sink_roundtrip(spark, sf_dir):
    """Features through the JSON, CSV and appended-CSV sinks and back."""
    features = materialize(fm.core_features(_log(spark, sf_dir)), "core-features")
    columns = [c for c in features.columns if c != USER]
    back = []
    for kind in ("csv", "json"):
        path = scratch_path(spark, f"sink-{kind}")
        export(features, path, kind, single_file=kind == "json")
        reader = spark.read.schema(features.schema)
        reader = reader.option("header", True) if kind == "csv" else reader
        back.append(reader.format(kind).load(path).withColumn("sink", F.lit(kind)))
    path = scratch_path(spark, "sink-append")
    append_csv(features, path)
    appended = spark.read.schema(features.select(*columns).schema).csv(path)
    appended = appended.withColumns({USER: F.lit(None).cast("string"), "sink": F.lit("append")})
    return back[0].unionByName(back[1]).unionByName(appended)


@query
def sql_view(spark, sf_dir):
    register_view(_raw(spark, sf_dir), "user_log")
    register_view(_log(spark, sf_dir), "cleaned_user_log")
    return spark.sql(
        """
        SELECT page, count(*) AS visits, count(DISTINCT userId) AS users,
               (SELECT count(*) FROM user_log) AS all_rows
        FROM cleaned_user_log GROUP BY page
        """
    )


# Cleaning, flags, filling


@query
def clean_log(spark, sf_dir):
    log = sample_log(spark, sf_dir)
    ids = clean.integer_users(log).select("event_id", F.col(USER).alias("user_number"))
    kept = clean.clean_log(log, ["event_id", *clean.KEEP_COLUMNS])
    return kept.join(ids, "event_id").filter(F.col("user_number").isNotNull())


@query
def clean_log_keep_blank(spark, sf_dir):
    log = clean.clean_log(sample_log(spark, sf_dir), keep_blank=True)
    return f.churn_label(log)


@query
def limit_rows(spark, sf_dir):
    """First ten events, the report a relational ``limit 10`` scan gives."""
    log = sample_log(spark, sf_dir).select("event_id", *LOG_COLUMNS)
    return log.orderBy("event_id").limit(10)


@query
def flag_rows(spark, sf_dir):
    log = _raw(spark, sf_dir).select("event_id", "artist", "page")
    log = clean.flag_rows(log, "page", schema.NEGATIVE_PAGES, "negative_flag")
    return clean.flag_rows(log, "artist", ["artist_1", "artist_2"], "artist_flag")


@query
def flag_cancelled_users(spark, sf_dir):
    log = _raw(spark, sf_dir).select("event_id", USER, "page")
    return clean.flag_cancelled_users(log)


@query
def zero_fill(spark, sf_dir):
    log = _log(spark, sf_dir)
    return clean.zero_fill(b.songs_listened(log), clean.unique_users(log))


@query
def zero_fill_union(spark, sf_dir):
    log = _log(spark, sf_dir)
    errors = b.page_interactions(log, ["Error"])
    return clean.zero_fill_union(errors, clean.unique_users(log))


@query
def missing_users(spark, sf_dir):
    log = _log(spark, sf_dir)
    churned = log.filter(F.col("page").isin(list(schema.CHURN_PAGES)))
    return clean.missing_users(churned, clean.unique_users(log))


@query
def dedup_latest(spark, sf_dir):
    log = _log(spark, sf_dir).select(USER, "ts", "event_id", "page", "level", "location")
    return clean.latest_rows(log, [USER], [F.desc("ts"), F.desc("event_id")])


@query
def index_select(spark, sf_dir):
    log = sample_log(spark, sf_dir).select("event_id", USER, "ts", "page")
    return clean.index_select(log, POSITIONS, "event_id")


# Per-user features

for _build in (
    f.song_counts,
    f.distinct_artist,
    f.unique_locations,
    f.unique_sessions,
    f.positive_usage,
    f.negative_usage,
    f.user_level,
    f.avg_daily_listens,
    f.days_since_registration,
    f.churn_label,
    f.page_pivot,
    f.user_agents,
    f.session_gaps,
):
    QUERIES[_build.__name__] = lambda spark, sf_dir, build=_build: build(_log(spark, sf_dir))


@query
def churn_label_wide(spark, sf_dir):
    return f.churn_label(_log(spark, sf_dir), schema.CHURN_PAGES_WIDE)


@query
def positive_usage_misspelt(spark, sf_dir):
    return f.positive_usage(_log(spark, sf_dir), schema.POSITIVE_PAGES_MISSPELT)


@query
def avg_daily_listens_filled(spark, sf_dir):
    return _round(f.avg_daily_listens(_log(spark, sf_dir), rounded=False, zero_filled=True))


@query
def service_change_pivot(spark, sf_dir):
    pages = schema.SERVICE_EXIT_PAGES
    return f.page_pivot(_log(spark, sf_dir), pages, excluded=None)


@query
def service_change_ranked(spark, sf_dir):
    """Users who submitted exactly one downgrade, most downgrade visits first."""
    pivot = f.page_pivot(_log(spark, sf_dir), schema.SERVICE_EXIT_PAGES, excluded=None)
    return pivot.filter(F.col("Submit Downgrade") == 1).orderBy(F.desc("Downgrade"), USER)


@query
def between_session_gaps(spark, sf_dir):
    return _round(f.between_session_gaps(_log(spark, sf_dir)))


@query
def event_gaps(spark, sf_dir):
    return _round(f.event_gaps(_log(spark, sf_dir), "event_id"))


@query
def event_gaps_raw(spark, sf_dir):
    """Gaps in the log before cleaning: rows without a user form sessions of their own."""
    return _round(f.event_gaps(_raw(spark, sf_dir), "event_id"))


@query
def model_features(spark, sf_dir):
    """Columns of the unlogged matrix that models take by default."""
    names = t.select_features(fm.feature_matrix(_log(spark, sf_dir)))
    return spark.createDataFrame([(n,) for n in names if n not in (USER, "label")], "feature string")


@query
def core_features(spark, sf_dir):
    return fm.core_features(_log(spark, sf_dir))


@query
def user_features(spark, sf_dir):
    return fm.user_features(_log(spark, sf_dir))


@query
def user_features_bucketed(spark, sf_dir):
    """User features of a log that was stored in buckets of users."""
    log = write_bucketed(_log(spark, sf_dir), f"ebbline_log_{uuid.uuid4().hex}", BUCKETS)
    return fm.user_features(log)


@query
def features_outer(spark, sf_dir):
    """The core features as full outer joins of separate feature tables."""
    log = _log(spark, sf_dir)
    wide = f.churn_label(log)
    for build in (f.song_counts, f.user_level, f.positive_usage, f.negative_usage, f.unique_locations):
        wide = wide.join(build(log), USER, "outer")
    return wide


@query
def feature_matrix(spark, sf_dir):
    return fm.feature_matrix(_log(spark, sf_dir))


@query
def drop_duplicates(spark, sf_dir):
    """Distinct whole rows of a part of the log that repeats many of them."""
    return _raw(spark, sf_dir).select(USER, "sessionId", "level", "location", "page").dropDuplicates()


@query
def feature_matrix_left(spark, sf_dir):
    """Label with features joined left, users without a feature kept as null."""
    log = _log(spark, sf_dir)
    wide = f.churn_label(log)
    for feature in (b.songs_listened(log), f.page_pivot(log), f.days_since_registration(log)):
        wide = wide.join(feature, USER, "left")
    return wide


@query
def log_features(spark, sf_dir):
    log = _log(spark, sf_dir)
    return _round(fm.feature_matrix(log, mode="all_users", use_log=True))


@query
def log_features_first(spark, sf_dir):
    log = _log(spark, sf_dir)
    return _round(fm.feature_matrix(log, mode="complete_case", use_log=True, scope="first"))


# Scalar functions


@query
def time_parts(spark, sf_dir):
    ts = F.col("ts")
    return sample_log(spark, sf_dir).select(
        "event_id",
        F.date_format(fn.event_date(ts), "yyyy-MM-dd").alias("date"),
        fn.event_hour(ts).alias("hour_of_day"),
        fn.day_name(ts).alias("day_of_week"),
        F.unix_millis(fn.event_time(ts)).alias("millis"),
    )


@query
def ua_families(spark, sf_dir):
    log = sample_log(spark, sf_dir).select("event_id", "userAgent")
    return f.with_agent_families(log).drop("userAgent")


@query
def one_hot(spark, sf_dir):
    log = f.with_agent_families(sample_log(spark, sf_dir)).select("event_id", "device", "level")
    encoded = {"device": schema.DEVICE_FAMILIES, "level": ("free", "paid")}
    return transform.one_hot(log, encoded)


@query
def one_hot_discovered(spark, sf_dir):
    """One-hot over the values that the log holds."""
    log = f.with_agent_families(sample_log(spark, sf_dir)).select("event_id", "device", "level")
    return transform.one_hot(log, {c: transform.discover_categories(log, c) for c in ("device", "level")})


@query
def user_agents_discovered(spark, sf_dir):
    return f.user_agents_discovered(_log(spark, sf_dir))


@query
def page_pivot_discovered(spark, sf_dir):
    log = _log(spark, sf_dir)
    return f.page_pivot(log, f.discover_pages(log))


@query
def registration_age(spark, sf_dir):
    log = b.registration_age(sample_log(spark, sf_dir))
    return log.select("event_id", "life_time", "day_since_registration")


@query
def soft_clip(spark, sf_dir):
    features = fm.user_features(_log(spark, sf_dir))
    clipped = transform.soft_clip_columns(features, ["song_counts", "avg_daily_listens"])
    return _round(clipped.select(USER, "song_counts_softClip", "avg_daily_listens_softClip"))


@query
def winsorize(spark, sf_dir):
    columns = ["song_counts", "avg_daily_listens", "days_since_registration"]
    clipped = transform.winsorize(_features(spark, sf_dir), columns)
    return _round(clipped.select(USER, *(f"{c}_clipped" for c in columns)))


@query
def winsorize_log(spark, sf_dir):
    columns = ["song_counts", "unique_sessions"]
    clipped = transform.winsorize_log(_features(spark, sf_dir), columns)
    names = [f"{c}_log{part}" for c in columns for part in ("", "Clip")]
    return _round(clipped.select(USER, *names))


@query
def log_and_clip(spark, sf_dir):
    already = F.col("unique_sessions").alias("sessions_log")
    features = _features(spark, sf_dir).select(USER, "song_counts", already)
    return _round(transform.log_and_clip(features, ["song_counts", "sessions_log"]))


# Churn breakdowns


@query
def churn_rate(spark, sf_dir):
    return _round(b.churn_rate(_log(spark, sf_dir)))


@query
def churn_by_gender(spark, sf_dir):
    return b.churn_by_gender(_log(spark, sf_dir))


@query
def users_by_state(spark, sf_dir):
    return b.users_by_state(_log(spark, sf_dir))


@query
def top_states(spark, sf_dir):
    return b.top_states(b.users_by_state(_log(spark, sf_dir)))


@query
def churn_by_state(spark, sf_dir):
    return _round(b.churn_by_state(b.users_by_state(_log(spark, sf_dir))))


@query
def state_summary(spark, sf_dir):
    states = materialize(b.churn_by_state(b.users_by_state(_log(spark, sf_dir))), "states")
    return _round(profile.describe(states, ["total_count", "churn_share"]))


@query
def cancel_by_agent(spark, sf_dir):
    return b.cancel_by_agent(_raw(spark, sf_dir))


@query
def distinct_agents(spark, sf_dir):
    return b.distinct_agents(_raw(spark, sf_dir))


@query
def page_share(spark, sf_dir):
    return _round(b.page_share(b.page_counts(_raw(spark, sf_dir))))


@query
def page_share_join(spark, sf_dir):
    counts = materialize(b.page_counts(_raw(spark, sf_dir)), "page-counts")
    return _round(b.page_share_join(counts))


@query
def avg_page_visits(spark, sf_dir):
    return _round(b.avg_visits_by_level(_log(spark, sf_dir)))


@query
def avg_songs_by_level(spark, sf_dir):
    return _round(b.avg_songs_by_level(_log(spark, sf_dir)))


@query
def avg_thumbs_by_level(spark, sf_dir):
    return _round(b.avg_thumbs_by_level(_log(spark, sf_dir)))


@query
def avg_thumbs_rounded(spark, sf_dir):
    return b.avg_thumbs_by_level(_log(spark, sf_dir), rounded=True)


@query
def service_change_counts(spark, sf_dir):
    return b.service_change_counts(_raw(spark, sf_dir))


@query
def service_funnel(spark, sf_dir):
    return b.service_funnel(_raw(spark, sf_dir))


@query
def service_page_correlations(spark, sf_dir):
    pages = schema.SERVICE_EXIT_PAGES
    pivot = materialize(f.page_pivot(_log(spark, sf_dir), pages, excluded=None), "service-pivot")
    return _round(corr.correlations(pivot, pages))


@query
def artist_play_histogram(spark, sf_dir):
    return b.artist_play_histogram(_raw(spark, sf_dir), more_than=1)


@query
def songs_by_weekday(spark, sf_dir):
    return _round(b.songs_by_weekday(_log(spark, sf_dir)))


@query
def hourly_plays(spark, sf_dir):
    return b.hourly_plays(_log(spark, sf_dir))


@query
def songs_by_hour(spark, sf_dir):
    return _round(b.songs_by_hour(_log(spark, sf_dir)))


@query
def songs_by_day_hour(spark, sf_dir):
    return _round(b.songs_by_day_hour(_raw(spark, sf_dir)))


@query
def songs_listened(spark, sf_dir):
    return b.songs_listened(_raw(spark, sf_dir))


@query
def page_interactions(spark, sf_dir):
    return b.page_interactions(_raw(spark, sf_dir), schema.POSITIVE_PAGES)


@query
def registration_histogram(spark, sf_dir):
    """Whole days since registration of cancel events, ten bins."""
    log = b.registration_age(_raw(spark, sf_dir))
    cancels = log.filter(F.col("page") == "Cancellation Confirmation")
    days = materialize(cancels.select("day_since_registration"), "cancel-days")
    return _round(profile.histogram(days, ["day_since_registration"]))


# Profile and distributions


@query
def row_count(spark, sf_dir):
    return profile.row_count(_raw(spark, sf_dir))


@query
def null_profile(spark, sf_dir):
    return profile.null_profile(_raw(spark, sf_dir))


@query
def null_profile_sketch(spark, sf_dir):
    """Profile of the log from sketches per day: first all days but the last, then what is new."""
    log, day = _raw(spark, sf_dir), fn.event_date(F.col("ts"))
    store = scratch_path(spark, "sketches")
    last = log.agg(F.max(day).alias("day")).scalar()
    sketches.add_parts(log.filter(day < last), day, store)
    return sketches.merged_profile(sketches.add_parts(log, day, store))


@query
def null_profile_counting_null(spark, sf_dir):
    return profile.null_profile(_raw(spark, sf_dir), count_null=True)


@query
def null_map(spark, sf_dir):
    return profile.null_map(_raw(spark, sf_dir).select(*LOG_COLUMNS))


@query
def null_patterns(spark, sf_dir):
    return profile.null_patterns(_raw(spark, sf_dir).select(*LOG_COLUMNS))


@query
def null_cooccurrence(spark, sf_dir):
    return profile.null_cooccurrence(_raw(spark, sf_dir).select(*LOG_COLUMNS))


@query
def null_edges(spark, sf_dir):
    return profile.null_edges(_raw(spark, sf_dir).select(*LOG_COLUMNS))


@query
def describe_by_label(spark, sf_dir):
    return _round(profile.describe_by_label(_features(spark, sf_dir), FEATURES))


@query
def feature_means_by_label(spark, sf_dir):
    features = fm.user_features(_log(spark, sf_dir))
    return _round(profile.feature_means_by_label(features, FEATURES))


@query
def label_counts(spark, sf_dir):
    return profile.group_counts(f.churn_label(_log(spark, sf_dir)), ["label"])


@query
def label_by_level(spark, sf_dir):
    return profile.group_counts(fm.core_features(_log(spark, sf_dir)), ["label", "level_flag"])


@query
def value_counts(spark, sf_dir):
    return profile.value_counts(_features(spark, sf_dir), ["label", *FEATURES])


@query
def feature_histogram(spark, sf_dir):
    return _round(profile.histogram(_features(spark, sf_dir), FEATURES))


@query
def box_stats(spark, sf_dir):
    return _round(profile.box_stats(_features(spark, sf_dir), ["label", *FEATURES]))


@query
def feature_skew(spark, sf_dir):
    return _round(profile.feature_skew(fm.user_features(_log(spark, sf_dir)), ["label", *FEATURES]))


@query
def outlier_counts(spark, sf_dir):
    return profile.outlier_counts(_features(spark, sf_dir), ["label", *FEATURES])


@query
def feature_correlations(spark, sf_dir):
    return _round(corr.correlations(_features(spark, sf_dir), ["label", *FEATURES]))


@query
def page_correlations(spark, sf_dir):
    pivot = materialize(f.page_pivot(_log(spark, sf_dir)), "page-pivot")
    return _round(corr.correlations(pivot, schema.PIVOT_PAGES))


@query
def correlated_pairs(spark, sf_dir):
    columns = ["label", *FEATURES]
    matrix = corr.correlations(_features(spark, sf_dir), columns)
    return _round(corr.correlated_pairs(matrix, columns))


# Checks


@query
def dq_cancel_unique(spark, sf_dir):
    return checks.cancel_unique(_log(spark, sf_dir))


@query
def dq_state_totals(spark, sf_dir):
    return checks.state_totals(materialize(b.users_by_state(_log(spark, sf_dir)), "states"))


@query
def dq_missing_users(spark, sf_dir):
    return checks.missing_user_counts(_log(spark, sf_dir))


# Model preparation and metrics


@query
def train_test_split(spark, sf_dir):
    return transform.with_split(f.churn_label(_log(spark, sf_dir)), USER)


@query
def stratified_folds(spark, sf_dir):
    labels = materialize(f.churn_label(_log(spark, sf_dir)), "labels")
    return transform.stratified_folds(labels, USER)


@query
def minmax_scale(spark, sf_dir):
    """Scaled by the range of the training side."""
    features = _features(spark, sf_dir)
    train, _ = transform.train_test_split(features, USER)
    columns = ["song_counts", "days_since_registration", "unique_sessions"]
    scaled = transform.minmax_scale(features, columns, fit_on=train)
    return _round(scaled.select(USER, *(f"{c}_scaled" for c in columns)))


@query
def standard_scale(spark, sf_dir):
    columns = ["song_counts", "days_since_registration", "unique_sessions"]
    scaled = transform.standard_scale(_features(spark, sf_dir), columns)
    return _round(scaled.select(USER, *(f"{c}_scaled" for c in columns)))


def _scored(spark, sf_dir):
    """Features with a deterministic score, for metrics that need no model."""
    mixed = F.col("song_counts") * 7 + F.col("unique_sessions") * 13 + F.col("neg_interactions") * 5
    probability = (mixed % 97 + 1) / 99
    scored = fm.user_features(_log(spark, sf_dir)).select(
        USER, "label", probability.alias("probability")
    )
    return scored.withColumn("prediction", (F.col("probability") >= 0.5).cast("int"))


@query
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(_scored(spark, sf_dir))


@query
def score_metrics(spark, sf_dir):
    return _round(metrics.score_metrics(_scored(spark, sf_dir)))


@query
def validation_report(spark, sf_dir):
    scored = materialize(_scored(spark, sf_dir), "scored")
    return _round(metrics.validation_report(scored, predictors=3))


@query
def best_thresholds(spark, sf_dir):
    return _round(metrics.best_thresholds(materialize(_scored(spark, sf_dir), "scored")))


@query
def knn_classify(spark, sf_dir):
    train, test = transform.train_test_split(_features(spark, sf_dir), USER)
    return neighbours.knn_classify(train, test, KNN_FEATURES, USER)


@query
def near_embeddings(spark, sf_dir):
    """Five nearest vectors of every vector whose id is divisible by 100, among all vectors."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return near_points.near_points(vectors, vectors.filter("vec_id % 100 = 0"), "vec_id", "embedding")


@query
def assemble(spark, sf_dir):
    rows = transform.assemble(fm.user_features(_log(spark, sf_dir)), FEATURES)
    vector = t.vector_to_array("features")
    return rows.select(USER, *(vector[i].alias(name) for i, name in enumerate(FEATURES)))


@query
def vector_kinds(spark, sf_dir):
    return transform.vector_kinds(_prepared(spark, sf_dir).train, "features")


@query
def pca_variance(spark, sf_dir):
    return _round(t.pca_variance(_features(spark, sf_dir), FEATURES))


@query
def covariance_matrix(spark, sf_dir):
    return _round(t.covariance_matrix(_features(spark, sf_dir), FEATURES))


@query
def naive_bayes_predictions(spark, sf_dir):
    """Gaussian naive Bayes from sufficient statistics of the training side, on the test side."""
    train, test = transform.train_test_split(_features(spark, sf_dir), USER)
    model = bayes.fitted(bayes.statistics(train, FEATURES))
    return _round(bayes.classify(test, model, FEATURES).select(USER, "label", "prediction", "probability"))


@query
def naive_bayes_folds(spark, sf_dir):
    """Hits per fold of models of the other folds: all models come from one aggregation."""
    rows = materialize(_features(spark, sf_dir).withColumn("fold", (transform.row_hash(USER) % 4).cast("int")), "folds")
    parts = materialize(bayes.statistics(rows, FEATURES, by=["fold"]), "bayes-sums")
    models = bayes.fitted(bayes.without_fold(parts, "fold"), ["fold"])
    scored = bayes.classify(rows, models, FEATURES, ["fold"])
    hits = F.count_if(F.col("label") == F.col("prediction")).alias("hits")
    return scored.groupBy("fold").agg(F.count("*").alias("rows"), hits)


# Models. Logistic and boosted plans run whole; what the other grids leave out is in the README.


def _prepared(spark, sf_dir) -> t.Prepared:
    matrix = fm.feature_matrix(_log(spark, sf_dir), mode="all_users")
    return t.prepare(materialize(matrix, "matrix"), schema.MODEL_FEATURES)


def _plan_scores(prepared: t.Prepared, name: str, grid: dict | None = None, **options) -> DataFrame:
    model = t.run_plan(name, prepared.train, grid, key=prepared.key, **{"parallelism": FITS_AT_ONCE} | options)
    scored = t.predictions(model.bestModel, prepared.test)
    return metrics.score_metrics(scored).withColumn("model", F.lit(name))


@query
def train_logistic(spark, sf_dir):
    return _plan_scores(_prepared(spark, sf_dir), "logistic_regression")


@query
def train_random_forest(spark, sf_dir):
    return _plan_scores(_prepared(spark, sf_dir), "random_forest")


@query
def train_gbt(spark, sf_dir):
    return _plan_scores(_prepared(spark, sf_dir), "gradient_boost")


@query
def train_glm_grid(spark, sf_dir):
    return _plan_scores(_prepared(spark, sf_dir), "glm")


@query
def train_gbm_grid(spark, sf_dir):
    return _plan_scores(_prepared(spark, sf_dir), "gbm")


@query
def train_drf_grid(spark, sf_dir):
    grid = {
        "numTrees": [10],
        "maxDepth": [5],
        "minInstancesPerNode": [1, 5],
        "subsamplingRate": [0.8],
        "featureSubsetStrategy": ["0.8"],
        "minInfoGain": [1e-3],
    }
    return _plan_scores(_prepared(spark, sf_dir), "distributed_forest", grid, folds=3)


@query
def cv_scores(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    return _round(t.cv_scores(t.run_plan("logistic_regression", prepared.train, key=prepared.key)))


@query
def predictions(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    return t.predictions(t.balanced_logistic(prepared.train), prepared.test)


def _single(spark, sf_dir, **models) -> DataFrame:
    return t.leaderboard(models, _prepared(spark, sf_dir))


@query
def train_logistic_balanced(spark, sf_dir):
    return _single(spark, sf_dir, LogisticRegression=t.balanced_logistic)


@query
def train_trees(spark, sf_dir):
    names = ("RandomForestClassifier", "GradientBoostingClassifier", "DecisionTreeClassifier")
    return _single(spark, sf_dir, **{name: t.MODEL_PLAN[name] for name in names})


@query
def train_linear_svc(spark, sf_dir):
    return _single(spark, sf_dir, SupportVectorClassifier=t.linear_svc)


@query
def train_adaboost(spark, sf_dir):
    return _single(spark, sf_dir, AdaBoostClassifier=t.real_adaboost)


@query
def train_bagging(spark, sf_dir):
    return _single(spark, sf_dir, BaggingClassifier=t.bagging)


@query
def train_naive_bayes(spark, sf_dir):
    return _single(spark, sf_dir, Gaussian_Naive_Bayes=t.naive_bayes)


@query
def leaderboard(spark, sf_dir):
    return t.leaderboard(t.MODEL_PLAN, _prepared(spark, sf_dir))


@query
def model_validation(spark, sf_dir):
    """Validation report of a fitted model on the test side."""
    prepared = _prepared(spark, sf_dir)
    scored = t.predictions(t.balanced_logistic(prepared.train), prepared.test)
    scored = materialize(scored, "scored")
    return _round(metrics.validation_report(scored, predictors=len(prepared.features)))


@query
def feature_importance(spark, sf_dir):
    prepared = _prepared(spark, sf_dir)
    return t.feature_importance(t.balanced_logistic(prepared.train), prepared.features)

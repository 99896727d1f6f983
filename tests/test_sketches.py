"""Profiles from kept sketches, nearest points by projections, and the bucketed log."""

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbline.functions.columns import event_date
from ebbline.operators import clean, near_points, profile, sketches
from ebbline.operators import features as f
from ebbline.plans import feature_matrix as fm
from ebbline.schema import USER
from ebbline.sources import sample_log, write_bucketed

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def log(spark):
    return clean.clean_log(sample_log(spark, SF_DIR), columns=None)


def test_sketches_follow_the_exact_profile(spark, log, tmp_path):
    day, path = F.date_format(event_date(F.col("ts")), "yyyy-MM-dd"), str(tmp_path / "store")
    early = log.filter(F.col("ts") < log.select(F.percentile_approx("ts", 0.5)).first()[0])
    sketches.add_parts(early.filter(~day.isin([r[0] for r in early.select(F.max(day)).collect()])), day, path)
    before = {r.part for r in spark.read.parquet(path).select("part").distinct().collect()}
    whole = sketches.add_parts(log, day, path)
    assert before and {r.part for r in whole.select("part").distinct().collect()} > before
    got = {r.column: r for r in sketches.merged_profile(whole).collect()}
    for row in profile.null_profile(log).collect():
        assert (got[row.column].n_rows, got[row.column].null_count) == (log.count(), row.null_count)
        assert got[row.column].unique_count == pytest.approx(row.unique_count, rel=4 * sketches.ERROR, abs=0.5)
    # Nothing is new, so nothing is read or added.
    assert sketches.add_parts(log, day, path).count() == whole.count()


def test_known_parts_are_not_read(spark, log, tmp_path):
    days, path = str(tmp_path / "days"), str(tmp_path / "store")
    log.withColumn("day", event_date(F.col("ts"))).write.partitionBy("day").parquet(days)
    stored = spark.read.parquet(days)
    first = stored.filter(F.col("day") == stored.select(F.min("day")).first()[0])
    sketches.add_parts(first, F.col("day"), path)
    known = sketches.known_parts(stored, path)
    fresh = stored.filter(~F.col("day").cast("string").isin(known))
    plan = fresh._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and known[0] in plan.split("PartitionFilters")[1]
    assert len(known) == 1 and fresh.count() == stored.count() - first.count()


def test_null_parts_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "store")
    df = spark.createDataFrame([("a", 1, None), (None, 2, None), (None, 2, 0.5)], "p string, x int, y double")
    sketches.add_parts(df.filter("p = 'a'"), F.col("p"), path)
    store = sketches.add_parts(df, F.col("p"), path)
    found = {r.column: (r.n_rows, r.null_count, r.unique_count) for r in sketches.merged_profile(store).collect()}
    assert found == {"p": (3, 2, 1), "x": (3, 0, 2), "y": (3, 2, 1)}
    assert sketches.add_parts(df.limit(0), F.col("p"), path).count() == store.count()


def plain_nearest(points, queries, k):
    x = np.array([v for _, v in points])
    ids = np.array([i for i, _ in points])
    out = {}
    for i, q in queries:
        d = np.sqrt(((x - np.array(q)) ** 2).sum(axis=1))
        order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), d[j]) for j in order]
    return out


def test_recall_of_nearest_embeddings(spark):
    """Queries are all rows whose id is divisible by 100, held against all rows."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    queries = df.filter("vec_id % 100 = 0")
    got = {}
    for r in near_points.near_points(df, queries, "vec_id", "embedding").collect():
        got.setdefault(r.vec_id, []).append((r.place, r.neighbour, r.distance))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    exact = plain_nearest(rows, [r for r in rows if r[0] % 100 == 0], 5)
    assert set(got) == set(exact)
    hits = sum(len({n for _, n, _ in got[i]} & {n for n, _ in exact[i]}) for i in exact)
    assert hits >= 0.9 * 5 * len(exact)
    for found in got.values():
        found.sort()
        assert [p for p, _, _ in found] == [1, 2, 3, 4, 5] and [d for *_, d in found] == sorted(d for *_, d in found)


def test_recall_where_cells_decide(spark):
    """Clusters of very different width, so that rounds settle their own queries."""
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(40, 8)) * 20
    data = [(i, (centres[i % 40] + draw.normal(size=8) * 10.0 ** (i % 4 - 2)).tolist()) for i in range(4_000)]
    df = spark.createDataFrame(data, "id long, v array<double>")
    queries = df.filter("id % 100 = 0")
    got = {}
    for r in near_points.near_points(df, queries, "id", "v").collect():
        got.setdefault(r.id, set()).add(r.neighbour)
    exact = plain_nearest(data, [d for d in data if d[0] % 100 == 0], 5)
    hits = sum(len(got[i] & {n for n, _ in exact[i]}) for i in exact)
    assert hits >= 0.9 * 5 * len(exact)


def test_meeting_probability():
    draw = np.random.default_rng(1)
    for ratio in (0.5, 1.0, 3.0):
        gap, shift = draw.normal(size=200_000), draw.random(200_000) * ratio
        met = (np.floor((gap + shift) / ratio) == np.floor(shift / ratio)).mean()
        assert near_points.meeting(np.array([ratio]))[0] == pytest.approx(met, abs=0.005)


def test_odd_points(spark):
    rows = [(1, [0.0, 0.0]), (2, [0.0, 0.0]), (3, [1.0, 0.0]), (4, None), (5, [math.nan, 0.0]), (6, [1.0]), (None, [0.0, 1.0]), (7, [None, 1.0])]
    df = spark.createDataFrame(rows, "id long, v array<double>")
    got = near_points.near_points(df, df, "id", "v", k=5).orderBy("id", "place").collect()
    assert [(r.id, r.place, r.neighbour, r.distance) for r in got] == [
        (1, 1, 2, 0.0), (1, 2, 3, 1.0), (2, 1, 1, 0.0), (2, 2, 3, 1.0), (3, 1, 1, 1.0), (3, 2, 2, 1.0)
    ]
    assert near_points.near_points(df.limit(0), df, "id", "v").collect() == []
    assert near_points.near_points(df, df.limit(0), "id", "v").collect() == []


@pytest.fixture(scope="module")
def bucketed(spark, log, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("bucketed") / "log")
    yield write_bucketed(log, "ebbline_test_log", 4, path=path)
    spark.sql("DROP TABLE IF EXISTS ebbline_test_log")


@pytest.mark.parametrize("build", [fm.user_features, fm.core_features, f.churn_label, f.page_pivot, f.unique_sessions, f.session_gaps])
def test_a_bucketed_log_is_not_exchanged(spark, log, bucketed, build):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = build(bucketed)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert not re.search(r"Exchange hashpartitioning", plan)
    assert sorted(map(str, found.collect())) == sorted(map(str, build(log).collect()))


def test_a_bucket_is_one_file(spark, bucketed):
    files = {r[0] for r in bucketed.select(F.input_file_name()).distinct().collect()}
    assert len(files) == 4
    assert bucketed.select(USER, F.input_file_name()).distinct().count() == bucketed.select(USER).distinct().count()


@pytest.mark.parametrize("keys", ["long", "string"])
def test_isolated_queries_are_scanned_without_moving_points(spark, monkeypatch, keys):
    """Blocks of queries, copies at equal distances and a task's several batches give what brute force gives."""
    monkeypatch.setattr(near_points, "SCAN_QUERIES", 7)
    monkeypatch.setattr(near_points, "SCAN_POINTS", 16)
    monkeypatch.setattr(near_points, "PAIRS_PER_POINT", 0)
    draw = np.random.default_rng(3)
    x = np.vstack([draw.normal(size=(150, 8)), np.repeat(draw.normal(size=(3, 8)), 10, axis=0)])
    rows = [(i, r.tolist()) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "id long, v array<double>").withColumn("id", F.col("id").cast(keys)).repartition(3)
    queries = df.filter("cast(id as long) % 6 = 0")
    plans = []
    real = near_points.materialize
    monkeypatch.setattr(near_points, "materialize", lambda d, n: plans.append((n, d)) or real(d, n))
    got: dict = {}
    for r in near_points.near_points(df, queries, "id", "v", k=4).orderBy("id", "place").collect():
        got.setdefault(int(r.id), []).append(r.neighbour)
    made = (lambda i: i) if keys == "long" else str
    for q in range(0, 180, 6):
        square = [(sum((a - b) ** 2 for a, b in zip(x[q], x[i])), made(i)) for i in range(180) if i != q]
        assert got[q] == [name for _, name in sorted(square)[:4]]
    scans = [d for n, d in plans if n == "scanned"]
    assert len(got) == 30 and len(scans) > 1
    for d in scans:
        assert "Exchange" not in d._jdf.queryExecution().executedPlan().toString()

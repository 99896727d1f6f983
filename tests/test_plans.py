"""Physical plans: what must and must not be in them."""

import re

import pytest

from ebbline.operators import clean
from ebbline.operators import features as f
from ebbline.plans import feature_matrix as fm
from ebbline.plans.catalog import QUERIES
from ebbline.schema import USER
from ebbline.sources import sample_log

SF_DIR = "/root/testdata/sf0.001"
MODELS = [n for n in QUERIES if n.startswith("train_") and n != "train_test_split"]
GROUPED_PYTHON = ("FlatMapGroupsInPandas", "FlatMapCoGroupsInPandas", "FlatMapGroupsInArrow", "MapInPandas", "MapInArrow")
#: Distances of bounded blocks are computed as arrays.
IN_BLOCKS = {"knn_classify", "near_embeddings"}
EAGER = {*MODELS, "leaderboard", "cv_scores", "feature_importance", "predictions"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def log(spark):
    return clean.clean_log(sample_log(spark, SF_DIR), columns=None)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - EAGER))
def test_no_cross_joins_and_no_python(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for node in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", *GROUPED_PYTHON):
        assert node not in plan or (node in GROUPED_PYTHON and name in IN_BLOCKS)


# Distinct values are read apart from the wide row of counters.
@pytest.mark.parametrize(
    ("build", "scans"), [(fm.user_features, 2), (fm.core_features, 1), (f.churn_label, 1), (f.page_pivot, 1)]
)
def test_few_scans_and_hash_aggregation(log, build, scans):
    plan = plan_of(build(log))
    assert plan.count("FileScan") == scans
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan


def test_feature_matrix_parts_are_joined_where_they_are(spark, log):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(fm.feature_matrix(log))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("SortMergeJoin") == 2
    # One exchange for each of three parts and two for distinct pairs; none for the joins.
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 5


def test_narrow_queries_read_narrow_columns(log):
    assert re.search(r"ReadSchema: struct<user_id:bigint,event_type:string,value:double,props:string>", plan_of(f.churn_label(log)))


def test_latest_rows_are_limited_before_the_shuffle(spark):
    plan = plan_of(QUERIES["dedup_latest"](spark, SF_DIR))
    assert plan.count("WindowGroupLimit") == 2


def test_filters_reach_a_stored_log(spark, tmp_path):
    path = str(tmp_path / "log")
    sample_log(spark, SF_DIR).write.parquet(path)
    stored = spark.read.parquet(path)
    plan = plan_of(f.churn_label(clean.clean_log(stored)))
    assert "Not(EqualTo(userId,))" in plan and "ReadSchema: struct<userId:string,page:string>" in plan
    assert USER in plan

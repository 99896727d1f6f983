"""Every query against its SQL form, and rows from those without one."""

from dataclasses import replace
from functools import partial

import pytest
from compare import connect, differences

from ebbline.plans import training
from ebbline.plans.catalog import QUERIES
from ebbline.plans.oracle import ORACLES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def database():
    connection = connect(SF_DIR)
    yield connection
    connection.close()


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, database, name):
    assert differences(QUERIES[name](spark, SF_DIR), database, ORACLES[name]) == []


#: Whole searches and a hundred rounds take minutes; here they are a corner of theirs, the README has the times.
CORNERS = {
    "random_forest": {"numTrees": [10, 20], "maxDepth": [10], "impurity": ["gini"]},
    "gbm": {"stepSize": [0.1], "maxIter": [5, 10], "maxDepth": [3, 4]},
}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_gives_rows(spark, name, monkeypatch):
    for plan, grid in CORNERS.items():
        monkeypatch.setitem(training.PLANS, plan, replace(training.PLANS[plan], grid=grid))
    boosted = partial(training.real_adaboost, rounds=5)
    monkeypatch.setattr(training, "real_adaboost", boosted)
    monkeypatch.setitem(training.MODEL_PLAN, "AdaBoostClassifier", boosted)
    monkeypatch.setitem(training.MODEL_PLAN, "GradientBoostingClassifier", partial(training.boosted_trees, rounds=5))
    assert QUERIES[name](spark, SF_DIR).count() > 0

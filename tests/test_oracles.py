"""Every registered query against its SQL."""

import pytest
from oracle_compare import compare, connect

from purchase_signals.plans.oracles import ORACLES
from purchase_signals.plans.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
# Model output depends on sums in no fixed order; tested in test_training.py.
WITHOUT_SQL = {"train_gbt", "predictions", "batch_predict"}


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


def test_every_query_is_accounted_for():
    assert set(QUERIES) == set(ORACLES) | WITHOUT_SQL


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    assert compare(QUERIES[name](spark, SF_DIR), duck.sql(ORACLES[name])) is None


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0

"""Every query against its SQL counterpart on the smallest tables."""

import pytest

import check
from forgemeter.plans.catalogue import QUERIES
from forgemeter.plans.oracles import ORACLES
from tests.conftest import SMALL

NAMES = list(QUERIES)


@pytest.fixture(scope="module")
def db():
    return check.connect(SMALL)


def test_every_query_has_sql():
    assert set(ORACLES) == set(NAMES)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, db, name):
    ok, note = check.compare(spark, db, SMALL, name)
    assert ok, note


def test_entry(spark):
    df = check.contract.entry(spark)
    assert df.columns[0] == "repo_name"
    assert df.count() == 100 or 0 < df.count() < 100

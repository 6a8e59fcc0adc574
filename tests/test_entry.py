"""Every registered query agrees with its SQL oracle on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from tests.check_oracles import compare, connect
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()


def test_all_queries_are_registered():
    assert QUERIES.keys() <= entry.queries().keys()
    assert ORACLES.keys() <= entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(spark, db, name):
    assert compare(spark, db, SF_DIR, QUERIES[name], ORACLES[name]) is None


def test_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["sender", "avgLength", "avgNoOfRecipients"]
    assert df.count() > 0

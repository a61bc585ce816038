"""Every query against its SQL on DuckDB."""

import os

import pytest
from compare import compare, duck

import __spark_entry__
from moorage.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    return duck(FOLDER)


def test_every_query_has_its_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= __spark_entry__.queries().keys()
    assert ORACLES.keys() <= __spark_entry__.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    _, difference = compare(QUERIES[name](spark, FOLDER), ORACLES[name], oracle)
    assert not difference, difference


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0

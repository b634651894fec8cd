"""Every registered query against its SQL on the smallest driver tables."""

import os

import pytest

from checks import load_all
from checks.catalog import ORACLES, QUERIES
from checks.compare import compare, oracle_connection

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
load_all()


@pytest.fixture(scope="module")
def connection():
    if not os.path.isdir(SF_DIR):
        pytest.skip(f"no test data in {SF_DIR}")
    return oracle_connection(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, connection, name):
    verdict, _, _ = compare(spark, connection, name, SF_DIR)
    assert verdict == "ok"


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)

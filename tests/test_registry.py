"""Every registered query against its SQL, at the smallest scale."""

import os

import pytest

import check
from quadrille.plans import catalog

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no tables")
    return check.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(catalog.oracle_sql()) == set(catalog.queries())


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query(spark, con, name):
    ok, text = check.compare(spark, con, SF_DIR, name)
    assert ok, text


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0

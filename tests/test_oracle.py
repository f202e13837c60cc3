"""Every registered query beside its SQL, on the smallest test tables."""

import os

import pytest

import compare

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", compare.entry.oracle_sql())
def test_query(spark, con, name):
    _, found = compare.difference(spark, con, name, SF_DIR)
    assert found is None


def test_every_query_of_the_reports_has_sql():
    missing = set(compare.entry.queries()) - set(compare.entry.oracle_sql())
    assert {name for name in missing if name != "pipeline" and not name.startswith("op")} == set()


def test_entry(spark):
    assert compare.entry.entry(spark).columns[:2] == ["uf", "cid_principal"]

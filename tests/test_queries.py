"""Every registered query on the smallest tables, against its SQL on DuckDB where it has one."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import check, connect

FOLDER = os.environ.get("PAGEMILL_TEST_TABLES", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    result = check(spark, duck, FOLDER, name, entry.queries()[name], entry.oracle_sql().get(name))
    assert result["ok"], result["why"]
    assert not result.get("types"), result["types"]


def test_entry(spark):
    assert entry.entry(spark).columns == ["conv_id", "turn", "pos", "type", "speaker", "text", "branch"]

"""Every registered query beside its oracle on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from tests.oracle import compare, connect

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_agrees_with_oracle(spark, duck, name):
    ok, message, _ = compare(spark, duck, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, message


def test_flagship_has_rows_and_a_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["user", "position", "id", "similarity", "source"]
    assert df.limit(1).count() == 1


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())

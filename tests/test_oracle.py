"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as entry
import check_oracle


@pytest.fixture(scope="module")
def con(sf_dir):
    return check_oracle.duck(sf_dir)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, sf_dir, name):
    assert check_oracle.compare(spark, con, name, sf_dir) is None


def test_every_sql_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["example_id", "label", "raw", "score"]

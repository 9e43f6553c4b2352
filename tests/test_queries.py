"""Every registered query against its check SQL."""

import pytest

import __spark_entry__ as entry
import checks


@pytest.fixture(scope="module")
def con(sf_dir):
    return checks.check_engine(sf_dir)


def test_every_check_has_a_query():
    assert not set(entry.oracle_sql()) - set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, sf_dir, name):
    df = entry.queries()[name](spark, sf_dir)
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert df.count() >= 0
    else:
        assert checks.differences(df, con, sql) is None

import importlib

import pytest

check = importlib.import_module("check")


@pytest.fixture(scope="module")
def connection(sf):
    return check.connect(sf)


def names():
    return sorted(check.contract.queries())


def test_every_sql_has_a_query():
    assert set(check.contract.oracle_sql()) <= set(names())


@pytest.mark.parametrize("name", names())
def test_query_agrees_with_sql(spark, sf, connection, name):
    good, note = check.compare(spark, connection, name, sf)
    assert good, note


def test_entry(spark, sf):
    frame = check.contract.entry(spark)
    assert frame.columns == ["timestamp", "signal", "n", "ci_lo", "ci_hi"] and frame.count() > 0

"""Every query against its SQL, on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
import compare  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return compare.connect(SMALL)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, duck, name):
    names, rows = compare.spark_rows(entry.queries()[name](spark, SMALL))
    sql = entry.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    want_names, want_rows = compare.duck_rows(duck, sql)
    assert names == want_names
    assert rows == want_rows


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() > 0
    assert result.columns[:3] == ["window_start", "window_end", "hotspots_in_window"]

"""Every registered query against DuckDB on the smallest data set."""

import compare
import pytest

import __spark_entry__ as contract

DATA = compare.SMALLEST
NAMES = sorted(contract.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return compare.connect(str(DATA))


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, con, name):
    sql = contract.oracle_sql()[name]
    assert compare.differences(contract.queries()[name](spark, str(DATA)), con, sql) == []


def test_entry_has_rows(spark):
    df = contract.entry(spark)
    assert df.columns == ["hour", "order_count", "items_sold", "revenue"]
    assert df.count() > 0


def test_every_query_reads_the_tables(spark):
    """No registered query is built from literals alone."""
    streamed = {n for n in NAMES if n.startswith("stream_")}
    for name in NAMES:
        if name in streamed:
            continue
        assert contract.queries()[name](spark, str(DATA)).inputFiles(), name

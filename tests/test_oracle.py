"""Every registered query against DuckDB on the smallest sample."""

from __future__ import annotations

import pytest
from compare import connect, differences

from __spark_entry__ import entry, oracle_sql, queries
from tidemark.catalogue.queries import QUERIES

# test_pipeline checks this one on the tables it stores anyway.
STORED = {"pipeline_row_counts"}
SQL = oracle_sql()


@pytest.fixture(scope="module")
def con(sample):
    return connect(sample)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL) <= set(queries())


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in STORED])
def test_query(spark, sample, con, name):
    assert differences(queries()[name](spark, sample), con, SQL[name]) == []


def test_entry(spark):
    result = entry(spark)
    assert result.columns == ["full_date", "gross_revenue_usd", "net_margin_usd"]
    assert not result.isEmpty()

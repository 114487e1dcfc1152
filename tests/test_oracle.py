"""Every query with SQL gives the same rows in DuckDB."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
import oracle_check

QUERIES, SQL = entry_points.queries(), entry_points.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return oracle_check.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, sf_dir, name):
    result, _ = oracle_check.compare(spark, duck, sf_dir, name, QUERIES, SQL)
    assert not result.startswith("FAIL"), result


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert "label" in frame.columns and frame.limit(1).count() == 1

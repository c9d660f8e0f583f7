"""Every registered query against its SQL in DuckDB, over whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from ledgerlake.queries import REGISTRY
from verify import compare, open_duckdb

SQL = entry.oracle_sql()
QUERIES = {name: query for name, query in entry.queries().items() if name in REGISTRY}


@pytest.fixture(scope="module")
def duck(sf_dir):
    return open_duckdb(sf_dir)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(QUERIES) <= set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, sf_dir, name):
    verdict, note = compare(spark, duck, name, sf_dir, QUERIES[name], SQL[name])
    assert verdict == "OK", note

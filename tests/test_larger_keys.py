"""Queries on tables whose packed ids leave 64 bits, against their SQL in DuckDB."""

from __future__ import annotations

import duckdb
import pytest
from test_testtables import PACKED, SHIFTS, large_keys  # noqa: F401

import __spark_entry__ as entry
from verify import compare

SQL = entry.oracle_sql()
QUERIES = entry.queries()
NAMES = [
    "bank_treemap10",
    "close_source_batch",
    "compact_banks",
    "compact_snapshot",
    "compact_accounts",
    "curated_completeness",
    "curated_daily",
    "curated_aml_rate",
    "curated_format_rate",
    "curated_patterns",
    "curated_flags",
]


@pytest.fixture(scope="module")
def wide_duck(large_keys):  # noqa: F811
    """The same tables; a line number of 128 bits lets the SQL as it is pack the keys of every line."""
    connection = duckdb.connect()
    for name in SHIFTS:
        columns = "* REPLACE (l_linenumber::HUGEINT AS l_linenumber)" if name == "lineitem" else "*"
        files = f"{large_keys}/{name}.parquet/*.parquet"
        connection.execute(f"CREATE VIEW {name} AS SELECT {columns} FROM read_parquet('{files}')")
    return connection


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, wide_duck, large_keys, name):  # noqa: F811
    verdict, note = compare(spark, wide_duck, name, large_keys, QUERIES[name], SQL[name])
    assert verdict == "OK", note


def test_batch_failure_matches_sql(spark, wide_duck, large_keys):  # noqa: F811
    """All but the mark as in the SQL; the mark is the place of the line that the SQL names."""
    found = QUERIES["batch_failure"](spark, large_keys)
    (row,) = found.collect()
    result = wide_duck.execute(SQL["batch_failure"])
    want = dict(zip([d[0] for d in result.description], result.fetchone()))
    day = "datediff(cast(l_shipdate as date), date'1990-01-01')"
    packed = PACKED.replace(day, "date_diff('day', DATE '1990-01-01', l_shipdate::DATE)")
    mark = want["source_high_watermark"]
    assert mark > 2**63
    (place,) = wide_duck.execute(f"SELECT count(*) FROM lineitem WHERE {packed} <= {mark}").fetchone()
    assert row.asDict() == {**want, "source_high_watermark": place}
    assert found.schema["source_high_watermark"].dataType.simpleString() == "bigint"

"""The SQL of the byte, word and near-duplicate queries against brute force, and the queries against it."""

from __future__ import annotations

import duckdb
import pyarrow as pa
import pytest
from brute import repeated_bytes, repeated_words, similar

from ledgerlake.llm.registry import QUERIES, SQL
from verify import compare, open_duckdb

BRUTE = {
    "op2_suffix_array": repeated_bytes,
    "op8_fixed_blocks": repeated_words,
    "op7_ngram_join": lambda docs: sorted(((i, *x) for i, x in similar(docs).items()), key=repr),
}
LONG = " ".join(f"w{i * i % 977}" for i in range(120))
ROWS = [
    (1, LONG),
    (2, "é" + LONG + "漢字"),
    (3, LONG[:180] + " other end " + LONG[200:420]),
    (4, None),
    (5, ""),
    (6, " \t\n "),
    (7, "la " * 90),
    (8, "la " * 35 + "漢" * 40),
    (9, "漢" * 17),
    (10, LONG + " tail"),
    (11, "a b"),
    (12, "a  b"),
    (13, "x" * 50),
    (14, "y" + "x" * 49),
]


@pytest.mark.parametrize("rows", [ROWS, []], ids=["rows", "empty"])
@pytest.mark.parametrize("name", BRUTE)
def test_sql_matches_brute_force(name, rows):
    connection = duckdb.connect()
    ids, texts = zip(*rows) if rows else ((), ())
    connection.register("documents", pa.table({"doc_id": pa.array(ids, pa.int64()), "text": pa.array(texts, pa.string())}))
    assert sorted(connection.execute(SQL[name]).fetchall(), key=repr) == BRUTE[name](rows)


@pytest.mark.parametrize("name", sorted(SQL))
def test_queries_match_their_sql(spark, name):
    folder = "/root/testdata/sf0.001"
    verdict, note = compare(spark, open_duckdb(folder), name, folder, QUERIES[name], SQL[name])
    assert verdict == "OK", note

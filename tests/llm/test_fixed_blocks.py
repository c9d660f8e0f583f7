from __future__ import annotations

import pytest
from brute import repeated_words, rows_of

from ledgerlake.llm.fixed_blocks import drop_repeated_passages, op8_fixed_blocks

COLUMNS = ("doc_id", "n_words", "n_removed", "kept_sha256")


def words(a, b):
    return " ".join(f"w{i}" for i in range(a, b))


def test_whole_table_matches_brute_force(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert rows_of(op8_fixed_blocks(documents), *COLUMNS) == repeated_words(rows)


CASES = {
    "shifted": [(1, "a " + words(0, 60) + " b"), (2, "x y z " + words(3, 58) + " q"), (3, words(100, 150))],
    "exactly one window": [(1, words(0, 35)), (2, "p " + words(0, 35) + " r")],
    "one word short": [(1, "a " + words(0, 34) + " b"), (2, "c " + words(0, 34) + " d")],
    "within one document": [(1, words(0, 40) + " mid " + words(0, 40))],
    "one word again and again": [(1, "la " * 90), (2, "la " * 34)],
    "nulls, empties, spaces": [(1, None), (2, ""), (3, " \t\n\v\f\r "), (4, "é ü " + words(0, 3))],
    "repeated rows": [(1, words(0, 50)), (1, words(0, 50)), (None, words(200, 240))],
    "many copies": [(i, words(0, 80) + f" end{i}") for i in range(300)],
    "long": [(1, words(0, 30000)), (2, words(10000, 20000))],
}


@pytest.mark.parametrize("name", CASES)
def test_small_cases(frame, name):
    assert rows_of(op8_fixed_blocks(frame(CASES[name])), *COLUMNS) == repeated_words(CASES[name])


def test_empty_table_and_clashing_columns(frame):
    assert op8_fixed_blocks(frame([])).collect() == []
    clash = frame(CASES["shifted"]).selectExpr("*", "1 AS row", "2 AS places", "3 AS bucket", "4 AS id")
    assert rows_of(op8_fixed_blocks(clash), *COLUMNS) == repeated_words(CASES["shifted"])


def test_spans_are_maximal_repeats(frame):
    out = drop_repeated_passages(frame(CASES["shifted"])).collect()
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in out}
    assert spans == {1: [(4, 59)], 2: [(3, 58)], 3: []}

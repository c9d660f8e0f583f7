from __future__ import annotations

import numpy as np
import pytest
from brute import similar

from ledgerlake.llm import ngram_join
from ledgerlake.llm.components import components
from ledgerlake.llm.ngram_join import least_matches, near_duplicates, op7_ngram_join


def result(df):
    return {r["doc_id"]: (r["class_id"], r["n_links"]) for r in op7_ngram_join(df).collect()}


def words(seed, n):
    return [f"w{x}" for x in np.random.default_rng(seed).integers(0, 5000, n)]


def edited(seed, base, edits):
    out, rng = list(base), np.random.default_rng(seed)
    for at in rng.choice(len(out), edits, replace=False):
        out[at] = f"e{seed}x{at}"
    return " ".join(out)


def test_whole_table_matches_brute_force(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert result(documents) == similar(rows)


BASE = words(1, 300)
CASES = {
    "copies and near copies": [(9, " ".join(BASE)), (4, " ".join(BASE)), (6, edited(1, BASE, 3)), (2, " ".join(words(2, 300))), (3, edited(2, BASE, 40))],
    "white space only differs": [(1, "a b c d e f g"), (2, "a  b\tc\nd e f g "), (3, "A b c d e f g")],
    "short, empty, null": [(1, "a b"), (2, "a  b"), (3, "b a"), (4, ""), (5, None), (6, " "), (7, "a b c d e")],
    "a threshold met exactly": [(1, " ".join(f"t{i}" for i in range(13))), (2, " ".join(f"t{i}" for i in range(1, 14)))],
    "one word again and again": [(1, "la " * 500), (2, "la " * 7), (3, "la la la la")],
    "a large group": [(i, edited(i, BASE, 4)) for i in range(1, 700)] + [(1000 + i, " ".join(BASE)) for i in range(50)],
    "a long text": [(1, " ".join(words(5, 60000))), (2, edited(3, words(5, 60000), 200))],
}


@pytest.mark.parametrize("name", CASES)
def test_small_cases(frame, name):
    assert result(frame(CASES[name])) == similar(CASES[name])


def test_empty_table_repeated_ids_and_clashing_columns(frame):
    assert near_duplicates(frame([])).collect() == []
    rows = CASES["copies and near copies"]
    clash = frame(rows).selectExpr("*", "1 AS row", "2 AS root", "3 AS a", "4 AS bands", "5 AS id")
    assert result(clash) == similar(rows)
    out = near_duplicates(frame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "x y")])).collect()
    assert sorted((r["n_links"], r["is_first"]) for r in out) == [(0, True), (1, False), (1, True)]


def test_odd_ids_leave_the_names_of_other_classes(frame):
    rows = CASES["copies and near copies"]
    out = near_duplicates(frame([*rows, (50, "x y z"), (50, "u v w"), (None, "k l m"), (None, " ".join(BASE))])).collect()
    want = similar(rows)
    assert {r["doc_id"]: r["class_id"] for r in out if (r["doc_id"] or 50) != 50} == {i: c for i, (c, _) in want.items()}
    assert {r["doc_id"] for r in out if r["is_first"]} == {c for c, _ in want.values()} | {50, None}
    assert sorted(r["class_id"] or 0 for r in out if r["doc_id"] is None) == [0, want[4][0]]


def test_pruning_keeps_likely_pairs_and_drops_others():
    assert least_matches(32, 0.8, 1e-6) < 0.6 * 32
    assert least_matches(200, 0.8, 1e-6) > 0.6 * 200
    assert ngram_join.LEAST == 0.8 and ngram_join.WIDTH == 5


def test_components_of_chains_and_stars(spark):
    chain = [(i + 1, i) for i in range(500)]
    star = [(2000 + i, 2000) for i in range(1, 300)]
    edges = spark.createDataFrame(chain + star + [(7000, 7001), (7000, 7001)], "u long, v long").repartition(7)
    got = {r["node"]: r["root"] for r in components(edges, "test").collect()}
    assert got == {i: 0 for i in range(501)} | {2000 + i: 2000 for i in range(300)} | {7000: 7000, 7001: 7000}

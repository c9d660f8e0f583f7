from __future__ import annotations

import numpy as np
import pytest
from brute import repeated_bytes, rows_of

from ledgerlake.llm.registry import QUERIES
from ledgerlake.llm.suffix_array import cover_ranks, drop_repeated_bytes, op2_suffix_array, smallest_owner

COLUMNS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def text(seed, n):
    return bytes(np.random.default_rng(seed).integers(97, 123, n, dtype=np.uint8)).decode()


def test_whole_table_matches_brute_force(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert rows_of(op2_suffix_array(documents), *COLUMNS) == repeated_bytes(rows)


A, B = text(1, 400), text(2, 3000)
CASES = {
    "shifted": [(5, "x" + A + "y"), (3, A[10:350]), (9, "zz" + A[40:200] + "q" + A[100:300])],
    "exactly 50": [(1, A[:50]), (2, "Q" + A[:50] + "R")],
    "49 only": [(1, "1" + A[:49] + "2"), (2, "3" + A[:49] + "4")],
    "not within one document": [(1, A + A), (2, "none")],
    "runs of one letter": [(1, "a" * 500), (2, "b" + "a" * 300), (3, "ab" * 200), (4, "ab" * 30 + "c")],
    "two bytes a letter": [(1, "é" * 30 + "ü" * 60), (2, "ü" * 40 + "é" * 25)],
    "nulls and empties": [(1, None), (2, ""), (3, "short"), (4, None)],
    "many copies": [(i, A + f"{i:07d}" + B[:200]) for i in range(400)],
    "near copies": [(i, B[: 7 * i] + "#" + B[7 * i :]) for i in range(1, 200)],
    "a popular line": [(i, A[:61] + text(1000 + i, 120)) for i in range(300)],
    "long": [(1, text(7, 900_000)), (2, text(7, 900_000)[300_000:600_000] + A)],
}


@pytest.mark.parametrize("name", CASES)
def test_small_cases(frame, name):
    assert rows_of(op2_suffix_array(frame(CASES[name])), *COLUMNS) == repeated_bytes(CASES[name])


def test_popular_minimizers_take_the_split_way(frame):
    rows = CASES["a popular line"] + [(1000 + i, t) for i, t in CASES["near copies"]]
    out = drop_repeated_bytes(frame(rows), popular=20)
    want = {(i, n, gone) for i, n, gone, _, _ in repeated_bytes(rows)}
    assert {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in out.collect()} == want


def test_repeated_ids_stay_apart(frame):
    out = op2_suffix_array(frame([(1, A), (1, A), (None, A[:100])])).collect()
    assert sorted(r["n_removed"] for r in out) == [0, 100, 400]


def test_odd_ids_leave_the_order_of_the_others(frame):
    rows = [(9, A), (7, text(3, 80)), (None, A), (3, A[:200]), (7, text(4, 80)), (2, A[100:300])]
    out = op2_suffix_array(frame(rows).repartition(1)).collect()
    gone = {r["doc_id"]: r["n_removed"] for r in out if r["doc_id"] != 7}
    assert gone == {9: 300, None: 400, 3: 100, 2: 0}
    assert [r["n_removed"] for r in out if r["doc_id"] == 7] == [0, 0]


def test_empty_table_and_clashing_columns(frame):
    assert op2_suffix_array(frame([])).collect() == []
    clash = frame(CASES["shifted"]).selectExpr("*", "1 AS row", "2 AS places", "3 AS bucket", "4 AS kind", "5 AS id")
    assert rows_of(op2_suffix_array(clash), *COLUMNS) == repeated_bytes(CASES["shifted"])


def test_cover_ranks_and_blocks():
    data = np.frombuffer((A[:90] * 4 + B[:300] + A[:77] * 3).encode(), np.uint8)
    padded = np.append(data, np.zeros(60, np.uint8))
    words = np.array([int.from_bytes(padded[i : i + 8].tobytes(), "big") for i in range(len(data))], np.uint64)
    ranks = cover_ranks(words, 42)
    at = [i for i in range(len(data) - 42) if ranks[i] >= 0]
    assert [x for _, x in sorted((data[i : i + 42].tobytes(), i) for i in at)] == sorted(at, key=lambda i: (ranks[i], i))
    starts = np.arange(len(data) - 50)
    owners = starts * 7 % 101
    least = {}
    for s, o in zip(starts, owners):
        key = data[s : s + 50].tobytes()
        least[key] = min(least.get(key, o), o)
    want = [least[data[s : s + 50].tobytes()] for s in starts]
    assert smallest_owner(data, starts, owners).tolist() == want
    same_residue = starts % 8 == 0
    least = {}
    for s, o in zip(starts[same_residue], owners[same_residue]):
        key = data[s : s + 50].tobytes()
        least[key] = min(least.get(key, o), o)
    found = smallest_owner(data, starts[same_residue], owners[same_residue], aligned=True)
    assert found.tolist() == [least[data[s : s + 50].tobytes()] for s in starts[same_residue]]


def test_popular_windows_are_removed_wherever_a_document_holds_them(spark, frame):
    runs = [(i, "bcdefghijkl"[i] * i + "a" * 600) for i in range(1, 10)]
    rows = runs + [(20 + i, (text(5, 60) + text(i, 30)) * 9) for i in range(1, 10)]
    want = {(i, n, gone) for i, n, gone, _, _ in repeated_bytes(rows)}
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # documents in several tasks, as in a large table
    try:
        out = drop_repeated_bytes(frame(rows), popular=20).collect()
    finally:
        spark.conf.unset(key)
    assert {(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in out} == want


def by_strictly_smaller_ids(rows):
    """Brute force; a row without an id has no smaller document and is none."""
    own = repeated_bytes([x for x in rows if x[0] is not None])
    alone = [(None, *repeated_bytes([(0, t)])[0][1:]) for i, t in rows if i is None]
    return sorted(own + alone, key=repr)


@pytest.mark.parametrize("popular", [20, 20_000])
def test_only_a_smaller_id_takes_bytes(frame, popular):
    rows = [(7, A), (7, A), (None, A[:100]), (9, A[50:300]), (9, A[50:300] * 2), (None, A), (3, A[200:260])]
    rows += [(i % 5 + 100, B[: 9 * i] + "#" + B[9 * i :]) for i in range(1, 60)]
    rows += [(i % 4 + 200, (A[:61] + text(1000 + i, 30)) * 3) for i in range(40)]
    got = drop_repeated_bytes(frame(rows), popular=popular, by_id=True).collect()
    want = by_strictly_smaller_ids(rows)
    assert sorted(((r["doc_id"], r["n_removed"]) for r in got), key=repr) == sorted(((x[0], x[2]) for x in want), key=repr)


def test_the_registered_query_follows_the_ids(spark, frame, tmp_path):
    rows = [(1, A), (1, A), (2, A[:100] + B[:70]), (None, A), (None, B[:300])]
    frame(rows).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    assert rows_of(QUERIES["op2_suffix_array"](spark, str(tmp_path)), *COLUMNS) == by_strictly_smaller_ids(rows)

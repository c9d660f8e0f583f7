from __future__ import annotations

import re

from brute import repeated_bytes, similar
from test_packing import check
from test_spaced_seeds import tokens

import __spark_entry__ as entry
import corpus_pipeline as cp
from ledgerlake.llm.common import stage
from ledgerlake.llm.spaced_seeds import op5_spaced_seeds

SF = "/root/testdata/sf0.01"


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def letters_kept(text, others_first, length=50):
    """The text without the bytes that a 50-byte string of a smaller document covers, whole letters only."""
    raw = (text or "").encode()
    gone = bytearray(len(raw))
    for x in range(len(raw) - length + 1):
        if raw[x : x + length] in others_first:
            gone[x : x + length] = b"\1" * length
    out, at = [], 0
    for letter in text or "":
        n = len(letter.encode())
        if not all(gone[at : at + n]):
            out.append(letter)
        at += n
    return "".join(out)


def test_each_stage_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    before = docs
    for name, function in cp.STAGES:
        after = stage(function(spark, before, SF), "test-pipeline")
        seen[name] = (texts(before), after)
        if name != cp.STAGES[-1][0]:
            assert after.columns == columns
        before = after

    given, after = seen["language"]
    assert texts(after) == {i: t for i, t in given.items() if re.search(r"[^\W\d_]", t or "")}

    given, after = seen["near_duplicates"]
    classes = similar(list(given.items()))
    assert texts(after) == {i: t for i, t in given.items() if classes[i][0] == i}

    given, after = seen["repeated_passages"]
    got, first = texts(after), set()
    removed = {i: (n, gone) for i, n, gone, _, _ in repeated_bytes(list(given.items()))}
    for i in sorted(given):
        want = letters_kept(given[i], first)
        assert (i in got) == (not removed[i][0] or removed[i][0] > removed[i][1])
        if i in got:
            assert got[i] == want
        raw = given[i].encode()
        first |= {raw[x : x + 50] for x in range(len(raw) - 49)}
    assert all(r["n_chars"] == len(r["text"]) for r in after.collect())

    given, after = seen["benchmark"]
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [" " + " ".join(tokens(r["text"])) + " " for r in benchmark.collect()]
    leaked = {i for i, t in given.items() if any(x in " " + " ".join(tokens(t)) + " " for x in items)}
    frame = spark.createDataFrame(list(given.items()), "doc_id long, text string")
    flagged = {r["doc_id"] for r in op5_spaced_seeds(frame, benchmark).collect()}
    assert leaked and leaked <= flagged and texts(after) == {i: t for i, t in given.items() if i not in flagged}

    given, after = seen["packing"]
    assert check(after.collect(), list(given.items()), ids=True) > 0.98


def test_odd_documents_pass_every_stage(spark, frame):
    rows = [(1, None), (2, ""), (3, "12 34"), (4, "the words of a short text"), (4, "the words of a short text"), (None, "other words of another text"), (5, "ü" * 400), (6, "ü" * 400 + "é")]
    for rows in (rows, []):
        docs = frame(rows).selectExpr("*", "1 AS rest", "2 AS _row", "3 AS places")
        for _, function in cp.STAGES:
            docs = stage(function(spark, docs, SF), "test-pipeline")
        assert {r["doc_id"] for r in docs.collect()} <= {None, 4, 5, 6}


def test_the_smallest_id_stays_beside_odd_rows(spark, frame):
    rows = [(9, "one two three four five six"), (3, "one two three four five six"), (None, "one two three four five six"), (7, "a b"), (7, "c d")]
    assert sorted(r["doc_id"] for r in cp.one_of_each(spark, frame(rows).repartition(1), SF).collect()) == [3, 7, 7]


def test_run_is_registered():
    assert entry.queries()["pipeline"] is cp.run
    assert [name for name in entry.queries() if re.match(r"op\d+_", name)] and cp.ORACLE_SQL is None
    assert len(cp.STAGES) == 5

from __future__ import annotations

from itertools import permutations

import numpy as np
import pytest

from ledgerlake.llm.filter_audit import gallop, merged, op13_filter_audit, unions

COLUMNS = ("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def brute(docs, labels):
    """Rows of the audit for (doc_id, text, lang) and (doc_id, quality, toxic), filter by filter."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    judged = {}
    for i, text, lang in docs:
        text = text or ""
        words = text.encode().split()
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and any(j is not None and j < i and (t or "") == text for j, t, _ in docs),
        }
        judged.setdefault(lang or "", []).append(({k for k, v in fails.items() if v}, i in good, i in toxic))
    out = []
    for part, rows in judged.items():
        steps, removed_by = [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = rows
            for step, f in enumerate(order, 1):
                lost, left = [r for r in left if f in r[0]], [r for r in left if f not in r[0]]
                removed_by[f] += len(lost)
                all_f = sum(f in r[0] for r in rows)
                only = sum(r[0] == {f} for r in rows)
                steps.append((part, order, step, len(left), len(lost), all_f - len(lost), only, sum(r[1] for r in lost), sum(r[2] for r in lost)))
        out += [(*s, removed_by[s[1][s[2] - 1]]) for s in steps]
    return sorted(out)


def audit(spark, docs, labels):
    frame = spark.createDataFrame(docs, "doc_id long, text string, lang string").selectExpr("*", "1 AS rows", "true AS A", "'q' AS part", "0 AS good", "'k' AS digest", "7 AS _id")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    result = op13_filter_audit(frame, marks)
    assert tuple(result.columns) == COLUMNS
    return sorted(tuple(r) for r in result.collect())


LONG = " ".join(f"word{i}" for i in range(400))
CASES = {
    "nulls, empties, ties, repeated rows": (
        [(1, None, "en"), (2, "", "en"), (3, LONG, None), (3, LONG, None), (4, LONG, ""), (None, LONG, "en"), (None, None, "en"), (5, LONG + " #", "de"), (5, "ALL CAPS", "de"), (-7, LONG, "en")],
        [(1, 1, 1), (1, None, 0), (3, 0, 1), (4, 1, None), (None, 1, 1), (99, 1, 1), (5, 1, 0)],
    ),
    "words split by six characters only": (
        [(1, "a b " * 150, "en"), (2, "\t\n\x0b\f\r x y\x1c", "en"), (3, "A" * 3 + "b" * 97, "en"), (4, "A" * 4 + "b" * 96, "en"), (5, "é" * 96 + "ABC ", "en")],
        [],
    ),
    "one text for a third of all rows, a very long text": (
        [(i, "same #text " * 120 if i % 3 == 0 else f"{LONG} {i}", "en" if i % 2 else "fr") for i in range(600)] + [(1000, "very long " * 200_000, "fr")],
        [(i, i % 2, int(i % 5 == 0)) for i in range(0, 600, 2)],
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_small_cases(spark, name):
    docs, labels = CASES[name]
    assert audit(spark, docs, labels) == brute(docs, labels)


def test_empty_tables(spark):
    assert audit(spark, [], []) == []
    docs = [(1, LONG, "en")]
    assert audit(spark, docs, []) == brute(docs, [])


def test_whole_table(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = sorted(tuple(r) for r in op13_filter_audit(documents, labels).select(*COLUMNS).collect())
    assert rows == brute([tuple(r) for r in documents.select("doc_id", "text", "lang").collect()], [tuple(r) for r in labels.collect()])
    assert len(rows) == 600 * 4


def test_gallop_and_unions():
    random = np.random.default_rng(3)
    lists = [np.unique(random.integers(0, 5000, n)) for n in (0, 1, 40, 900, 3000)]
    for held in lists:
        for ids in lists:
            assert (gallop(held, ids) == np.searchsorted(held, ids)).all()
            assert (merged(held, ids) == np.union1d(held, ids)).all()
    for number, found in enumerate(unions(lists)):
        wanted = set().union(*(x.tolist() for i, x in enumerate(lists) if number >> i & 1))
        assert found.tolist() == sorted(wanted)

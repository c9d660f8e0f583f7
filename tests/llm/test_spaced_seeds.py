from __future__ import annotations

import random
import re

import pytest

from ledgerlake.llm import spaced_seeds
from ledgerlake.llm.spaced_seeds import op5_spaced_seeds, overlaps, without_overlap


def tokens(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())


def segments(doc, item):
    """Longest agreeing count over all diagonals, substitutions at the operator's price."""
    best = 0
    for shift in range(-len(item) + 1, len(doc)):
        score = agreeing = 0
        for q, token in enumerate(item):
            if not 0 <= q + shift < len(doc):
                continue
            same = doc[q + shift] == token
            score, agreeing = score + (1 if same else -2), agreeing + same
            if score <= 0:
                score = agreeing = 0
            best = max(best, agreeing)
    return best


def test_whole_table_holds_every_exact_leak_and_no_weak_pair(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    docs = {r["doc_id"]: tokens(r["text"]) for r in documents.select("doc_id", "text").collect()}
    items = {r["item_id"]: tokens(r["text"]) for r in benchmark.collect()}
    found = {(r["doc_id"], r["item_id"]): r for r in op5_spaced_seeds(documents, benchmark).collect()}
    joined = {i: " " + " ".join(w) + " " for i, w in docs.items()}
    exact = {(d, i) for i, w in items.items() for d, t in joined.items() if " " + " ".join(w) + " " in t}
    assert exact and exact <= set(found)
    for (d, i), r in found.items():
        assert r["agreeing"] >= min(12, 0.8 * len(items[i]))
        a, b = docs[d][r["doc_start"] : r["doc_start"] + r["length"]], items[i][r["item_start"] : r["item_start"] + r["length"]]
        assert sum(x == y for x, y in zip(a, b)) == r["agreeing"]


ITEM = "Alpha bravo, charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa"


def substituted(step):
    return " ".join("X" if i % step == step - 1 else w for i, w in enumerate(ITEM.split()))


DOCS = [
    (1, "start " + ITEM.upper() + " end"),
    (2, substituted(6)),
    (3, "unrelated words only"),
    (4, " ".join(ITEM.split()[:6])),
    (5, None),
    (6, ""),
    (7, "the the the " * 3000),
    (8, "one two three four five six seven eight nine ten " * 200 + ITEM.replace(" ", "\n")),
    (1, "start " + ITEM),
]


def test_small_cases(spark, frame):
    items = [(1, ITEM), (2, "tiny one"), (3, None), (4, ""), (5, "quebec romeo sierra tango uniform"), (6, "the the the the the the the")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = frame(DOCS + [(9, "so quebec romeo sierra tango uniform now")])
    want = {
        (d, i)
        for d, t in DOCS + [(9, "so quebec romeo sierra tango uniform now")]
        for i, x in items
        if len(tokens(x)) >= 5 and segments(tokens(t)[:4000], tokens(x)) >= min(12, 0.8 * len(tokens(x)))
    }
    assert {(r["doc_id"], r["item_id"]) for r in op5_spaced_seeds(docs, benchmark).collect()} == want
    assert {(1, 1), (2, 1), (8, 1), (9, 5), (7, 6)} == want
    assert sorted(r["doc_id"] for r in without_overlap(docs, benchmark).collect()) == [3, 4, 5, 6]


def test_blocks_of_test_items_give_the_same(spark, frame, monkeypatch):
    benchmark = spark.createDataFrame([(i, ITEM if i == 3 else f"other{i} " * 9) for i in range(8)], "item_id long, text string")
    once = overlaps(frame(DOCS), benchmark).collect()
    monkeypatch.setattr(spaced_seeds, "BLOCK_BYTES", 100)
    assert sorted(overlaps(frame(DOCS), benchmark).collect()) == sorted(once)
    assert without_overlap(frame(DOCS), benchmark).count() == 5


@pytest.mark.parametrize("empty", ["docs", "benchmark"])
def test_empty_tables_and_clashing_columns(spark, frame, empty):
    benchmark = spark.createDataFrame([(1, ITEM)], "item_id long, text string").selectExpr("*", "1 AS doc_id")
    docs = frame(DOCS).selectExpr("*", "1 AS item_id", "2 AS length")
    docs, benchmark = (docs.limit(0), benchmark) if empty == "docs" else (docs, benchmark.limit(0))
    assert overlaps(docs, benchmark).collect() == []
    assert without_overlap(docs, benchmark).count() == docs.count()


def pairs(spark, frame, docs, items):
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in op5_spaced_seeds(frame(docs), benchmark).collect()}


def test_short_items_are_found_wherever_their_substitutions_lie(spark, frame):
    items, docs, want = [], [], set()
    for n in range(1, 15):
        words = [f"item{n}word{k}" for k in range(n)]
        items.append((n, " ".join(words)))
        allowed = 0 if n < 5 else 1 if n < 10 else 2
        for i in range(n + 1):
            for j in range(i, n + 1):  # n stands for no substitution
                doc = len(docs)
                changed = {i, j} - {n}
                docs.append((doc, " ".join(["before"] + ["x" if k in changed else w for k, w in enumerate(words)] + ["after"])))
                if len(changed) <= allowed:
                    want.add((doc, n))
        edge = len(docs)  # the text ends or begins within the item
        docs += [(edge, " ".join(words[allowed:])), (edge + 1, " ".join(words[: n - allowed]))]
        want |= {(edge, n), (edge + 1, n)}
    assert pairs(spark, frame, docs, items) == want


def test_scripts_without_spaces(spark, frame):
    items = [(1, "什么是最小的素数"), (2, "ประเทศไทยมีกี่จังหวัด"), (3, "東京はどこにありますか"), (4, "𠀀𠀁𠀂"), (5, "большой дом")]
    docs = [(i, f"前面的话{t}後の文ต่อ") for i, t in items] + [(9, "什么是最大的素数"), (10, "什么东西"), (11, "ein большой дом, ja")]
    assert pairs(spark, frame, docs, items) == {(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (9, 1), (11, 5)}


def admitted(same):
    """The rule on one diagonal: SHARE of all places, or the best of all segments (of equals the first, longest)."""
    n = len(same)
    scores = {(lo, hi): sum(1 if x else -2 for x in same[lo:hi]) for lo in range(n) for hi in range(lo + 1, n + 1)}
    lo, hi = max(scores, key=lambda x: (scores[x], -x[1], -x[0]))
    return sum(same) >= 0.8 * n or sum(same[lo:hi]) >= 12


def test_one_rule_at_every_length(spark, frame):
    """Substitutions at random places: whatever the rule admits is found, nothing else."""
    draw, docs, items, want = random.Random(5), [], [], set()
    for n in (13, 14, 15, 16, 17, 20, 25, 30, 45, 60):
        words = [f"item{n}word{k}" for k in range(n)]
        items.append((n, " ".join(words)))
        for share in (0.1, 0.2, 0.3, 0.5):
            for _ in range(25):
                changed = set(draw.sample(range(n), int(share * n)))
                text = ["x" if k in changed else w for k, w in enumerate(words)]
                if admitted([k not in changed for k in range(n)]):
                    want.add((len(docs), n))
                docs.append((len(docs), " ".join(["before", *text, "after"])))
    found = pairs(spark, frame, docs, items)
    assert found == want
    assert {n for _, n in want} == {n for n, _ in items} and len(want) < len(docs)

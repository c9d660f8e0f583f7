from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import prefix_trie
from ledgerlake.llm.prefix_trie import list_rank, op11_prefix_trie

COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
SCHEMA = "conv_id long, turn int, role string, text string"


def brute(rows):
    """Nodes of the trie for (conv_id, turn, role, text) rows."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        turns = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(turns) + 1):
            members[turns[:d]].append((c, len(turns)))
    children = defaultdict(list)
    for prefix in members:
        if prefix:
            children[prefix[:-1]].append(prefix)
    leaves, saved = {}, {}
    for prefix in sorted(members, key=len, reverse=True):
        below = children[prefix]
        leaves[prefix] = sum(leaves[p] for p in below) or 1
        saved[prefix] = sum(saved[p] for p in below) + (len(members[prefix]) - 1) * (len(prefix[-1][1]) if prefix else 0)
    first = {p: min(m)[0] for p, m in members.items()}
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c, n in sorted(m) if n == len(p))
        out.append((first[p], len(p), first[p[:-1]] if p else None, len(m), len(children[p]), leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def trie(frame):
    result = op11_prefix_trie(frame)
    assert tuple(result.columns) == COLUMNS
    return sorted((tuple(r) for r in result.collect()), key=repr)


LONG = "x" * 300_000
CASES = {
    "nulls, ties, repeated rows, absent bases": [
        (0, 1, "u", "a"), (0, None, "s", "first"), (0, 2, None, "b"), (0, 2, "u", None), (0, 2, "u", None), (5, 1, "u", "a"), (5, 2, "u", "é"),
        (7, 1, "u", "z"), (101, 1, "u", "own"), (205, 0, "u", "only"), (206, 0, "u", "only"), (None, 1, "u", "lost"), (-3, 1, "u", "a"), (-105, 4, "u", "m"),
    ],
    "one conversation holds a third of the turns": [(c, t, "ab"[t % 2], f"turn {t % 7}") for c in range(40) for t in range(10)] + [(3, t, "u", str(t)) for t in range(10, 210)],
    "equal conversations and long texts": [(c, t, "u", LONG if t == 6 else "same") for c in range(0, 300) for t in range(7)],
    "turnless ones share the root": [(c, 0, "u", "gone") for c in range(1001, 1100)],
}


@pytest.mark.parametrize("name", CASES)
def test_small_cases(spark, name):
    frame = spark.createDataFrame(CASES[name], SCHEMA).selectExpr("*", "1 AS p", "2 AS depth", "'k' AS node", "3 AS _task", "4 AS digest")
    assert trie(frame) == brute(CASES[name])


def test_empty_table(spark):
    assert trie(spark.createDataFrame([], SCHEMA)) == []


def test_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert trie(table) == brute([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_merging_rounds_rank_a_shuffled_list(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK_ARCS", 16)
    order = list(range(3000))
    random.Random(5).shuffle(order)
    rows = [(a, a % 3, order[i + 1] if i + 1 < len(order) else None, order[i + 1] % 3 if i + 1 < len(order) else None, 1, a % 5, a) for i, a in enumerate(order)]
    arcs = spark.createDataFrame(rows, "a long, b long, na long, nb long, arcs long, leaves long, saved long").repartition(8)
    got = {r["a"]: (r["p_arcs"], r["p_leaves"], r["p_saved"]) for r in list_rank(arcs, walked=100).collect()}
    want, leaves, saved = {}, 0, 0
    for i, a in enumerate(order):
        want[a] = (i, leaves, saved)
        leaves, saved = leaves + a % 5, saved + a
    assert got == want


def test_a_conversation_over_many_tasks(spark, monkeypatch):
    """Positions and sums of one giant conversation whose turns lie in every task."""
    rows = spark.range(4000).select(F.when(F.col("id") < 3000, 7).otherwise(F.col("id")).alias("conv_id"), F.col("id").alias("turn"))
    summed = prefix_trie.running(rows, "conv_id", ["turn"], {"p": F.lit(1).cast("long"), "s": F.col("turn")}, "test")
    got = sorted((r["p"], r["s"]) for r in summed.filter("conv_id = 7").collect())
    assert got == [(i + 1, i * (i + 1) // 2) for i in range(3000)]
    assert summed.filter("conv_id <> 7 and p <> 1").count() == 0

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest

from ledgerlake.llm.kd_shards import kd_shards, op10_kd_shards


def check(rows, docs):
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs)
    slots, weight = defaultdict(list), Counter()
    for r in rows:
        assert 0 <= r["shard"] < 8
        slots[r["shard"]].append(r["slot"])
        weight[r["shard"]] += r["size"]
    for found in slots.values():
        assert sorted(found) == list(range(len(found)))
    return weight


def test_whole_table_in_near_equal_shards(documents):
    docs = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    rows = op10_kd_shards(documents).collect()
    weight = check(rows, docs)
    assert max(weight.values()) <= 1.03 * sum(weight.values()) / 8 and len(weight) == 8
    assert {r["law"] for r in rows} == {"bytes"} and {r["grown_shard"] for r in rows} == {None}
    shard_of = defaultdict(set)
    texts = dict(docs)
    for r in rows:
        shard_of[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(found) == 1 for found in shard_of.values())


def test_equal_texts_share_a_shard_whatever_their_other_columns(spark):
    """Groups of up to 8 % of a shard and more, with differing lang and n_chars, in one shard each."""
    rows = [(i, f"group {i % 200} " + "x" * (i % 200 % 23), "abcd"[i % 4], i) for i in range(800)]
    rows += [(1000 + i, "a heavy group of many", "ab"[i % 2], -i) for i in range(300)]
    rows += [(2000 + i, f"other words {i} " * (1 + i % 11), None, None) for i in range(2000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long")
    out = op10_kd_shards(frame).collect()
    weight = check(out, [(r[0], r[1]) for r in rows])
    texts, shard_of = {r[0]: r[1] for r in rows}, defaultdict(set)
    for r in out:
        shard_of[texts[r["doc_id"]]].add(r["shard"])
    assert {len(x) for x in shard_of.values()} == {1}
    assert max(weight.values()) - min(weight.values()) <= 300 * 22


def test_only_a_group_larger_than_a_shard_is_cut(frame):
    rows = [(i, "w" * 90) for i in range(500)] + [(1000 + i, "v" * 90 if i < 80 else f"{i:090}") for i in range(500)]
    out = op10_kd_shards(frame(rows)).collect()
    weight = check(out, rows)
    assert len({r["shard"] for r in out if r["doc_id"] < 500}) > 1
    assert len({r["shard"] for r in out if 1000 <= r["doc_id"] < 1080}) == 1
    assert max(weight.values()) <= 1.7 * sum(weight.values()) / 8


CASES = {
    "one text for a third of all rows": [(i, "same words") for i in range(400)] + [(1000 + i, f"text {i} " * (i % 9)) for i in range(800)],
    "one text only": [(i, "x" * 50) for i in range(200)],
    "nulls, empties, repeated rows": [(1, None), (2, ""), (3, None), (3, None), (None, "y")],
    "one document": [(5, "alone")],
    "very long ones": [(i, "z" * (100 + 3000 * (i % 50 == 0))) for i in range(500)],
}


@pytest.mark.parametrize("name", CASES)
def test_small_cases(frame, name):
    weight = check(op10_kd_shards(frame(CASES[name])).collect(), CASES[name])
    if len(CASES[name]) >= 200:
        largest = max(len((t or "").encode()) for _, t in CASES[name])  # a document is never cut
        assert max(weight.values()) <= 1.05 * sum(weight.values()) / 8 + largest


def test_empty_table_null_metadata_and_clashing_columns(spark, frame):
    assert op10_kd_shards(frame([])).collect() == []
    rows = [(i, f"words {i} " * i) for i in range(64)]
    clash = frame(rows).selectExpr("doc_id", "text", "CAST(NULL AS STRING) AS lang", "source", "CAST(NULL AS LONG) AS n_chars", "1 AS size", "2 AS shard", "3 AS _tie", "4 AS _node")
    check(op10_kd_shards(clash).collect(), rows)


def test_leaves_reach_the_target_bytes(frame):
    rows = [(i, "w" * (i % 37) + str(i)) for i in range(1000)]
    out = kd_shards(frame(rows), shards=None, target_bytes=1000).collect()
    weight = Counter()
    for r in out:
        weight[r["shard"]] += r["size"]
    assert set(weight) == set(range(-(-sum(weight.values()) // 1000))) and max(weight.values()) <= 1150


def test_leaves_of_groups_as_large_as_the_target(frame):
    """37 texts in groups of up to a leaf's bytes: a group stays whole, so a leaf may hold one more."""
    rows = [(i, "w" * (i % 37)) for i in range(1000)]
    out = kd_shards(frame(rows), shards=None, target_bytes=1000).collect()
    weight, group = Counter(), Counter()
    for r in out:
        weight[r["shard"]] += r["size"]
        group[r["size"]] += r["size"]
    print(weight, group)
    assert max(weight.values()) <= 1000 + max(group.values())

"""Insert-if-absent by words of bits: equal to a plain anti-join, and no row is shuffled where none need be."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import held as hd
from ledgerlake.session import stage


def table(spark, ids):
    return stage(spark.createDataFrame([(i, f"row {i}") for i in ids], "id long, note string"), "test-held")


def plain(rows, held):
    return sorted(r["id"] for r in rows.join(held.select("id"), "id", "left_anti").collect())


CASES = {
    "nothing held yet": (range(1, 500), []),
    "rerun": (range(1, 70_000), range(1, 70_000)),
    "increment from the next bucket on": (range(98_304, 140_000), range(1, 98_304)),
    "increment behind": (range(70_000, 140_000), range(1, 70_000)),
    "increment that overlaps": (range(60_000, 140_000), range(1, 70_000)),
    "every other one": (range(-3000, 70_000), range(-70_000, 70_000, 2)),
    "repeats go or pass together": ([5, 5, 6, 6, 40_000, 40_000], [6, 40_000, 40_000]),
    "ends of buckets and bytes": ([0, 1, 7, 8, 9, 32_767, 32_768, 32_769, 65_536, 65_537, -1, -32_768], [1, 8, 32_768, 65_537, -1]),
    "far apart": ([1, 10**15, -(10**15), 2**62], [10**15, 2**62 - 1]),
    "ends of the numbers": ([-(2**63), 2**63 - 1, 0, 63, 64], [2**63 - 1, 63]),
    "empty rows": ([], range(10)),
}


@pytest.mark.parametrize("name", CASES)
def test_equal_to_an_anti_join(spark, name):
    new, old = CASES[name]
    rows, old = table(spark, new), table(spark, old)
    got = hd.unheld(rows, "id", hd.words(old, "id"))
    assert got.columns == rows.columns
    assert sorted(r["id"] for r in got.collect()) == plain(rows, old)


@pytest.mark.parametrize("blocks", [1, 7, 4096])
def test_random_sets_at_any_number_of_ranges(spark, monkeypatch, blocks):
    monkeypatch.setattr(hd, "BLOCKS", blocks)
    draw = random.Random(7)
    starts = [draw.randrange(-(10**6), 10**6) for _ in range(12)]
    new = [s + draw.randrange(40_000) for s in starts for _ in range(300)]
    old = [s + i for s in starts[:5] for i in range(40_000)] + draw.sample(new, 500)
    rows, old = table(spark, new), table(spark, old)
    assert sorted(r["id"] for r in hd.unheld(rows, "id", hd.words(old, "id")).collect()) == plain(rows, old)


def test_null_keys_are_never_held_and_no_words_hold_nothing(spark):
    rows = stage(spark.createDataFrame([(None, "a"), (1, "b"), (2, "c")], "id long, note string"), "test-held")
    for old, want in (([1, 2], ["a"]), ([2], ["a", "b"]), ([9], ["a", "b", "c"]), ([None, 1], ["a", "c"])):
        held = hd.words(spark.createDataFrame([(i,) for i in old], "id long"), "id")
        assert sorted(r["note"] for r in hd.unheld(rows, "id", held).collect()) == want
    assert hd.unheld(rows, "id", None) is rows


def test_merged_words_hold_what_their_parts_hold(spark):
    parts = hd.words(table(spark, range(0, 50_000, 3)), "id").unionByName(hd.words(table(spark, range(0, 50_000, 5)), "id"))
    rows = table(spark, range(50_000))
    left = sorted(r["id"] for r in hd.unheld(rows, "id", hd.merged(parts)).collect())
    assert left == [i for i in range(50_000) if i % 3 and i % 5]


@pytest.mark.parametrize("name", ["rerun", "increment from the next bucket on"])
def test_no_row_is_shuffled_for_a_rerun_or_an_increment(spark, name):
    rows, held = (table(spark, ids) for ids in CASES[name])
    got = hd.unheld(rows, "id", hd.words(held, "id"))
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_lone_numbers_cost_words_and_no_more(spark):
    """Numbers far apart: one word each; dense ones: one for each 64."""
    far = spark.range(2000).select((F.col("id") * 10**12).alias("id"))
    assert hd.words(far, "id").count() == 2000
    assert hd.words(spark.range(64_000), "id").count() == 1000

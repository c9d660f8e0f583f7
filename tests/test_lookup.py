"""Hot and missing keys are spread; the rows found are those of a plain join."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import facts as fx
from ledgerlake.operators.lookup import hot_keys, key_counts, left_lookup
from ledgerlake.operators.scd2 import account_snapshot


@pytest.fixture(scope="module")
def frames(spark):
    # One key holds a third of the rows, one hot key has no partner at all, some rows have no key.
    rows = [(i, "A" if i % 3 == 0 else "Z" if i % 3 == 1 else f"K{i % 50}", f"n{i % 2}") for i in range(600)]
    rows += [(1000 + i, None, "n0") for i in range(300)]
    side = [("A", "n0", 1), ("A", "n1", 2)] + [(f"K{i}", "n0", 100 + i) for i in range(40)]
    return (
        spark.createDataFrame(rows, "id long, bank string, number string"),
        spark.createDataFrame(side, "b string, a string, value long"),
    )


@pytest.fixture
def no_broadcast(spark):
    """Every whole side is shuffled, and small partitions stay apart."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key in settings:
        spark.conf.unset(key)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def largest_share(df):
    """Part of the rows in the fullest task of a frame."""
    sizes = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
    return max(sizes) / sum(sizes)


def test_equals_plain_join(frames):
    rows, side = frames
    hot = hot_keys(key_counts(rows.toDF("id", "b", "a"), ["b", "a"]), ["b", "a"])
    assert {("A", "n0"), ("A", "n1"), ("Z", "n0"), ("Z", "n1")} <= {tuple(r) for r in hot.collect()}
    plain = rows.join(side.toDF("bank", "number", "value"), ["bank", "number"], "left").select("id", "bank", "number", "value")
    split = left_lookup(rows, side, {"bank": "b", "number": "a"}, "id", hot)
    assert split.columns == plain.columns
    assert rows_of(split) == rows_of(plain)


def test_hot_and_missing_keys_meet_in_no_task(frames, no_broadcast):
    rows, side = frames
    hot = hot_keys(key_counts(rows.toDF("id", "b", "a"), ["b", "a"]), ["b", "a"])
    assert largest_share(left_lookup(rows, side, {"bank": "b", "number": "a"}, "id", hot)) < 0.3


def test_hot_parties_count_both_roles(spark):
    rows = spark.createDataFrame(
        [("1", "A", "2", "B")] * 9 + [("3", f"C{i}", "1", "A") for i in range(9)],
        "from_bank_id string, from_account_id string, to_bank_id string, to_account_id string",
    )
    hot = fx.hot_parties(rows)
    assert ("1", "A") in {tuple(r) for r in hot["account"].collect()}
    assert {"1", "2", "3"} == {r[0] for r in hot["bank"].collect()}


def test_bank_with_a_third_of_all_accounts_is_spread(spark, no_broadcast):
    accounts = spark.createDataFrame(
        [("1" if i % 3 == 0 else f"{i}", f"a{i}", None if i % 2 else f"e{i}") for i in range(900)],
        "bank_id string, account_number string, entity_id string",
    )
    banks = accounts.select("bank_id").distinct().withColumn("bank_key", F.xxhash64("bank_id"))
    entities = accounts.where("entity_id is not null").select("entity_id").distinct().withColumn("entity_key", F.xxhash64("entity_id"))
    snapshot = account_snapshot(accounts, banks, entities)
    assert snapshot.count() == 900 and snapshot.where("entity_key = -1").count() == 450
    assert largest_share(snapshot) < 0.3


def test_the_loaded_fact_uses_the_split_plan(ws):
    transactions = ws.source.transactions
    hot = fx.hot_parties(transactions)
    assert hot["bank"].count() > 0
    split = fx.fact_transactions(transactions, ws.tables, 1, hot)
    assert "_is_hot" in split._jdf.queryExecution().analyzed().toString()
    loaded = ws.tables["fact_transaction"]
    assert split.exceptAll(loaded).count() == 0
    assert loaded.exceptAll(split).count() == 0

"""Comparison of two copies row by row, and what the curated copy reads."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import curated as cu

DDL = "k long, v string, n int"
ROWS = [(i, f"v{i}", i % 7) for i in range(1000)]


def differences(spark, left, right, **how):
    frames = [spark.createDataFrame(rows, DDL) for rows in (left, right)]
    out = cu.differing_rows(*frames, "k", ("left", "right"), **how)
    return sorted((tuple(r) for r in out.collect()), key=repr)


@pytest.mark.parametrize("buckets", [1, 16, 4096])
def test_three_planted_differences(spark, buckets):
    changed = [(5, "other", 5) if k == 5 else (k, v, n) for k, v, n in ROWS if k != 9] + [(2000, "new", None)]
    want = [(2000, "new", None, "right", 1), (5, "other", 5, "right", 1), (5, "v5", 5, "left", 1), (9, "v9", 2, "left", 1)]
    assert differences(spark, ROWS, changed, buckets=buckets) == sorted(want, key=repr)


CASES = {
    "equal in another order": (ROWS, ROWS[::-1], []),
    "both empty": ([], [], []),
    "one empty": ([(1, "a", 1)], [], [(1, "a", 1, "left", 1)]),
    "repeated rows": ([(1, "a", 1)] * 3, [(1, "a", 1)], [(1, "a", 1, "left", 2)]),
    "a value moved to the next column's null": ([(1, None, 1)], [(1, "1", None)], [(1, "1", None, "right", 1), (1, None, 1, "left", 1)]),
    "null keys": ([(None, "a", 1), (None, None, None)], [(None, None, None)], [(None, "a", 1, "left", 1)]),
    "one key holds everything": ([(1, "a", i) for i in range(500)], [(1, "a", i) for i in range(1, 501)], [(1, "a", 0, "left", 1), (1, "a", 500, "right", 1)]),
}


@pytest.mark.parametrize("name", CASES)
def test_small_cases(spark, name):
    left, right, want = CASES[name]
    assert differences(spark, left, right) == want


def test_only_rows_of_unequal_buckets_are_shuffled(spark):
    """The buckets that differ are found from checksums; the rest of both copies stays where it lies."""
    left = spark.createDataFrame(ROWS, DDL)
    right = left.withColumn("n", F.when(F.col("k") == 7, 99).otherwise(F.col("n")))
    odd = cu.unequal_buckets(left, right, "k")
    assert [r["bucket"] for r in odd.collect()] == [left.where("k = 7").select(cu._bucket("k", cu.BUCKETS)).first()[0]]
    assert cu.checksums(left, "k").count() <= cu.BUCKETS


def test_planted_differences_between_curated_copy_and_warehouse(spark, ws):
    """Totals, flags and days name what the rows show; an untouched copy differs in nothing."""
    t = ws.tables
    local = cu.warehouse_copy(t["fact_transaction"], t["dim_currency"], t["dim_payment_format"])
    first, second, third = [r[0] for r in local.select("transaction_key").orderBy("transaction_key").limit(3).collect()]
    other = (
        local.where(F.col("transaction_key") != first)
        .withColumn("is_cross_bank", F.col("is_cross_bank") != (F.col("transaction_key") == second))
        .withColumn("amount_paid", F.when(F.col("transaction_key") == third, F.lit(0).cast("decimal(24,8)")).otherwise(F.col("amount_paid")))
    )
    rows = cu.differing_rows(local, other, "transaction_key", ("whole", "changed")).collect()
    assert sorted((r["transaction_key"], r["copy"]) for r in rows) == sorted(
        [(first, "whole"), (second, "changed"), (second, "whole"), (third, "changed"), (third, "whole")]
    )
    wrong = {r["measure"] for r in cu.totals_compared(local, other).where("not matches").collect()}
    assert "transaction_count" in wrong and "last_date_key" not in wrong
    assert cu.days_compared(local, other).where("not matches").count() == 1
    assert cu.differing_rows(local, local, "transaction_key", ("a", "b")).count() == 0
    assert cu.totals_compared(local, local).where("not matches").count() == 0


def test_curated_kpis_read_their_columns_and_months_only(ws):
    fact = ws.curated["fact_transaction"]
    plan = cu.flag_counts(fact.where("txn_month = 199601"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(txn_month" in plan
    schema = plan.split("ReadSchema: ")[1].splitlines()[0]
    assert set(schema[len("struct<") : -1].split(",")) == {f"is_{flag}:boolean" for flag in ("cross_bank", "self_transfer", "cross_currency")}

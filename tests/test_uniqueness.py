"""Distinct counts and unique keys without copying or shuffling every row."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import recon
from ledgerlake.operators.kpis import profile_summary


def errors(df):
    return recon.repeated_numbers(df, "k", "x").first()["error_count"]


def test_planted_repeats_are_found(spark):
    keys = spark.range(-70_000, 200_000).select(F.col("id").alias("k")).repartition(6)
    assert errors(keys) == 0
    planted = [0, 1, 32_768, 32_769, -70_000, 199_999, 199_999]
    assert errors(keys.union(spark.createDataFrame([(k,) for k in planted], "k long"))) == 6
    assert errors(keys.limit(0)) == 0
    # The same figure as a plain grouping.
    many = spark.range(5000).select((F.col("id") % 1700 * 37).alias("k"))
    assert errors(many) == recon.duplicate_groups(many, ["k"], "x").first()["error_count"] == 1700


def test_only_words_of_bits_leave_a_task(spark):
    keys = spark.range(0, 500_000, numPartitions=8).select(F.col("id").alias("k"))
    frame = recon.repeated_numbers(keys, "k", "x")
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    first = plan[plan.index("== Final Plan =="):plan.index("== Initial Plan ==")] if "== Final Plan ==" in plan else plan
    assert "hashpartitioning(_key" not in first  # no repeat: nothing is grouped by key


def test_profile_counts_without_expand(spark):
    accounts = spark.createDataFrame([("1", "a", "e"), ("1", "a", None), ("1", None, "e"), (None, "a", "f"), ("2", "a", "e")], "bank_id string, account_number string, entity_id string")
    transactions = spark.createDataFrame(
        [],
        "transaction_timestamp timestamp_ntz, is_laundering int, from_bank_id string, to_bank_id string, from_account_id string,"
        " to_account_id string, payment_currency string, receiving_currency string",
    )
    patterns = spark.createDataFrame([(1, "A"), (1, "B"), (2, None), (None, "A")], "pattern_attempt_id long, pattern_type string")
    frame = profile_summary(transactions, accounts, patterns)
    row = frame.first()
    assert (row.account_master_rows, row.account_business_keys, row.bank_master_count, row.entity_count) == (5, 4, 2, 2)
    assert (row.pattern_transaction_count, row.pattern_attempt_count, row.pattern_type_count) == (4, 2, 2)
    assert "Expand" not in frame._jdf.queryExecution().executedPlan().toString()

"""Rates, time series, ranks and matrices on small frames."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.measures import change_hash, divide, minutes_between, rate_percent
from ledgerlake.operators import datasets as ds
from ledgerlake.operators import recon, semantic, topk


@pytest.mark.parametrize(
    "part, whole, expected",
    [
        (35230, 31898238, 0.110445),
        (30746, 3868410, 0.794797),
        (2220, 12280058, 0.018078),
        (0, 7, 0.0),
        (7, 7, 100.0),
        (1, 3, 33.333333),
        (2, 3, 66.666667),
        (1, 200_000_000, 0.000001),  # exactly half a unit: rounds away from zero
        (0, 0, None),
        (3 * 10**12, 10**13, 30.0),
    ],
)
def test_rate_percent(spark, part, whole, expected):
    row = spark.createDataFrame([(part, whole)], "p long, w long").select(rate_percent("p", "w").alias("r")).first()
    assert row.r == expected


def test_divide_by_nothing_is_zero(spark):
    rows = spark.createDataFrame([(5, 0), (5, None), (None, 2), (6, 4)], "a long, b long")
    got = [r.q for r in rows.select(divide(F.col("a"), F.col("b")).alias("q")).collect()]
    assert got == [0.0, 0.0, 0.0, 1.5]


def test_minutes_between(spark):
    rows = spark.createDataFrame(
        [(datetime(2024, 1, 1, 0, 1, 23, 886208), datetime(2024, 1, 1, 1, 0, 36, 171992))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert rows.select(minutes_between("a", "b").alias("m")).first().m == 59.2


def test_change_hash_separates_parts(spark):
    rows = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a", None)], "x string, y string")
    hashes = [r.h for r in rows.select(change_hash(F.col("x"), F.col("y")).alias("h")).collect()]
    assert len(set(hashes)) == 3


@pytest.fixture(scope="module")
def daily(spark):
    rows = [
        (date(2024, 1, 1), "Euro", "ACH", 10, 1, Decimal("5.5")),
        (date(2024, 1, 1), "Yen", "Wire", 5, 0, Decimal("7")),
        (date(2024, 1, 2), "Euro", "ACH", 20, 2, Decimal("1")),
        (date(2024, 1, 4), "Euro", "Odd", 12, 0, Decimal("1")),
    ]
    ddl = (
        "full_date date, payment_currency string, payment_format string, transaction_count long, "
        "laundering_count long, total_amount_paid decimal(38,8)"
    )
    return spark.createDataFrame(rows, ddl)


def _by_day(df, column):
    return {r.full_date.day: r[column] for r in df.collect()}


def test_previous_day_is_the_calendar_day(daily):
    assert _by_day(semantic.daily_previous(daily), "previous_day_transactions") == {1: None, 2: 15, 4: None}


def test_growth_and_change_over_a_gap(daily):
    growth = _by_day(semantic.daily_growth(daily), "transaction_growth_ratio")
    assert growth == {1: 0.0, 2: pytest.approx(1 / 3), 4: 0.0}
    assert _by_day(semantic.daily_change(daily), "daily_transaction_change") == {1: 15, 2: 5, 4: 12}


def test_cumulative(daily):
    assert _by_day(semantic.daily_cumulative(daily), "cumulative_transactions") == {1: 15, 2: 35, 4: 47}


def test_selected_currency(daily):
    many = semantic.selected_currency(daily).first()
    assert many.selected_currency_amount_paid is None and many.selected_currency_amount_title.endswith(semantic.PICK_ONE)
    one = semantic.selected_currency(daily.where("payment_currency = 'Yen'")).first()
    assert one.selected_currency_amount_paid == 7 and one.selected_currency_amount_title == "Amount Paid - Yen"


def test_empty_filter_gives_zeros(daily):
    row = semantic.filtered(daily.where("false")).first()
    assert (row.transactions, row.aml_ratio, row.average_amount_per_transaction) == (0, 0.0, 0.0)


def test_matrix_keeps_values_outside_the_known_list(daily):
    rows = ds.spread(daily, ["full_date"], "payment_format", "transaction_count", ["ACH", "Wire"]).collect()
    assert {r.full_date.day: (r.ach, r.wire, r.all_other) for r in rows} == {1: (10, 5, 0), 2: (20, 0, 0), 4: (0, 0, 12)}


def test_top_and_other_keeps_the_total(spark):
    rows = spark.createDataFrame([(f"n{i}", i) for i in range(1, 10)], "name string, v long")
    got = {r.slice: r.slice_value for r in topk.top_and_other(rows, "name", "v", 3).collect()}
    assert got == {"n9": 9, "n8": 8, "n7": 7, "Other": 21}


def test_same_named_banks_pool_in_the_rank(spark):
    views = {
        "fact_bank_activity": spark.createDataFrame(
            [(1, 3, 2, 5, 1), (2, 1, 1, 2, 0), (3, 5, 1, 6, 2)],
            "bank_key long, sent_count long, received_count long, total_participations long, laundering_participations long",
        ),
        "dim_bank": spark.createDataFrame(
            [(1, "1", "Same"), (2, "2", "Same"), (3, "3", "Other")], "bank_key long, bank_id string, bank_name string"
        ),
    }
    rows = {r.bank_name: (r.total_participations, r.bank_activity_rank) for r in semantic.bank_rank(views).collect()}
    assert rows == {"Same": (7, 1), "Other": (6, 2)}


def test_compare_is_null_safe(spark):
    left = spark.createDataFrame([("a", 1), ("b", None), ("c", 3)], "k string, v long")
    right = spark.createDataFrame([("a", 1), ("b", None), ("d", 3)], "k string, v long")
    got = {r.k: r.matches for r in recon.compare_by_key(left, right, ["k"], ["v"]).collect()}
    assert got == {"a": True, "b": True, "c": False, "d": False}

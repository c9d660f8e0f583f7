"""Columns derived from typed transfers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.schemas import FX_RATE


def cross_bank() -> Column:
    return F.col("from_bank_id") != F.col("to_bank_id")


def cross_currency() -> Column:
    return F.col("payment_currency") != F.col("receiving_currency")


def self_transfer() -> Column:
    """Same bank and same account; an account number alone identifies nothing."""
    return (F.col("from_bank_id") == F.col("to_bank_id")) & (
        F.col("from_account_id") == F.col("to_account_id")
    )


def implied_rate() -> Column:
    """Received per paid unit, only across currencies. Not a market rate, not a fee."""
    applies = cross_currency() & (F.col("amount_paid") > 0)
    return F.when(applies, (F.col("amount_received") / F.col("amount_paid")).cast(FX_RATE))


def business_view(transactions: DataFrame) -> DataFrame:
    return transactions.withColumns(
        {
            "is_cross_bank": cross_bank(),
            "is_cross_currency": cross_currency(),
            "is_self_transfer": self_transfer(),
            "implied_exchange_rate": implied_rate(),
        }
    )


def date_key(column: str = "transaction_timestamp") -> Column:
    day = F.col(column)
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def with_calendar_keys(df: DataFrame) -> DataFrame:
    moment = F.col("transaction_timestamp")
    return df.withColumns({"date_key": date_key(), "time_key": F.hour(moment) * 100 + F.minute(moment)})


def enriched_transactions(transactions: DataFrame) -> DataFrame:
    return with_calendar_keys(business_view(transactions))


def curated_transactions(lenient: DataFrame, run_id: str) -> DataFrame:
    """Lakehouse variant over the lenient view, with its own validity rule.

    Valid means: key present, timestamp parsed, paid amount above zero, label 0 or 1.
    """
    valid = (
        F.col("source_row_id").isNotNull()
        & F.col("transaction_timestamp").isNotNull()
        & F.coalesce(F.col("amount_paid") > 0, F.lit(False))
        & F.coalesce(F.col("is_laundering").isin(0, 1), F.lit(False))
    )
    return lenient.select(
        F.col("source_row_id").alias("transaction_key"),
        "transaction_timestamp",
        F.to_date("transaction_timestamp").alias("txn_date"),
        "from_bank_id",
        "from_account_id",
        "to_bank_id",
        "to_account_id",
        "amount_received",
        "receiving_currency",
        "amount_paid",
        "payment_currency",
        "payment_format",
        "is_laundering",
        cross_bank().alias("is_cross_bank"),
        self_transfer().alias("is_self_transfer"),
        cross_currency().alias("is_cross_currency"),
        F.lit(run_id).alias("run_id"),
        valid.alias("is_valid"),
    )

"""The seven marts.

Each mart aggregates the fact on surrogate keys and joins names afterwards, when
only groups are left. Marts that share a grain can start from ``base_rollup``:
one pass over the fact feeds four of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.measures import rate_percent, total
from ledgerlake.schemas import UNKNOWN_KEY

COUNTS = ["transaction_count", "laundering_count", "cross_bank_count", "cross_currency_count", "self_transfer_count"]
AMOUNTS = ["total_amount_paid", "total_amount_received"]
ROLLUP_KEYS = ["date_key", "payment_currency_key", "receiving_currency_key", "payment_format_key"]


def as_measures(fact: DataFrame) -> DataFrame:
    """Fact rows as additive measures under the names a rollup uses."""
    return fact.withColumns(
        {
            "transaction_count": F.lit(1).cast("long"),
            "laundering_count": F.col("is_laundering").cast("long"),
            "cross_bank_count": F.col("is_cross_bank").cast("long"),
            "cross_currency_count": F.col("is_cross_currency").cast("long"),
            "self_transfer_count": F.col("is_self_transfer").cast("long"),
            "total_amount_paid": F.col("amount_paid"),
            "total_amount_received": F.col("amount_received"),
        }
    )


def base_rollup(fact: DataFrame) -> DataFrame:
    """Day x paid currency x received currency x format, the finest grain four marts share."""
    return (
        as_measures(fact)
        .groupBy(*ROLLUP_KEYS)
        .agg(*[F.sum(c).alias(c) for c in COUNTS], *[total(c).alias(c) for c in AMOUNTS])
    )


def _sums(*columns: str) -> list:
    return [total(c).alias(c) if c in AMOUNTS else F.sum(c).alias(c) for c in columns]


def kpi_overview(measures: DataFrame, dim_date: DataFrame) -> DataFrame:
    """One row. Per-day sums first, so the date join sees days, not transfers."""
    daily = measures.groupBy("date_key").agg(*_sums(*COUNTS))
    real = F.col("date_key") != UNKNOWN_KEY
    rows = daily.join(dim_date.select("date_key", "full_date"), "date_key").agg(
        *[F.coalesce(F.sum(c), F.lit(0).cast("long")).alias(c) for c in COUNTS],
        F.min(F.when(real, F.col("full_date"))).alias("min_transaction_date"),
        F.max(F.when(real, F.col("full_date"))).alias("max_transaction_date"),
    )
    return rows.select(
        F.lit(1).alias("overview_key"),
        "transaction_count",
        "laundering_count",
        rate_percent("laundering_count", "transaction_count").alias("laundering_rate_percent"),
        *COUNTS[2:],
        "min_transaction_date",
        "max_transaction_date",
    )


def daily_transaction(
    measures: DataFrame, dim_date: DataFrame, dim_currency: DataFrame, dim_payment_format: DataFrame
) -> DataFrame:
    grouped = measures.groupBy("date_key", "payment_currency_key", "payment_format_key").agg(
        *_sums("transaction_count", "laundering_count", "total_amount_paid")
    )
    currency = dim_currency.select(
        F.col("currency_key").alias("payment_currency_key"), F.col("currency_name").alias("payment_currency")
    )
    return (
        grouped.join(dim_date.select("date_key", "full_date"), "date_key")
        .join(currency, "payment_currency_key")
        .join(dim_payment_format, "payment_format_key")
        .select(
            "date_key",
            "full_date",
            "payment_currency_key",
            "payment_currency",
            "payment_format_key",
            "payment_format",
            "transaction_count",
            "laundering_count",
            rate_percent("laundering_count", "transaction_count").alias("laundering_rate_percent"),
            "total_amount_paid",
        )
    )


def aml_by_payment_format(measures: DataFrame, dim_payment_format: DataFrame) -> DataFrame:
    grouped = measures.groupBy("payment_format_key").agg(*_sums("transaction_count", "laundering_count"))
    return grouped.join(dim_payment_format, "payment_format_key").select(
        "payment_format_key",
        "payment_format",
        "transaction_count",
        "laundering_count",
        rate_percent("laundering_count", "transaction_count").alias("laundering_rate_percent"),
    )


def bank_roles(fact: DataFrame) -> DataFrame:
    """Sender and receiver roles of each bank, unpivoted from one scan of three columns; additive."""
    roles = F.array(
        F.struct(F.col("from_bank_key").alias("bank_key"), F.lit(1).cast("long").alias("sent")),
        F.struct(F.col("to_bank_key").alias("bank_key"), F.lit(0).cast("long").alias("sent")),
    )
    return (
        fact.select(F.col("is_laundering").cast("long").alias("laundering"), F.inline(roles))
        .groupBy("bank_key")
        .agg(
            F.sum("sent").alias("sent_count"),
            F.sum(1 - F.col("sent")).alias("received_count"),
            F.count("*").alias("total_participations"),
            F.sum("laundering").alias("laundering_participations"),
        )
    )


def named_banks(roles: DataFrame, dim_bank: DataFrame) -> DataFrame:
    return roles.join(dim_bank, "bank_key").select(
        "bank_key",
        "bank_id",
        "bank_name",
        "sent_count",
        "received_count",
        "total_participations",
        "laundering_participations",
    )


def bank_activity(fact: DataFrame, dim_bank: DataFrame) -> DataFrame:
    return named_banks(bank_roles(fact), dim_bank)


def currency_flow(measures: DataFrame, dim_currency: DataFrame) -> DataFrame:
    grouped = measures.groupBy("payment_currency_key", "receiving_currency_key").agg(
        *_sums("transaction_count", "laundering_count", *AMOUNTS)
    )
    paid = dim_currency.toDF("payment_currency_key", "payment_currency")
    received = dim_currency.toDF("receiving_currency_key", "receiving_currency")
    return (
        grouped.join(paid, "payment_currency_key")
        .join(received, "receiving_currency_key")
        .select(
            "payment_currency_key",
            "payment_currency",
            "receiving_currency_key",
            "receiving_currency",
            "transaction_count",
            "laundering_count",
            *AMOUNTS,
        )
    )


def pattern_attempts(fact_pattern: DataFrame) -> DataFrame:
    """One row for each attempt; rows add up, bounds combine."""
    return fact_pattern.groupBy("pattern_type_key", "pattern_attempt_id").agg(
        F.count("*").alias("rows"),
        F.min("pattern_sequence").alias("low"),
        F.max("pattern_sequence").alias("high"),
    )


def summed_attempts(attempts: DataFrame, dim_pattern_type: DataFrame) -> DataFrame:
    grouped = attempts.groupBy("pattern_type_key").agg(
        F.count("*").alias("attempt_count"),
        F.sum("rows").alias("pattern_transaction_count"),
        F.min("low").alias("min_sequence"),
        F.max("high").alias("max_sequence"),
    )
    return grouped.join(dim_pattern_type, "pattern_type_key").select(
        "pattern_type_key",
        "pattern_type",
        "attempt_count",
        "pattern_transaction_count",
        "min_sequence",
        "max_sequence",
    )


def pattern_summary(fact_pattern: DataFrame, dim_pattern_type: DataFrame) -> DataFrame:
    """Attempts collapse to one row each before the eight types are counted."""
    return summed_attempts(pattern_attempts(fact_pattern), dim_pattern_type)


def laundering_roles(fact: DataFrame) -> DataFrame:
    """Roles of each account in laundering rows; the filter reaches the Parquet scan; additive."""
    roles = F.array(
        F.struct(F.col("from_account_key").alias("account_key"), F.lit(1).cast("long").alias("sent")),
        F.struct(F.col("to_account_key").alias("account_key"), F.lit(0).cast("long").alias("sent")),
    )
    return (
        fact.where("is_laundering")
        .select(F.inline(roles))
        .groupBy("account_key")
        .agg(
            F.sum("sent").alias("laundering_sent_count"),
            F.sum(1 - F.col("sent")).alias("laundering_received_count"),
            F.count("*").alias("laundering_participations"),
        )
    )


def named_accounts(roles: DataFrame, dim_account: DataFrame) -> DataFrame:
    accounts = dim_account.select("account_key", "bank_id", "account_number", "entity_id")
    return roles.join(accounts, "account_key").select(
        "account_key",
        "bank_id",
        "account_number",
        "entity_id",
        "laundering_sent_count",
        "laundering_received_count",
        "laundering_participations",
    )


def aml_account_risk(fact: DataFrame, dim_account: DataFrame) -> DataFrame:
    return named_accounts(laundering_roles(fact), dim_account)


#: What a load adds to the marts: for each rollup its keys and how its columns combine over loads.
ROLLUPS = {
    "rollup_day": (ROLLUP_KEYS, {**dict.fromkeys(COUNTS, "sum"), **dict.fromkeys(AMOUNTS, "sum")}),
    "rollup_bank": (["bank_key"], dict.fromkeys(["sent_count", "received_count", "total_participations", "laundering_participations"], "sum")),
    "rollup_attempt": (["pattern_type_key", "pattern_attempt_id"], {"rows": "sum", "low": "min", "high": "max"}),
    "rollup_account": (["account_key"], dict.fromkeys(["laundering_sent_count", "laundering_received_count", "laundering_participations"], "sum")),
}


def load_rollups(fact: DataFrame, fact_pattern: DataFrame) -> dict[str, DataFrame]:
    """The rollups of the rows of one or several loads."""
    return {
        "rollup_day": base_rollup(fact),
        "rollup_bank": bank_roles(fact),
        "rollup_attempt": pattern_attempts(fact_pattern),
        "rollup_account": laundering_roles(fact),
    }


def combined(name: str, kept: DataFrame) -> DataFrame:
    """One row for each key over the rollups of several loads."""
    keys, columns = ROLLUPS[name]
    how = {"sum": lambda c: total(c) if c in AMOUNTS else F.sum(c), "min": F.min, "max": F.max}
    return kept.groupBy(*keys).agg(*[how[kind](c).cast(kept.schema[c].dataType).alias(c) for c, kind in columns.items()])


MART_NAMES = [
    "mart_kpi_overview",
    "mart_daily_transaction",
    "mart_aml_by_payment_format",
    "mart_bank_activity",
    "mart_currency_flow",
    "mart_pattern_summary",
    "mart_aml_account_risk",
]


def all_marts(tables: dict[str, DataFrame], rollups: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Every mart as a frame, from the combined rollups alone."""
    day = rollups["rollup_day"]
    return {
        "mart_kpi_overview": kpi_overview(day, tables["dim_date"]),
        "mart_daily_transaction": daily_transaction(
            day, tables["dim_date"], tables["dim_currency"], tables["dim_payment_format"]
        ),
        "mart_aml_by_payment_format": aml_by_payment_format(day, tables["dim_payment_format"]),
        "mart_bank_activity": named_banks(rollups["rollup_bank"], tables["dim_bank"]),
        "mart_currency_flow": currency_flow(day, tables["dim_currency"]),
        "mart_pattern_summary": summed_attempts(rollups["rollup_attempt"], tables["dim_pattern_type"]),
        "mart_aml_account_risk": named_accounts(rollups["rollup_account"], tables["dim_account"]),
    }

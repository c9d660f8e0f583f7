"""Top-k reports. Every order has a unique tie-break; the limit is the feature."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.measures import divide
from ledgerlake.operators import semantic

Views = dict[str, DataFrame]


def compact_banks(activity: DataFrame, size: int = 1000) -> DataFrame:
    return activity.orderBy(
        F.desc("total_participations"), F.desc("laundering_participations"), "bank_key"
    ).limit(size)


def compact_accounts(risk: DataFrame, size: int = 5000) -> DataFrame:
    return risk.orderBy(
        F.desc("laundering_participations"), F.desc("laundering_sent_count"), "account_key"
    ).limit(size)


def referenced_banks(dim_bank: DataFrame, banks: DataFrame, accounts: DataFrame) -> DataFrame:
    """Banks the kept facts refer to."""
    used = banks.select("bank_key").unionByName(accounts.select("bank_key"))
    return dim_bank.join(used, "bank_key", "left_semi")


def compact_snapshot(views: Views, bank_limit: int = 1000, account_limit: int = 5000) -> Views:
    """The sixteen views with the two largest facts cut to their top rows and banks to match."""
    banks = compact_banks(views["fact_bank_activity"], bank_limit)
    accounts = compact_accounts(views["fact_aml_account_risk"], account_limit)
    small = {
        **views,
        "fact_bank_activity": banks,
        "fact_aml_account_risk": accounts,
        "dim_bank": referenced_banks(views["dim_bank"], banks, accounts),
    }
    if len(small) != 16:
        raise RuntimeError(f"expected 16 views, found {len(small)}")
    return small


def top_risk_accounts(views: Views, size: int = 20) -> DataFrame:
    return (
        views["fact_aml_account_risk"]
        .join(views["dim_bank"].select("bank_key", "bank_name"), "bank_key")
        .select(
            "bank_name",
            "account_number",
            "entity_id",
            "laundering_sent_count",
            "laundering_received_count",
            "laundering_participations",
            "account_key",
        )
        .orderBy(F.desc("laundering_participations"), "account_key")
        .limit(size)
    )


def top_banks(views: Views, size: int) -> DataFrame:
    rows = semantic.by_bank_name(views)
    return (
        rows.select("bank_name", "total_participations")
        .orderBy(F.desc("total_participations"), "bank_name")
        .limit(size)
    )


def sent_received_mix(views: Views, size: int = 15) -> DataFrame:
    return (
        semantic.by_bank_name(views)
        .orderBy(F.desc("total_participations"), "bank_name")
        .limit(size)
        .select("bank_name", "sent_participations", "received_participations")
    )


def bank_ranking(views: Views, size: int = 50) -> DataFrame:
    return semantic.bank_rank(views).orderBy("bank_activity_rank", "bank_name").limit(size)


def top_corridors(views: Views, size: int = 15) -> DataFrame:
    return (
        semantic.corridors(views)
        .select("payment_currency", "receiving_currency", "transactions")
        .orderBy(F.desc("transactions"), "payment_currency", "receiving_currency")
        .limit(size)
    )


def last_seven_days(daily: DataFrame, size: int = 7) -> DataFrame:
    rows = semantic.daily_change(daily).select(
        "full_date",
        "transactions",
        "laundering_transactions",
        "daily_transaction_change",
        divide(F.col("laundering_transactions"), F.col("transactions")).alias("aml_ratio"),
    )
    return rows.orderBy(F.desc("full_date")).limit(size)


def top_and_other(rows: DataFrame, name: str, value: str, size: int = 5) -> DataFrame:
    """The largest ``size`` names and one row for all the others, so the total stays whole."""
    grouped = rows.groupBy(name).agg(F.sum(value).alias("value"))
    leaders = grouped.orderBy(F.desc("value"), name).limit(size).select(name, F.lit(True).alias("leads"))
    # At most ``size`` rows.
    marked = grouped.join(F.broadcast(leaders), name, "left")
    label = F.when(F.col("leads"), F.col(name)).otherwise("Other")
    return marked.groupBy(label.alias("slice")).agg(F.sum("value").alias("slice_value"))


def mart_leaders(marts: dict[str, DataFrame], size: int = 20) -> dict[str, DataFrame]:
    """The sample reports of the marts: limited where the mart is large, ordered otherwise."""
    return {
        "formats": marts["mart_aml_by_payment_format"].orderBy(F.desc("laundering_rate_percent"), "payment_format"),
        "banks": marts["mart_bank_activity"].orderBy(F.desc("total_participations"), "bank_key").limit(size),
        "corridors": marts["mart_currency_flow"]
        .orderBy(F.desc("transaction_count"), "payment_currency_key", "receiving_currency_key")
        .limit(size),
        "patterns": marts["mart_pattern_summary"].orderBy(F.desc("pattern_transaction_count"), "pattern_type"),
        "accounts": marts["mart_aml_account_risk"]
        .orderBy(F.desc("laundering_participations"), "account_key")
        .limit(size),
    }

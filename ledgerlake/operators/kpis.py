"""Source KPIs, distributions and profiles over typed or leniently typed transfers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.measures import divide, rate_percent, total
from ledgerlake.operators import enrich
from ledgerlake.operators.lookup import left_lookup
from ledgerlake.operators.recon import count_where

def _laundering() -> Column:
    return F.count_if(F.col("is_laundering")).alias("laundering_count")


def _rows() -> Column:
    return F.count("*").alias("transaction_count")


def label_split(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("is_laundering").agg(_rows())


def format_rate(transactions: DataFrame) -> DataFrame:
    grouped = transactions.groupBy("payment_format").agg(_rows(), _laundering())
    return grouped.withColumn("laundering_rate_percent", rate_percent("laundering_count", "transaction_count"))


def quality_flags(transactions: DataFrame) -> DataFrame:
    unequal = ~enrich.cross_currency() & (F.col("amount_paid") != F.col("amount_received"))
    return transactions.agg(
        count_where(F.col("amount_paid") <= 0).alias("non_positive_paid"),
        count_where(F.col("amount_received") <= 0).alias("non_positive_received"),
        count_where(enrich.self_transfer()).alias("self_transfer_count"),
        count_where(enrich.cross_currency()).alias("cross_currency_count"),
        count_where(unequal).alias("same_currency_amount_mismatch"),
    )


def bank_split(transactions: DataFrame) -> DataFrame:
    counted = transactions.agg(
        _rows(),
        count_where(enrich.cross_bank()).alias("cross_bank_count"),
        count_where(~enrich.cross_bank()).alias("same_bank_count"),
        _laundering(),
    )
    rate = rate_percent("laundering_count", "transaction_count").alias("laundering_rate_percent")
    return counted.select("cross_bank_count", "same_bank_count", "laundering_count", rate)


def pattern_types(patterns: DataFrame) -> DataFrame:
    return patterns.groupBy("pattern_type").agg(
        F.count_distinct("pattern_attempt_id").alias("attempt_count"),
        F.count("*").alias("pattern_transaction_count"),
    )


def daily_counts(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy(F.to_date("transaction_timestamp").alias("transaction_date")).agg(_rows(), _laundering())


def amount_by_currency(transactions: DataFrame) -> DataFrame:
    """Per payment currency; amounts of different currencies are never added."""
    grouped = transactions.groupBy("payment_currency").agg(_rows(), total("amount_paid").alias("total_amount_paid"))
    return grouped.withColumn(
        "average_amount_paid", divide(F.col("total_amount_paid"), F.col("transaction_count"))
    )


def window_bounds(transactions: DataFrame) -> DataFrame:
    return transactions.agg(
        _rows(),
        F.min("transaction_timestamp").alias("min_timestamp"),
        F.max("transaction_timestamp").alias("max_timestamp"),
    )


def aml_rate(transactions: DataFrame) -> DataFrame:
    """Unrounded percentage."""
    counted = transactions.agg(_rows(), _laundering())
    return counted.withColumn(
        "aml_rate_percent", divide(F.col("laundering_count") * 100, F.col("transaction_count"))
    )


def flag_counts(transactions: DataFrame) -> DataFrame:
    return transactions.agg(
        count_where(enrich.cross_bank()).alias("cross_bank_count"),
        count_where(enrich.self_transfer()).alias("self_transfer_count"),
        count_where(enrich.cross_currency()).alias("cross_currency_count"),
    )


def active_accounts(transactions: DataFrame) -> DataFrame:
    """Distinct (bank, account) over both roles from one scan."""
    roles = F.array(
        F.struct(F.col("from_bank_id").alias("bank_id"), F.col("from_account_id").alias("account_number")),
        F.struct(F.col("to_bank_id").alias("bank_id"), F.col("to_account_id").alias("account_number")),
    )
    return transactions.select(F.inline(roles)).distinct()


def active_account_coverage(transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    keys = ["bank_id", "account_number"]
    master = accounts.select(*keys, F.lit(True).alias("in_master"))
    joined = active_accounts(transactions).join(master, keys, "left")
    return joined.agg(
        F.count("*").alias("active_account_count"),
        F.count_distinct("bank_id").alias("active_bank_count"),
        F.count_if(F.col("in_master").isNull()).alias("missing_master_count"),
    )


def _bank_roles(transactions: DataFrame, keys: list[str], rows: Column, flagged: Column) -> DataFrame:
    """Rows and flagged rows for each (key, role, bank), combined on the map side.

    Two distinct counts side by side would expand every row; here a row gives one entry
    for each role, and only the distinct banks of a key travel.
    """
    roles = F.array(
        F.struct(F.lit("sender").alias("role"), F.col("from_bank_id").alias("bank_id"), rows.alias("n"), flagged.alias("flagged")),
        F.struct(F.lit("receiver").alias("role"), F.col("to_bank_id").alias("bank_id"), F.lit(0).alias("n"), F.lit(0).alias("flagged")),
    )
    entries = transactions.select(*keys, F.inline(roles))
    return entries.groupBy(*keys, "role", "bank_id").agg(F.sum("n").alias("n"), F.sum("flagged").alias("flagged"))


def _banks_of(role: str) -> Column:
    return F.count_if((F.col("role") == role) & F.col("bank_id").isNotNull()).alias(f"{role}_bank_count")


def active_bank_count(transactions: DataFrame) -> DataFrame:
    return _bank_roles(transactions, [], F.lit(1), F.lit(0)).agg(_banks_of("sender"), _banks_of("receiver"))


def top_sender_banks(transactions: DataFrame, bank_directory: DataFrame, size: int = 20) -> DataFrame:
    """Counts first, names afterwards; the bank id breaks ties."""
    sent = transactions.groupBy("from_bank_id").agg(F.count("*").alias("sent_transaction_count"))
    names = bank_directory.select(F.col("bank_id").alias("from_bank_id"), "bank_name")
    return (
        sent.join(names, "from_bank_id", "left")
        .select("from_bank_id", "bank_name", "sent_transaction_count")
        .orderBy(F.desc("sent_transaction_count"), "from_bank_id")
        .limit(size)
    )


# -- profiles over the lenient view (label is 0, 1 or NULL) ------------------------------


def _is_aml() -> Column:
    return count_where(F.col("is_laundering") == 1).alias("laundering_count")


def profile_summary(transactions: DataFrame, accounts: DataFrame, patterns: DataFrame) -> DataFrame:
    """Three one-row aggregates side by side."""
    moved = transactions.agg(
        _rows(),
        F.min("transaction_timestamp").alias("min_timestamp"),
        F.max("transaction_timestamp").alias("max_timestamp"),
        _is_aml(),
        count_where(enrich.cross_bank()).alias("cross_bank_count"),
        count_where(~enrich.cross_bank()).alias("same_bank_count"),
        count_where(enrich.cross_currency()).alias("cross_currency_count"),
        count_where(~enrich.cross_currency()).alias("same_currency_count"),
        count_where(enrich.self_transfer()).alias("self_transfer_count"),
    )
    # Distinct counts by grouping twice, not side by side: no row is copied for each of them.
    # A pair with a NULL part counts as a pair; a NULL bank, entity, attempt or type does not count.
    pairs = accounts.groupBy("bank_id", "account_number").agg(F.count("*").alias("n"))
    banks = pairs.groupBy("bank_id").agg(F.sum("n").alias("n"), F.count("*").alias("pairs"))
    master = banks.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("account_master_rows"),
        F.coalesce(F.sum("pairs"), F.lit(0)).alias("account_business_keys"),
        F.count("bank_id").alias("bank_master_count"),
    ).crossJoin(accounts.groupBy("entity_id").agg(F.lit(1)).agg(F.count("entity_id").alias("entity_count")))
    attempts = (
        patterns.groupBy("pattern_attempt_id")
        .agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("pattern_transaction_count"), F.count("pattern_attempt_id").alias("pattern_attempt_count"))
        .crossJoin(patterns.groupBy("pattern_type").agg(F.lit(1)).agg(F.count("pattern_type").alias("pattern_type_count")))
    )
    rate = rate_percent("laundering_count", "transaction_count")
    return moved.crossJoin(master).crossJoin(attempts).withColumn("laundering_rate_percent", rate)


def _blank(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def profile_quality(transactions: DataFrame) -> DataFrame:
    """Fourteen counters from one scan."""
    same_currency = F.col("payment_currency") == F.col("receiving_currency")
    label = F.col("is_laundering")
    counters = {
        "invalid_timestamp_count": F.col("transaction_timestamp").isNull(),
        "missing_from_bank_count": _blank("from_bank_id"),
        "missing_from_account_count": _blank("from_account_id"),
        "missing_to_bank_count": _blank("to_bank_id"),
        "missing_to_account_count": _blank("to_account_id"),
        "invalid_amount_paid_count": F.col("amount_paid").isNull(),
        "invalid_amount_received_count": F.col("amount_received").isNull(),
        "nonpositive_amount_paid_count": F.col("amount_paid") <= 0,
        "nonpositive_amount_received_count": F.col("amount_received") <= 0,
        "missing_payment_currency_count": _blank("payment_currency"),
        "missing_receiving_currency_count": _blank("receiving_currency"),
        "missing_payment_format_count": _blank("payment_format"),
        "invalid_laundering_label_count": label.isNull() | ~label.isin(0, 1),
        "same_currency_amount_mismatch_count": same_currency & (F.col("amount_paid") != F.col("amount_received")),
    }
    return transactions.agg(*[count_where(test).alias(name) for name, test in counters.items()])


def profile_currency_pairs(transactions: DataFrame) -> DataFrame:
    return transactions.groupBy("payment_currency", "receiving_currency").agg(
        _rows(),
        _is_aml(),
        total("amount_paid").alias("total_amount_paid"),
        total("amount_received").alias("total_amount_received"),
    )


def profile_payment_formats(transactions: DataFrame) -> DataFrame:
    grouped = transactions.groupBy("payment_format").agg(_rows(), _is_aml())
    return grouped.withColumn("laundering_rate_percent", rate_percent("laundering_count", "transaction_count"))


def profile_daily(transactions: DataFrame) -> DataFrame:
    flagged = F.coalesce((F.col("is_laundering") == 1).cast("int"), F.lit(0))
    dated = transactions.withColumn("transaction_date", F.to_date("transaction_timestamp"))
    return (
        _bank_roles(dated, ["transaction_date"], F.lit(1), flagged)
        .groupBy("transaction_date")
        .agg(
            F.sum("n").alias("transaction_count"),
            F.sum("flagged").alias("laundering_count"),
            _banks_of("sender"),
            _banks_of("receiver"),
        )
    )


def profile_patterns(patterns: DataFrame) -> DataFrame:
    return patterns.groupBy("pattern_type").agg(
        F.count_distinct("pattern_attempt_id").alias("attempt_count"),
        F.count("*").alias("transaction_count"),
        F.min("pattern_sequence").alias("min_sequence"),
        F.max("pattern_sequence").alias("max_sequence"),
    )


def profile_top_banks(transactions: DataFrame, accounts: DataFrame, size: int = 20) -> DataFrame:
    roles = F.array(
        F.struct(F.col("from_bank_id").alias("bank_id"), F.lit(1).cast("long").alias("sent")),
        F.struct(F.col("to_bank_id").alias("bank_id"), F.lit(0).cast("long").alias("sent")),
    )
    activity = (
        transactions.select(F.inline(roles))
        .groupBy("bank_id")
        .agg(
            F.sum("sent").alias("sent_count"),
            F.sum(1 - F.col("sent")).alias("received_count"),
            F.count("*").alias("total_participations"),
        )
    )
    names = accounts.groupBy("bank_id").agg(F.max("bank_name").alias("bank_name"))
    return (
        activity.join(names, "bank_id", "left")
        .select("bank_id", "bank_name", "sent_count", "received_count", "total_participations")
        .orderBy(F.desc("total_participations"), F.asc_nulls_last("bank_id"))
        .limit(size)
    )


def with_account_master(transactions: DataFrame, accounts: DataFrame, hot: DataFrame) -> DataFrame:
    """Optional enrichment with the sender's master row. Accounts are unique, so rows cannot multiply."""
    master = accounts.select(
        "bank_id",
        "account_number",
        F.col("bank_name").alias("from_bank_name"),
        F.col("entity_id").alias("from_entity_id"),
    )
    on = {"from_bank_id": "bank_id", "from_account_id": "account_number"}
    return left_lookup(transactions, master, on, "source_transaction_id", hot)


def rows_around_join(before: DataFrame, after: DataFrame) -> DataFrame:
    """The row-count check of an enrichment: it may neither lose nor multiply rows."""
    counts = before.agg(F.count("*").alias("rows_before")).crossJoin(after.agg(F.count("*").alias("rows_after")))
    return counts.withColumn("status", F.when(F.col("rows_before") == F.col("rows_after"), "PASSED").otherwise("FAILED"))

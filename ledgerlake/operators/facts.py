"""Fact rows: role-playing dimension lookups over typed transfers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators.dims import conform
from ledgerlake.operators.enrich import enriched_transactions, with_calendar_keys
from ledgerlake.operators.lookup import hot_keys, key_counts, left_lookup
from ledgerlake.schemas import DW_REJECT, FACT_PATTERN, FACT_TRANSACTION, UNKNOWN_KEY

ACCOUNT_KEYS = ["bank_id", "account_number"]
TRANSACTION_LOOKUP_KEYS = [
    "date_key",
    "time_key",
    "from_bank_key",
    "to_bank_key",
    "from_account_key",
    "to_account_key",
    "payment_currency_key",
    "receiving_currency_key",
    "payment_format_key",
]
ENTITY_KEYS = ["from_entity_key", "to_entity_key"]


NON_POSITIVE = "NON_POSITIVE_AMOUNT"


def any_unknown(keys: list[str]) -> Column:
    test = F.col(keys[0]) == UNKNOWN_KEY
    for key in keys[1:]:
        test = test | (F.col(key) == UNKNOWN_KEY)
    return test


Hot = dict[str, DataFrame]


def hot_parties(transactions: DataFrame) -> Hot:
    """Hot accounts and hot banks among all sender and receiver roles, from one rollup of one scan."""
    both = F.array(
        F.struct(F.col("from_bank_id").alias("bank_id"), F.col("from_account_id").alias("account_number")),
        F.struct(F.col("to_bank_id").alias("bank_id"), F.col("to_account_id").alias("account_number")),
    )
    counts = key_counts(transactions.select(F.inline(both)), ACCOUNT_KEYS)
    by_bank = counts.groupBy("bank_id").agg(F.sum("_rows").alias("_rows"))
    return {"account": hot_keys(counts, ACCOUNT_KEYS), "bank": hot_keys(by_bank, ["bank_id"])}


def with_account_keys(
    facts: DataFrame, accounts: DataFrame, role: str, spread_by: str, hot: DataFrame
) -> DataFrame:
    """Keys of the current account version for one role."""
    side = accounts.select(
        *ACCOUNT_KEYS,
        F.col("account_key").alias(f"{role}_account_key"),
        F.col("entity_key").alias(f"{role}_entity_key"),
    )
    on = {f"{role}_bank_id": "bank_id", f"{role}_account_id": "account_number"}
    return left_lookup(facts, side, on, spread_by, hot)


def _lookup(facts: DataFrame, dim: DataFrame, dim_column: str, fact_column: str, key: str, out: str) -> DataFrame:
    """Left lookup by one column. The planner broadcasts a dimension whose written size allows it."""
    side = dim.select(F.col(dim_column).alias("_match"), F.col(key).alias(out))
    return facts.join(side, F.col(fact_column) == F.col("_match"), "left").drop("_match")


def _with_dimension_keys(
    facts: DataFrame, dims: dict[str, DataFrame], spread_by: str, hot: Hot
) -> DataFrame:
    dates = dims["dim_date"].select(F.col("date_key").alias("_date"))
    # 1,441 rows by construction.
    times = F.broadcast(dims["dim_time"].select(F.col("time_key").alias("_time")))
    current = dims["dim_account"].where("is_current")
    rows = facts.join(dates, F.col("date_key") == F.col("_date"), "left")
    rows = rows.join(times, F.col("time_key") == F.col("_time"), "left")
    rows = rows.withColumns({"date_key": F.col("_date"), "time_key": F.col("_time")}).drop("_date", "_time")
    for role in ("from", "to"):
        banks = dims["dim_bank"].select("bank_id", F.col("bank_key").alias(f"{role}_bank_key"))
        rows = left_lookup(rows, banks, {f"{role}_bank_id": "bank_id"}, spread_by, hot["bank"])
    for role in ("payment", "receiving"):
        name, out = f"{role}_currency", f"{role}_currency_key"
        rows = _lookup(rows, dims["dim_currency"], "currency_name", name, "currency_key", out)
    rows = _lookup(
        rows, dims["dim_payment_format"], "payment_format", "payment_format", "payment_format_key", "payment_format_key"
    )
    for role in ("from", "to"):
        rows = with_account_keys(rows, current, role, spread_by, hot["account"])
    keys = [*TRANSACTION_LOOKUP_KEYS, *ENTITY_KEYS]
    return rows.withColumns({key: F.coalesce(key, F.lit(UNKNOWN_KEY)) for key in keys})


def positive_amounts() -> Column:
    return (F.col("amount_paid") > 0) & (F.col("amount_received") > 0)


def fact_transactions(
    transactions: DataFrame, dims: dict[str, DataFrame], dw_batch_id: int, hot: Hot
) -> DataFrame:
    """One fact row per transfer with positive amounts; failed lookups get the unknown key."""
    # The transfer's month, taken before the lookup can turn its date into the unknown key.
    rows = enriched_transactions(transactions.where(positive_amounts())).withColumn(
        "txn_month", F.floor(F.col("date_key") / 100)
    )
    keyed = _with_dimension_keys(rows, dims, "source_transaction_id", hot).withColumns(
        {
            "transaction_key": F.col("source_transaction_id"),
            "source_load_batch_id": F.col("load_batch_id"),
            "dw_batch_id": F.lit(dw_batch_id),
        }
    )
    return conform(keyed, FACT_TRANSACTION)


def fact_patterns(
    patterns: DataFrame, dims: dict[str, DataFrame], dw_batch_id: int, hot: Hot
) -> DataFrame:
    rows = _with_dimension_keys(with_calendar_keys(patterns), dims, "pattern_transaction_id", hot)
    rows = _lookup(
        rows, dims["dim_pattern_type"], "pattern_type", "pattern_type", "pattern_type_key", "pattern_type_key"
    )
    keyed = rows.withColumns(
        {
            "pattern_type_key": F.coalesce("pattern_type_key", F.lit(UNKNOWN_KEY)),
            "pattern_transaction_key": F.col("pattern_transaction_id"),
            "source_pattern_transaction_id": F.col("pattern_transaction_id"),
            "source_load_batch_id": F.col("load_batch_id"),
            "dw_batch_id": F.lit(dw_batch_id),
        }
    )
    return conform(keyed, FACT_PATTERN)


def unknown_transaction_rejects(facts: DataFrame) -> DataFrame:
    """Fact rows with a failed lookup; they stay in the fact as well."""
    return conform(
        facts.where(any_unknown(TRANSACTION_LOOKUP_KEYS)).select(
            "dw_batch_id",
            F.lit("transactions").alias("source_object"),
            F.col("source_transaction_id").alias("source_key"),
            F.lit("UNKNOWN_DIMENSION_KEY").alias("error_code"),
            F.lit("at least one dimension lookup found no member").alias("error_description"),
            F.to_json(F.struct(*TRANSACTION_LOOKUP_KEYS)).alias("raw_payload"),
        ),
        DW_REJECT,
    )


def unknown_pattern_rejects(facts: DataFrame) -> DataFrame:
    return conform(
        facts.where(any_unknown(["pattern_type_key", *TRANSACTION_LOOKUP_KEYS])).select(
            "dw_batch_id",
            F.lit("pattern_transactions").alias("source_object"),
            F.col("source_pattern_transaction_id").alias("source_key"),
            F.lit("UNKNOWN_DIMENSION_KEY").alias("error_code"),
            F.lit("at least one dimension lookup of a pattern row found no member").alias("error_description"),
            F.to_json(F.struct("pattern_attempt_id", "pattern_sequence")).alias("raw_payload"),
        ),
        DW_REJECT,
    )


def amount_rejects(transactions: DataFrame, dw_batch_id: int) -> DataFrame:
    """Transfers kept in the source but not admitted to the fact."""
    return conform(
        transactions.where(~positive_amounts()).select(
            F.lit(dw_batch_id).alias("dw_batch_id"),
            F.lit("transactions").alias("source_object"),
            F.col("source_transaction_id").alias("source_key"),
            F.lit(NON_POSITIVE).alias("error_code"),
            F.lit("paid and received amounts must be above zero").alias("error_description"),
            F.to_json(F.struct("amount_paid", "amount_received")).alias("raw_payload"),
        ),
        DW_REJECT,
    )

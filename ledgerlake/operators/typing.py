"""Landing text to typed source rows and rejects.

Each ``tag_*`` function parses a landing frame once and marks every row valid or
not; typed rows and rejects are the two halves of that one frame, so no row can
be lost between them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions import text
from ledgerlake.schemas import (
    ACCOUNT_COLUMNS,
    ACCOUNT_FIELDS,
    PATTERN_COLUMNS,
    PATTERN_FIELDS,
    REJECT_COLUMNS,
    TRANSACTION_COLUMNS,
    TRANSACTION_FIELDS,
)

# Source object names and error codes.
ACCOUNT = "Account"
TRANSACTION = "Transaction"
PATTERN = "PatternTransaction"
ERRORS = {
    "INVALID_ACCOUNT": "bank id or account number is not usable",
    "DUPLICATE_ACCOUNT": "bank id and account number already appeared in an earlier row",
    "INVALID_TRANSACTION": "timestamp, bank, account, amount, currency, format or label is not usable",
    "INVALID_PATTERN_TRANSACTION": "attempt, sequence or a transfer field is not usable",
}


def _transfer_columns() -> dict[str, Column]:
    return {
        "transaction_timestamp": text.minute_timestamp("timestamp_text"),
        "raw_from_bank_id": text.filled("from_bank_text"),
        "from_bank_id": text.bank_id("from_bank_text"),
        "from_account_id": F.upper(text.filled("from_account_text")),
        "raw_to_bank_id": text.filled("to_bank_text"),
        "to_bank_id": text.bank_id("to_bank_text"),
        "to_account_id": F.upper(text.filled("to_account_text")),
        "amount_received": text.money("amount_received_text"),
        "receiving_currency": text.filled("receiving_currency_text"),
        "amount_paid": text.money("amount_paid_text"),
        "payment_currency": text.filled("payment_currency_text"),
        "payment_format": text.filled("payment_format_text"),
        "is_laundering": text.label("is_laundering_text"),
    }


def _tag(df: DataFrame, columns: dict[str, Column], fields: list[str], code: str, batch_id: int) -> DataFrame:
    required = text.all_present(list(columns))
    return (
        df.select("*", *[expr.alias(name) for name, expr in columns.items()])
        .withColumn("error_code", F.when(~required, F.lit(code)))
        .withColumn("raw_payload", F.when(~required, text.payload(fields)))
        .withColumn("load_batch_id", F.lit(batch_id).cast("long"))
        .drop(*fields)
    )


def tag_transactions(landing: DataFrame, batch_id: int = 1) -> DataFrame:
    tagged = _tag(landing, _transfer_columns(), TRANSACTION_FIELDS, "INVALID_TRANSACTION", batch_id)
    return tagged.withColumn("source_row_id", F.col("landing_row_id")).withColumnRenamed(
        "landing_row_id", "source_transaction_id"
    )


def tag_patterns(landing: DataFrame, batch_id: int = 1) -> DataFrame:
    columns = {
        "pattern_attempt_id": text.whole_number("pattern_attempt_id_text", "bigint"),
        "pattern_type": text.filled("pattern_type_text"),
        "pattern_description": text.filled("pattern_description_text"),
        "pattern_sequence": text.whole_number("pattern_sequence_text", "int"),
        **_transfer_columns(),
    }
    tagged = _tag(landing, columns, PATTERN_FIELDS, "INVALID_PATTERN_TRANSACTION", batch_id)
    return tagged.withColumn("source_row_id", F.col("landing_row_id")).withColumnRenamed(
        "landing_row_id", "pattern_transaction_id"
    )


def tag_accounts(landing: DataFrame, batch_id: int = 1) -> DataFrame:
    """Adds ``DUPLICATE_ACCOUNT``: of several rows for one account the lowest landing id stays."""
    columns = {
        "bank_name": F.trim("bank_name_text"),
        "bank_id": text.bank_id("bank_id_text"),
        "account_number": F.upper(text.filled("account_number_text")),
    }
    kept = landing.withColumns(
        {
            "raw_bank_id": F.trim("bank_id_text"),
            "entity_id": F.upper(text.filled("entity_id_text")),
            "entity_name": text.filled("entity_name_text"),
            "whole_row": text.payload(ACCOUNT_FIELDS),
        }
    )
    tagged = _tag(kept, columns, ACCOUNT_FIELDS, "INVALID_ACCOUNT", batch_id)
    # One narrow row per account: the map side keeps only the smallest id of a key.
    first = (
        tagged.where("error_code is null")
        .groupBy("bank_id", "account_number")
        .agg(F.min("landing_row_id").alias("landing_row_id"))
        .select("landing_row_id", F.lit(True).alias("is_first"))
    )
    duplicate = F.col("error_code").isNull() & F.col("is_first").isNull()
    return (
        tagged.join(first, "landing_row_id", "left")
        .withColumn("raw_payload", F.when(duplicate, F.col("whole_row")).otherwise(F.col("raw_payload")))
        .withColumn("error_code", F.when(duplicate, F.lit("DUPLICATE_ACCOUNT")).otherwise(F.col("error_code")))
        .withColumnRenamed("landing_row_id", "source_row_id")
        .drop("is_first", "whole_row")
    )


def _valid_rows(tagged: DataFrame, columns: list[str]) -> DataFrame:
    """Typed columns of the valid rows.

    A plain filter would be pushed below the projection and parse every field a
    second time; a generator that yields no row for a reject parses once.
    """
    row = F.array(F.struct(*columns))
    return tagged.select(F.inline(F.when(F.col("error_code").isNull(), row)))


def typed_accounts(tagged: DataFrame) -> DataFrame:
    return _valid_rows(tagged, ACCOUNT_COLUMNS)


def typed_transactions(tagged: DataFrame) -> DataFrame:
    return _valid_rows(tagged, TRANSACTION_COLUMNS)


def typed_patterns(tagged: DataFrame) -> DataFrame:
    return _valid_rows(tagged, PATTERN_COLUMNS)


def rejects(tagged: DataFrame, source_object: str) -> DataFrame:
    described = F.create_map(*[F.lit(x) for pair in ERRORS.items() for x in pair])
    return tagged.where("error_code is not null").select(
        F.col("load_batch_id").alias("batch_id"),
        F.lit(source_object).alias("source_object"),
        "source_row_id",
        "error_code",
        described[F.col("error_code")].alias("error_description"),
        "raw_payload",
    ).select(REJECT_COLUMNS)


def lenient_transactions(landing: DataFrame) -> DataFrame:
    """Profiling view: every row stays, a field that does not parse becomes NULL."""
    return landing.select(
        F.col("landing_row_id").alias("source_row_id"),
        F.trim("timestamp_text").alias("raw_timestamp"),
        text.minute_timestamp("timestamp_text").alias("transaction_timestamp"),
        F.trim("from_bank_text").alias("raw_from_bank_id"),
        text.bank_id("from_bank_text").alias("from_bank_id"),
        F.upper(F.trim("from_account_text")).alias("from_account_id"),
        F.trim("to_bank_text").alias("raw_to_bank_id"),
        text.bank_id("to_bank_text").alias("to_bank_id"),
        F.upper(F.trim("to_account_text")).alias("to_account_id"),
        text.money("amount_received_text").alias("amount_received"),
        F.trim("receiving_currency_text").alias("receiving_currency"),
        text.money("amount_paid_text").alias("amount_paid"),
        F.trim("payment_currency_text").alias("payment_currency"),
        F.trim("payment_format_text").alias("payment_format"),
        text.whole_number("is_laundering_text", "int").alias("is_laundering"),
    )


def lenient_accounts(landing: DataFrame) -> DataFrame:
    return landing.select(
        F.col("landing_row_id").alias("source_row_id"),
        F.trim("bank_name_text").alias("bank_name"),
        F.trim("bank_id_text").alias("raw_bank_id"),
        text.bank_id("bank_id_text").alias("bank_id"),
        F.upper(F.trim("account_number_text")).alias("account_number"),
        F.upper(F.trim("entity_id_text")).alias("entity_id"),
        F.trim("entity_name_text").alias("entity_name"),
    )


def lenient_patterns(landing: DataFrame) -> DataFrame:
    return landing.select(
        text.whole_number("pattern_attempt_id_text", "bigint").alias("pattern_attempt_id"),
        F.trim("pattern_type_text").alias("pattern_type"),
        text.whole_number("pattern_sequence_text", "int").alias("pattern_sequence"),
    )

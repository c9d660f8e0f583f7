"""Column lists, explicit schemas and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(24, 8)
MONEY_TOTAL = T.DecimalType(38, 8)
FX_RATE = T.DecimalType(38, 12)

# Landing column names.
ACCOUNT_FIELDS = [
    "bank_name_text",
    "bank_id_text",
    "account_number_text",
    "entity_id_text",
    "entity_name_text",
]
TRANSACTION_FIELDS = [
    "timestamp_text",
    "from_bank_text",
    "from_account_text",
    "to_bank_text",
    "to_account_text",
    "amount_received_text",
    "receiving_currency_text",
    "amount_paid_text",
    "payment_currency_text",
    "payment_format_text",
    "is_laundering_text",
]
PATTERN_FIELDS = [
    "pattern_attempt_id_text",
    "pattern_type_text",
    "pattern_description_text",
    "pattern_sequence_text",
    *TRANSACTION_FIELDS,
]

# Domains seen in the data.
PAYMENT_FORMATS = ["ACH", "Bitcoin", "Cash", "Cheque", "Credit Card", "Reinvestment", "Wire"]
PATTERN_TYPES = [
    "BIPARTITE",
    "CYCLE",
    "FAN-IN",
    "FAN-OUT",
    "GATHER-SCATTER",
    "RANDOM",
    "SCATTER-GATHER",
    "STACK",
]

UNKNOWN_KEY = -1
OPEN_END = "9999-12-31 23:59:59"


def text_schema(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in fields])


REJECT_COLUMNS = [
    "batch_id",
    "source_object",
    "source_row_id",
    "error_code",
    "error_description",
    "raw_payload",
]
ACCOUNT_COLUMNS = [
    "source_row_id",
    "bank_name",
    "raw_bank_id",
    "bank_id",
    "account_number",
    "entity_id",
    "entity_name",
    "load_batch_id",
]
TRANSACTION_COLUMNS = [
    "source_transaction_id",
    "source_row_id",
    "transaction_timestamp",
    "raw_from_bank_id",
    "from_bank_id",
    "from_account_id",
    "raw_to_bank_id",
    "to_bank_id",
    "to_account_id",
    "amount_received",
    "receiving_currency",
    "amount_paid",
    "payment_currency",
    "payment_format",
    "is_laundering",
    "load_batch_id",
]
PATTERN_COLUMNS = [
    "pattern_transaction_id",
    "pattern_attempt_id",
    "pattern_type",
    "pattern_description",
    "pattern_sequence",
    "transaction_timestamp",
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
    "load_batch_id",
]

LOAD_BATCH = (
    "batch_id long, dataset_name string, source_version string, started_at timestamp_ntz, "
    "completed_at timestamp_ntz, status string, account_landing_rows long, "
    "transaction_landing_rows long, pattern_landing_rows long, account_loaded_rows long, "
    "transaction_loaded_rows long, pattern_loaded_rows long, rejected_rows long, error_message string"
)
DW_BATCH = (
    "dw_batch_id long, process_name string, load_type string, status string, "
    "started_at timestamp_ntz, completed_at timestamp_ntz, source_load_batch_id long, "
    "source_low_watermark long, source_high_watermark long, "
    "pattern_low_watermark long, pattern_high_watermark long, "
    "bank_rows_affected long, entity_rows_affected long, account_rows_affected long, "
    "currency_rows_affected long, payment_format_rows_affected long, "
    "transaction_rows_inserted long, pattern_rows_inserted long, rejected_rows long, "
    "validation_status string, error_message string, table_versions string"
)
VALIDATION = (
    "validation_result_id long, dw_batch_id long, check_name string, source_value decimal(38,8), "
    "target_value decimal(38,8), status string, details string, checked_at timestamp_ntz"
)
TEST_RUN = (
    "test_run_id long, run_label string, started_at timestamp_ntz, completed_at timestamp_ntz, "
    "test_count int, passed_count int, failed_count int, status string"
)
TEST_RESULT = (
    "test_run_id long, category string, test_code string, test_name string, "
    "expected_value string, actual_value string, status string"
)

DIM_SCHEMAS = {
    "dim_date": "date_key int, full_date date, day_of_month int, day_of_week int, day_name string, "
    "week_of_year int, month_number int, month_name string, quarter_number int, year_number int, "
    "is_weekend boolean",
    "dim_time": "time_key int, time_value string, hour_number int, minute_number int, day_part string",
    "dim_currency": "currency_key int, currency_name string",
    "dim_payment_format": "payment_format_key int, payment_format string",
    "dim_pattern_type": "pattern_type_key int, pattern_type string",
    "dim_bank": "bank_key long, bank_id string, bank_name string, source_hash string",
    "dim_entity": "entity_key long, entity_id string, entity_name string, source_hash string",
    "dim_account": "account_key long, bank_key long, entity_key long, bank_id string, "
    "account_number string, entity_id string, source_hash string, effective_from timestamp_ntz, "
    "effective_to timestamp_ntz, is_current boolean",
}
FACT_TRANSACTION = (
    "transaction_key long, source_transaction_id long, date_key int, time_key int, "
    "from_bank_key long, to_bank_key long, from_account_key long, to_account_key long, "
    "from_entity_key long, to_entity_key long, payment_currency_key int, "
    "receiving_currency_key int, payment_format_key int, amount_paid decimal(24,8), "
    "amount_received decimal(24,8), is_laundering boolean, is_cross_bank boolean, "
    "is_cross_currency boolean, is_self_transfer boolean, implied_exchange_rate decimal(38,12), "
    "source_load_batch_id long, dw_batch_id long, txn_month int"
)
FACT_PATTERN = (
    "pattern_transaction_key long, source_pattern_transaction_id long, pattern_attempt_id long, "
    "pattern_type_key int, pattern_sequence int, pattern_description string, date_key int, "
    "time_key int, from_bank_key long, to_bank_key long, from_account_key long, "
    "to_account_key long, payment_currency_key int, receiving_currency_key int, "
    "payment_format_key int, amount_paid decimal(24,8), amount_received decimal(24,8), "
    "is_laundering boolean, source_load_batch_id long, dw_batch_id long"
)
DW_REJECT = (
    "dw_batch_id long, source_object string, source_key long, error_code string, "
    "error_description string, raw_payload string"
)

_TRANSFER = (
    "transaction_timestamp timestamp_ntz, raw_from_bank_id string, from_bank_id string, "
    "from_account_id string, raw_to_bank_id string, to_bank_id string, to_account_id string, "
    "amount_received decimal(24,8), receiving_currency string, amount_paid decimal(24,8), "
    "payment_currency string, payment_format string, is_laundering boolean, "
)
_TAG = "error_code string, raw_payload string, load_batch_id long, source_row_id long, is_valid boolean"
TAGGED = {
    "account": "raw_bank_id string, entity_id string, entity_name string, bank_name string, "
    f"bank_id string, account_number string, {_TAG}",
    "transaction": f"source_transaction_id long, {_TRANSFER}{_TAG}",
    "pattern": "pattern_transaction_id long, pattern_attempt_id long, pattern_type string, "
    f"pattern_description string, pattern_sequence int, {_TRANSFER}{_TAG}",
}

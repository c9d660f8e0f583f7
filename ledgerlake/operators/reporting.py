"""The sixteen reporting views over marts, dimensions and load logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.measures import minutes_between
from ledgerlake.schemas import UNKNOWN_KEY

VIEW_NAMES = [
    "dim_date",
    "dim_payment_currency",
    "dim_receiving_currency",
    "dim_payment_format",
    "dim_bank",
    "dim_pattern_type",
    "kpi_overview",
    "fact_daily_transaction",
    "fact_aml_payment_format",
    "fact_bank_activity",
    "fact_currency_flow",
    "fact_pattern_summary",
    "fact_aml_account_risk",
    "etl_batch_monitor",
    "etl_validation_result",
    "data_quality_overview",
]


def _known(dim: DataFrame, key: str) -> DataFrame:
    return dim.where(F.col(key) != UNKNOWN_KEY)


def report_dates(dim_date: DataFrame) -> DataFrame:
    return _known(dim_date, "date_key").select(
        "date_key",
        "full_date",
        "year_number",
        "quarter_number",
        F.concat(F.lit("Q"), F.col("quarter_number").cast("string")).alias("quarter_label"),
        "month_number",
        "month_name",
        F.date_format("full_date", "yyyy-MM").alias("year_month"),
        (F.col("year_number") * 100 + F.col("month_number")).alias("year_month_sort"),
        "week_of_year",
        "day_of_month",
        "day_of_week",
        "day_name",
        "is_weekend",
    )


def report_currencies(dim_currency: DataFrame, role: str) -> DataFrame:
    return _known(dim_currency, "currency_key").select(
        F.col("currency_key").alias(f"{role}_currency_key"), F.col("currency_name").alias(f"{role}_currency")
    )


def report_account_risk(risk: DataFrame, dim_bank: DataFrame) -> DataFrame:
    banks = _known(dim_bank, "bank_key").select("bank_id", "bank_key")
    return risk.join(banks, "bank_id").select(
        "account_key",
        "bank_key",
        "account_number",
        "entity_id",
        "laundering_sent_count",
        "laundering_received_count",
        "laundering_participations",
    )


def batch_monitor(batches: DataFrame) -> DataFrame:
    return batches.select(
        "dw_batch_id",
        "process_name",
        "load_type",
        "status",
        "started_at",
        "completed_at",
        minutes_between("started_at", "completed_at").alias("duration_minutes"),
        "source_low_watermark",
        "source_high_watermark",
        "pattern_low_watermark",
        "pattern_high_watermark",
        "transaction_rows_inserted",
        "pattern_rows_inserted",
        "rejected_rows",
        "validation_status",
        "error_message",
    )


def validation_report(validations: DataFrame) -> DataFrame:
    return validations.select(
        "validation_result_id",
        "dw_batch_id",
        "check_name",
        "source_value",
        "target_value",
        (F.col("target_value") - F.col("source_value")).cast("decimal(38,8)").alias("difference_value"),
        "status",
        "details",
        "checked_at",
    )


def latest_rows(df: DataFrame, key: str) -> DataFrame:
    return df.orderBy(F.desc(key)).limit(1)


def data_quality_overview(batches: DataFrame, validations: DataFrame) -> DataFrame:
    """Latest completed load beside the checks of the latest completed FULL load."""
    completed = batches.where("status = 'COMPLETED'")
    latest = latest_rows(completed, "dw_batch_id").select(
        F.col("dw_batch_id").alias("latest_batch_id"),
        F.col("load_type").alias("latest_load_type"),
        F.col("status").alias("latest_batch_status"),
        F.col("validation_status").alias("latest_validation_status"),
        F.col("completed_at").alias("latest_completed_at"),
        F.col("rejected_rows").alias("latest_rejected_rows"),
    )
    full = latest_rows(completed.where("load_type = 'FULL'"), "dw_batch_id").select(
        F.col("dw_batch_id").alias("validation_batch_id")
    )
    checks = validations.select(
        F.col("dw_batch_id").alias("validation_batch_id"), "validation_result_id", F.col("status").alias("check_status")
    )
    keys = [*latest.columns, "validation_batch_id"]
    # Both sides of the cross join hold one row.
    return (
        latest.crossJoin(full)
        .join(checks, "validation_batch_id", "left")
        .groupBy(*keys)
        .agg(
            F.count("validation_result_id").alias("validation_check_count"),
            F.count_if(F.col("check_status") == "PASSED").alias("validation_passed_count"),
            F.count_if(F.col("check_status") == "FAILED").alias("validation_failed_count"),
        )
    )


def reporting_views(
    dims: dict[str, DataFrame], marts: dict[str, DataFrame], batches: DataFrame, validations: DataFrame
) -> dict[str, DataFrame]:
    return {
        "dim_date": report_dates(dims["dim_date"]),
        "dim_payment_currency": report_currencies(dims["dim_currency"], "payment"),
        "dim_receiving_currency": report_currencies(dims["dim_currency"], "receiving"),
        "dim_payment_format": _known(dims["dim_payment_format"], "payment_format_key"),
        "dim_bank": _known(dims["dim_bank"], "bank_key").select("bank_key", "bank_id", "bank_name"),
        "dim_pattern_type": _known(dims["dim_pattern_type"], "pattern_type_key"),
        "kpi_overview": marts["mart_kpi_overview"],
        "fact_daily_transaction": marts["mart_daily_transaction"].drop(
            "full_date", "payment_currency", "payment_format"
        ),
        "fact_aml_payment_format": marts["mart_aml_by_payment_format"].drop("payment_format"),
        "fact_bank_activity": marts["mart_bank_activity"].drop("bank_id", "bank_name"),
        "fact_currency_flow": marts["mart_currency_flow"].drop("payment_currency", "receiving_currency"),
        "fact_pattern_summary": marts["mart_pattern_summary"].drop("pattern_type"),
        "fact_aml_account_risk": report_account_risk(marts["mart_aml_account_risk"], dims["dim_bank"]),
        "etl_batch_monitor": batch_monitor(batches),
        "etl_validation_result": validation_report(validations),
        "data_quality_overview": data_quality_overview(batches, validations),
    }

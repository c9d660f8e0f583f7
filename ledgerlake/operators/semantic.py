"""Measures over the reporting views.

A filter context is a DataFrame filter applied before the measure; slicers reach
the daily mart through its dimensions. Ratios are plain fractions here, while the
marts store percentages.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.measures import divide, total
from ledgerlake.functions.ordinals import dense_rank_desc

# Status colours and title text.
GOOD = "#15803D"
BAD = "#C93C4A"
PICK_ONE = "choose exactly one currency"
DAY = "dd/MM/yyyy"

Views = dict[str, DataFrame]


def _sum(column: str, name: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0).cast("long")).alias(name)


def _period(low: Column, high: Column, prefix: str = "") -> Column:
    return F.concat(F.lit(prefix), F.date_format(low, DAY), F.lit(" - "), F.date_format(high, DAY))


def overall(views: Views) -> DataFrame:
    """Whole-period figures; no slicer changes them."""
    totals = views["kpi_overview"].agg(
        _sum("transaction_count", "overall_transactions"),
        _sum("laundering_count", "overall_laundering"),
        _sum("cross_bank_count", "overall_cross_bank"),
        _sum("cross_currency_count", "overall_cross_currency"),
        _sum("self_transfer_count", "overall_self_transfer"),
        F.min("min_transaction_date").alias("data_start_date"),
        F.max("max_transaction_date").alias("data_end_date"),
    )
    whole = F.col("overall_transactions")
    return totals.withColumns(
        {
            "overall_aml_ratio": divide(F.col("overall_laundering"), whole),
            "overall_cross_bank_ratio": divide(F.col("overall_cross_bank"), whole),
            "overall_cross_currency_ratio": divide(F.col("overall_cross_currency"), whole),
            "overall_self_transfer_ratio": divide(F.col("overall_self_transfer"), whole),
            "data_period_label": _period(F.col("data_start_date"), F.col("data_end_date")),
        }
    )


def sliced_daily(
    views: Views,
    dates: tuple[date, date] | None = None,
    currencies: list[str] | None = None,
    formats: list[str] | None = None,
) -> DataFrame:
    """Daily mart with its dimension columns, filtered by the slicers."""
    rows = (
        views["fact_daily_transaction"]
        .join(views["dim_date"].select("date_key", "full_date", "day_of_week", "day_name"), "date_key")
        .join(views["dim_payment_currency"], "payment_currency_key")
        .join(views["dim_payment_format"], "payment_format_key")
    )
    if dates:
        rows = rows.where(F.col("full_date").between(F.lit(dates[0]), F.lit(dates[1])))
    if currencies:
        rows = rows.where(F.col("payment_currency").isin(currencies))
    if formats:
        rows = rows.where(F.col("payment_format").isin(formats))
    return rows


def _daily_totals() -> list[Column]:
    return [_sum("transaction_count", "transactions"), _sum("laundering_count", "laundering_transactions")]


def filtered(daily: DataFrame) -> DataFrame:
    rows = daily.agg(*_daily_totals(), total("total_amount_paid").alias("amount_paid"))
    return rows.withColumns(
        {
            "aml_ratio": divide(F.col("laundering_transactions"), F.col("transactions")),
            "average_amount_per_transaction": divide(F.col("amount_paid"), F.col("transactions")),
        }
    )


def selected_currency(daily: DataFrame) -> DataFrame:
    """An amount exists only while exactly one currency is in the filter."""
    rows = daily.agg(
        F.count_distinct("payment_currency").alias("n"),
        F.max("payment_currency").alias("name"),
        total("total_amount_paid").alias("paid"),
    )
    one = F.col("n") == 1
    return rows.select(
        F.when(one, F.col("paid")).alias("selected_currency_amount_paid"),
        F.concat(F.lit("Amount Paid - "), F.when(one, F.col("name")).otherwise(PICK_ONE)).alias(
            "selected_currency_amount_title"
        ),
    )


def non_laundering(daily: DataFrame) -> DataFrame:
    rows = daily.agg(*_daily_totals())
    return rows.withColumn(
        "non_laundering_transactions", F.col("transactions") - F.col("laundering_transactions")
    )


def period_title(daily: DataFrame) -> DataFrame:
    title = _period(F.min("full_date"), F.max("full_date"), "Period ")
    return daily.agg(title.alias("selected_period_title"))


# -- time series over the per-day rollup -------------------------------------------------


def per_day(daily: DataFrame) -> DataFrame:
    return daily.groupBy("full_date").agg(*_daily_totals())


def daily_cumulative(daily: DataFrame) -> DataFrame:
    """Running total. The window sees one row per calendar day, never transfers."""
    upto = Window.orderBy("full_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return per_day(daily).withColumn("cumulative_transactions", F.sum("transactions").over(upto))


def daily_previous(daily: DataFrame) -> DataFrame:
    """Value of the calendar day before; a gap gives NULL, not the last row before the gap."""
    days = per_day(daily)
    yesterday = days.select(
        F.date_add("full_date", 1).alias("full_date"), F.col("transactions").alias("previous_day_transactions")
    )
    return days.join(yesterday, "full_date", "left")


def daily_growth(daily: DataFrame) -> DataFrame:
    previous = F.col("previous_day_transactions")
    return daily_previous(daily).withColumn(
        "transaction_growth_ratio", divide(F.col("transactions") - previous, previous)
    )


def daily_change(daily: DataFrame) -> DataFrame:
    previous = F.coalesce("previous_day_transactions", F.lit(0).cast("long"))
    rows = daily_previous(daily).withColumn("daily_transaction_change", F.col("transactions") - previous)
    colour = F.when(F.col("daily_transaction_change") >= 0, GOOD).otherwise(BAD)
    return rows.withColumn("change_color", colour)


# -- banks, accounts, corridors, patterns ------------------------------------------------


def _bank_sums() -> list[Column]:
    return [
        _sum("sent_count", "sent_participations"),
        _sum("received_count", "received_participations"),
        _sum("total_participations", "total_participations"),
        _sum("laundering_participations", "aml_participations"),
    ]


def bank(views: Views) -> DataFrame:
    rows = views["fact_bank_activity"].agg(*_bank_sums())
    return rows.withColumns(
        {
            "aml_participation_ratio": divide(F.col("aml_participations"), F.col("total_participations")),
            "non_aml_participations": F.col("total_participations") - F.col("aml_participations"),
        }
    )


def by_bank_name(views: Views) -> DataFrame:
    """Banks of the same name pool, as a report axis on the name does."""
    named = views["fact_bank_activity"].join(views["dim_bank"], "bank_key")
    rows = named.groupBy("bank_name").agg(*_bank_sums())
    return rows.withColumn(
        "aml_participation_ratio", divide(F.col("aml_participations"), F.col("total_participations"))
    )


def bank_rank(views: Views) -> DataFrame:
    return dense_rank_desc(by_bank_name(views), "total_participations", "bank_activity_rank")


def account_risk(views: Views) -> DataFrame:
    return views["fact_aml_account_risk"].agg(
        _sum("laundering_sent_count", "aml_sent_participations"),
        _sum("laundering_received_count", "aml_received_participations"),
        _sum("laundering_participations", "aml_participations"),
        F.count_distinct("account_key").alias("risk_accounts"),
    )


def account_risk_rank(views: Views) -> DataFrame:
    rows = views["fact_aml_account_risk"].select("account_key", "account_number", "laundering_participations")
    return dense_rank_desc(rows, "laundering_participations", "account_risk_rank")


def corridors(views: Views) -> DataFrame:
    """Currency pairs with names; amounts stay inside their pair."""
    rows = (
        views["fact_currency_flow"]
        .join(views["dim_payment_currency"], "payment_currency_key")
        .join(views["dim_receiving_currency"], "receiving_currency_key")
        .groupBy("payment_currency", "receiving_currency")
        .agg(
            _sum("transaction_count", "transactions"),
            _sum("laundering_count", "laundering_transactions"),
            total("total_amount_paid").alias("amount_paid"),
            total("total_amount_received").alias("amount_received"),
        )
    )
    return rows.withColumns(
        {
            "aml_ratio": divide(F.col("laundering_transactions"), F.col("transactions")),
            "non_laundering_transactions": F.col("transactions") - F.col("laundering_transactions"),
        }
    )


def pattern(views: Views) -> DataFrame:
    rows = views["fact_pattern_summary"].agg(
        _sum("attempt_count", "pattern_attempts"), _sum("pattern_transaction_count", "pattern_transactions")
    )
    return rows.withColumn(
        "transactions_per_attempt", divide(F.col("pattern_transactions"), F.col("pattern_attempts"))
    )


def pattern_rank(views: Views) -> DataFrame:
    rows = views["fact_pattern_summary"].join(views["dim_pattern_type"], "pattern_type_key")
    totals = rows.groupBy("pattern_type").agg(
        _sum("attempt_count", "pattern_attempts"),
        _sum("pattern_transaction_count", "pattern_transactions"),
        F.min("min_sequence").alias("min_sequence"),
        F.max("max_sequence").alias("max_sequence"),
    )
    return dense_rank_desc(totals, "pattern_transactions", "pattern_rank")


# -- loads and validation ------------------------------------------------------------------


def etl(views: Views) -> DataFrame:
    """Counts over the load history and the figures of its newest load."""
    newest = lambda column: F.max_by(column, "dw_batch_id")
    return views["etl_batch_monitor"].agg(
        F.count("*").alias("batch_count"),
        F.count_if(F.col("status") == "COMPLETED").alias("completed_batches"),
        F.count_if(F.col("status") == "FAILED").alias("failed_batches"),
        _sum("rejected_rows", "rejected_rows"),
        F.max("dw_batch_id").alias("latest_batch_id"),
        newest("duration_minutes").alias("latest_duration_minutes"),
        newest("status").alias("latest_batch_status"),
        newest("validation_status").alias("latest_validation_status"),
    )


def validation(views: Views) -> DataFrame:
    rows = views["etl_validation_result"].agg(
        F.count("*").alias("validation_checks"),
        F.count_if(F.col("status") == "PASSED").alias("validation_passed"),
        F.count_if(F.col("status") == "FAILED").alias("validation_failed"),
        total("difference_value").alias("validation_difference"),
    )
    return rows.withColumn(
        "validation_pass_ratio", divide(F.col("validation_passed"), F.col("validation_checks"))
    )


def status_flag(views: Views) -> DataFrame:
    clean = (F.col("failed_batches") == 0) & (F.col("rejected_rows") == 0) & (F.col("validation_failed") == 0)
    both = etl(views).crossJoin(validation(views))
    return both.select(
        "failed_batches",
        "rejected_rows",
        "validation_failed",
        F.when(clean, GOOD).otherwise(BAD).alias("etl_status_color"),
    )


# Measure -> (text snapshot, column, aggregate).
SNAPSHOT_MEASURES = {
    "total_transactions": ("fact_daily_transaction", "transaction_count", "sum"),
    "aml_transactions": ("fact_daily_transaction", "laundering_count", "sum"),
    "total_amount_paid": ("fact_daily_transaction", "total_amount_paid", "sum"),
    "aml_by_format": ("fact_aml_payment_format", "laundering_count", "sum"),
    "bank_participations": ("fact_bank_activity", "total_participations", "sum"),
    "bank_aml_participations": ("fact_bank_activity", "laundering_participations", "sum"),
    "currency_transactions": ("fact_currency_flow", "transaction_count", "sum"),
    "currency_aml_transactions": ("fact_currency_flow", "laundering_count", "sum"),
    "pattern_attempts": ("fact_pattern_summary", "attempt_count", "sum"),
    "pattern_transactions": ("fact_pattern_summary", "pattern_transaction_count", "sum"),
    "account_aml_participations": ("fact_aml_account_risk", "laundering_participations", "sum"),
    "validation_difference": ("etl_validation_result", "difference_value", "sum"),
    "overview_transactions": ("kpi_overview", "transaction_count", "max"),
    "overview_laundering": ("kpi_overview", "laundering_count", "max"),
    "overview_aml_rate": ("kpi_overview", "laundering_rate_percent", "max"),
    "overview_cross_bank": ("kpi_overview", "cross_bank_count", "max"),
    "overview_cross_currency": ("kpi_overview", "cross_currency_count", "max"),
    "overview_self_transfer": ("kpi_overview", "self_transfer_count", "max"),
}


def snapshot_measures(text_views: Views) -> DataFrame:
    """Eighteen measures over snapshots whose columns are all text."""
    grouped: dict[str, list[Column]] = {}
    for name, (view, column, kind) in SNAPSHOT_MEASURES.items():
        number = F.col(column).try_cast("decimal(38,8)")
        value = F.sum(number) if kind == "sum" else F.max(number)
        grouped.setdefault(view, []).append(value.cast("decimal(38,8)").alias(name))
    result = None
    for view, columns in grouped.items():
        one_row = text_views[view].agg(*columns)
        result = one_row if result is None else result.crossJoin(one_row)
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("measure_name"), F.col(name).alias("measure_value"))
            for name in SNAPSHOT_MEASURES
        ]
    )
    return result.select(F.inline(pairs))


def as_text(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])

"""Data behind dashboard visuals, from the reporting views."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.measures import divide
from ledgerlake.operators import semantic

Views = dict[str, DataFrame]

def _counts() -> list[Column]:
    return [
        F.sum("transaction_count").alias("transactions"),
        F.sum("laundering_count").alias("laundering_transactions"),
    ]


def _ratio() -> Column:
    return divide(F.col("laundering_transactions"), F.col("transactions")).alias("aml_ratio")


def _slug(text: str) -> str:
    return "".join(ch if ch.isalnum() else "_" for ch in text.lower())


def spread(rows: DataFrame, index: list[str], axis: str, value: str, known: list[str]) -> DataFrame:
    """Matrix with one column per known axis value and one for all others, so nothing is lost."""
    other = ~F.col(axis).isin(known)
    cells = [F.coalesce(F.sum(F.when(F.col(axis) == v, F.col(value))), F.lit(0)).cast("long").alias(_slug(v)) for v in known]
    rest = F.coalesce(F.sum(F.when(other, F.col(value))), F.lit(0)).cast("long").alias("all_other")
    return rows.groupBy(*index).agg(*cells, rest)


def daily_average(daily: DataFrame) -> DataFrame:
    rows = daily.agg(F.sum("transaction_count").alias("transactions"), F.count_distinct("full_date").alias("active_dates"))
    return rows.withColumn("daily_average", divide(F.col("transactions"), F.col("active_dates")))


def weekday_volume(daily: DataFrame) -> DataFrame:
    return daily.groupBy("day_of_week", "day_name").agg(F.sum("transaction_count").alias("transactions")).orderBy("day_of_week")


def daily_detail(daily: DataFrame) -> DataFrame:
    return daily.groupBy("full_date").agg(*_counts()).select("*", _ratio())


def format_volume(daily: DataFrame) -> DataFrame:
    return daily.groupBy("payment_format").agg(*_counts()).select("*", _ratio())


def aml_trend(daily: DataFrame) -> DataFrame:
    return daily.groupBy("full_date").agg(F.sum("laundering_count").alias("laundering_transactions"))


def bank_scatter(views: Views) -> DataFrame:
    return semantic.by_bank_name(views).select(
        "bank_name", "total_participations", "aml_participation_ratio", "aml_participations"
    )


def corridor_detail(views: Views) -> DataFrame:
    return semantic.corridors(views).select(
        "payment_currency", "receiving_currency", "transactions", "laundering_transactions", "aml_ratio"
    )


def pattern_detail(views: Views) -> DataFrame:
    rows = semantic.pattern_rank(views)
    each = divide(F.col("pattern_transactions"), F.col("pattern_attempts"))
    return rows.withColumn("transactions_per_attempt", each)


def batch_history(views: Views) -> DataFrame:
    return (
        views["etl_batch_monitor"]
        .select(
            "dw_batch_id",
            "load_type",
            "status",
            "duration_minutes",
            "transaction_rows_inserted",
            "rejected_rows",
            "validation_status",
        )
        .orderBy(F.desc("dw_batch_id"))
    )


def validation_detail(views: Views) -> DataFrame:
    return views["etl_validation_result"].select(
        "dw_batch_id", "check_name", "source_value", "target_value", "difference_value", "status"
    )


def drill_calendar(views: Views) -> DataFrame:
    """Totals per year, quarter, month and date in one rollup of the daily mart."""
    rows = views["fact_daily_transaction"].join(views["dim_date"], "date_key")
    levels = ["year_number", "quarter_number", "month_number", "full_date"]
    return rows.rollup(*levels).agg(
        F.grouping_id().cast("int").alias("level_id"),
        *_counts(),
    )


def hour_daypart(fact: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Counts per minute first; the 1,441-row time dimension joins the groups."""
    minutes = fact.groupBy("time_key").agg(
        F.count("*").alias("transaction_count"), F.count_if("is_laundering").alias("laundering_count")
    )
    return (
        minutes.join(F.broadcast(dim_time), "time_key")
        .groupBy("hour_number", "day_part")
        .agg(*_counts())
    )


def daily_rollup(views: Views) -> DataFrame:
    """Dashboard trend from the mart instead of the fact."""
    rows = views["fact_daily_transaction"].join(views["dim_date"].select("date_key", "full_date"), "date_key")
    return rows.groupBy("full_date").agg(
        F.sum("transaction_count").alias("transaction_count"), F.sum("laundering_count").alias("laundering_count")
    )

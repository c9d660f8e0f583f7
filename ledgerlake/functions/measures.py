"""Ratios and rounding shared by marts, reports and measures."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.schemas import MONEY_TOTAL


def rate_percent(part: str, whole: str) -> Column:
    """100 * part / whole to six digits, half away from zero, in exact integer arithmetic."""
    return F.expr(
        f"cast((cast({part} as decimal(26,0)) * 200000000 + {whole}) "
        f"div nullif(2 * cast({whole} as decimal(20,0)), 0) as double) / 1000000"
    )


def divide(numerator: Column, denominator: Column) -> Column:
    """Ratio as double; 0 when the denominator is missing or zero."""
    ratio = numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))
    return F.coalesce(ratio, F.lit(0.0))


def total(column: str) -> Column:
    """Sum of money, widened to decimal(38,8)."""
    return F.sum(column).cast(MONEY_TOTAL)


def change_hash(*parts: Column) -> Column:
    """MD5 over the parts, separated by the unit separator; NULL parts are skipped."""
    return F.md5(F.concat_ws(chr(31), *parts))


def minutes_between(start: str, end: str) -> Column:
    micros = F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)).cast("decimal(20,0)")
    return F.round(micros / F.lit(60_000_000), 2).cast("double")


def moment(value: datetime) -> Column:
    """A wall-clock literal, whatever the time zones of the driver and the session are."""
    return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")

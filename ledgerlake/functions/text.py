"""Landing text to typed columns. Every parser yields NULL for text it does not accept."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.schemas import MONEY

# Accepted shapes. \z, unlike $, refuses a trailing line feed.
DIGITS = r"^[0-9]+\z"
DECIMAL_TEXT = r"^[+-]?[0-9]+([.][0-9]+)?\z"
MINUTE_TEXT = r"^[0-9]{4}/[0-9]{2}/[0-9]{2} [0-9]{2}:[0-9]{2}\z"
LABEL_TEXT = r"^(0|1)\z"


def filled(column: str) -> Column:
    """Trimmed text, NULL when blank."""
    return F.nullif(F.trim(F.col(column)), F.lit(""))


def matching(column: str, shape: str) -> Column:
    text = F.trim(F.col(column))
    return F.when(text.rlike(shape), text)


def bank_id(column: str) -> Column:
    """Digits through a long and back, which drops leading zeros."""
    return matching(column, DIGITS).try_cast("bigint").cast("string")


def whole_number(column: str, kind: str) -> Column:
    return matching(column, DIGITS).try_cast(kind)


def money(column: str) -> Column:
    return matching(column, DECIMAL_TEXT).try_cast(MONEY)


def minute_timestamp(column: str) -> Column:
    """``yyyy/MM/dd HH:mm`` without a time zone; impossible dates and hours give NULL."""
    iso = F.concat(F.translate(matching(column, MINUTE_TEXT), "/", "-"), F.lit(":00"))
    return iso.try_cast("timestamp_ntz")


def label(column: str) -> Column:
    return matching(column, LABEL_TEXT) == F.lit("1")


def all_present(columns: list[str]) -> Column:
    present = F.col(columns[0]).isNotNull()
    for name in columns[1:]:
        present = present & F.col(name).isNotNull()
    return present


def payload(fields: list[str]) -> Column:
    return F.concat_ws("|", *fields)

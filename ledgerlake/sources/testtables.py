"""Adapter: the TPC-H style test tables as landing text frames.

One line item is one transfer from the ordering customer to the supplier. The
formulas, dirty rows included, are deterministic so that a SQL engine can repeat
them. Joins carry no broadcast hint: the planner sizes customer and supplier.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.ordinals import dense_ordinal
from ledgerlake.schemas import (
    ACCOUNT_FIELDS,
    PATTERN_FIELDS,
    PATTERN_TYPES,
    PAYMENT_FORMATS,
    TRANSACTION_FIELDS,
)

# Currencies the adapter deals out.
CURRENCIES = ["US Dollar", "Euro", "Yuan", "Rupee", "Bitcoin"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: str) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return f"element_at(array({listed}), cast({index} as int) + 1)"


def _packed_keys(plus: str, times: str) -> str:
    """A line's keys and ship day as digits of one number, by the given two-place functions."""
    keys = f"{plus}({times}(l_orderkey, 10L), l_linenumber)"
    for base, key in ((100000, "l_partkey"), (1000, "l_suppkey"), (10000, "day")):
        keys = f"{plus}({times}({keys}, {base}L), {key})"
    return keys


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a ``landing_row_id`` that rises with their keys.

    The id is the keys' digits in one number. A table with a line for which that number leaves 64
    bits is numbered 1..n in the same order instead, once, in a written copy.
    """
    rows = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_partkey",
        "l_suppkey",
        "l_linenumber",
        "l_shipdate",
        "datediff(cast(l_shipdate as date), date'1990-01-01') as day",
        "cast(l_extendedprice as decimal(24,8)) as paid",
        "cast(l_discount as decimal(3,2)) as discount",
    )
    fits = _packed_keys("try_add", "try_multiply")
    too_large = rows.where(
        f"{fits} is null and l_orderkey is not null and l_linenumber is not null"
        " and l_partkey is not null and l_suppkey is not null and day is not null"
    )
    if too_large.isEmpty():
        numbered = rows.withColumn("landing_row_id", F.expr(fits))
    else:
        # Rows that agree in all of these are the same, so their order does not matter.
        order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "paid", "discount"]
        numbered = dense_ordinal(rows, order, name="landing_row_id")
    return numbered.drop("day")


def _transfers(spark: SparkSession, sf_dir: str, line: DataFrame) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = _table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    supplier = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Orders meet their customers first: lines, the many side, are shuffled for one join fewer.
    ordered = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    joined = line.join(ordered, F.col("l_orderkey") == F.col("o_orderkey")).join(
        supplier, F.col("l_suppkey") == F.col("s_suppkey")
    )
    steps = joined.selectExpr(
        "*",
        "l_partkey % 11 = 0 as is_self",
        "cast(cast(l_shipdate as date) as string) as day_text",
        "(l_orderkey * 7 + l_partkey * 3 + l_linenumber * 131) % 1440 as minute_of_day",
        f"{_pick(CURRENCIES, 'c_nationkey % 5')} as pay_currency",
        "lpad(cast(c_nationkey as string), 4, '0') as own_bank",
        "concat(' c', lpad(cast(c_custkey as string), 9, '0')) as own_account",
    ).selectExpr(
        "*",
        "if(l_linenumber % 4 = 0, "
        + _pick(CURRENCIES, "if(is_self, c_nationkey, s_nationkey) % 5")
        + ", pay_currency) as get_currency",
    )
    return steps.selectExpr(
        "landing_row_id",
        "c_custkey",
        "concat(if(l_orderkey % 211 = 0, day_text, translate(day_text, '-', '/')), ' ',"
        " lpad(cast(minute_of_day div 60 as string), 2, '0'), ':',"
        " lpad(cast(minute_of_day % 60 as string), 2, '0')) as timestamp_text",
        "if(l_orderkey % 223 = 0, concat('X', own_bank), own_bank) as from_bank_text",
        "own_account as from_account_text",
        "if(is_self, own_bank, lpad(cast(s_nationkey as string), 6, '0')) as to_bank_text",
        "if(is_self, own_account, concat('s', lpad(cast(l_suppkey as string), 9, '0')))"
        " as to_account_text",
        "cast(cast(if(pay_currency <> get_currency, paid * (1 - discount), paid)"
        " as decimal(24,8)) as string) as amount_received_text",
        "get_currency as receiving_currency_text",
        "if(l_orderkey % 227 = 0, 'n/a', cast(paid as string)) as amount_paid_text",
        "if(l_orderkey % 233 = 0, '  ', pay_currency) as payment_currency_text",
        f"{_pick(PAYMENT_FORMATS, 'l_suppkey % 7')} as payment_format_text",
        "case when l_orderkey % 229 = 0 then '2'"
        " when (l_orderkey * 31 + l_partkey) % 97 = 0 then '1' else '0' end as is_laundering_text",
        "(l_orderkey * 31 + l_partkey) % 97 = 0 as in_pattern",
    )


def transaction_landing(spark: SparkSession, sf_dir: str, line: DataFrame) -> DataFrame:
    """One transfer for each of the :func:`lines`."""
    return _transfers(spark, sf_dir, line).select("landing_row_id", *TRANSACTION_FIELDS)


def pattern_landing(spark: SparkSession, sf_dir: str, line: DataFrame) -> DataFrame:
    """Laundering transfers, one attempt per paying customer, numbered in id order."""
    rows = (
        _transfers(spark, sf_dir, line)
        .where("in_pattern")
        .withColumn("attempt", F.col("c_custkey") + 1)
        .selectExpr(
            "landing_row_id",
            "attempt",
            f"{_pick(PATTERN_TYPES, 'c_custkey % 8')} as pattern_type_text",
            "concat('Max ', cast(c_custkey % 16 + 1 as string), '-degree') as extent",
            *TRANSACTION_FIELDS,
        )
    )
    numbered = dense_ordinal(rows, ["landing_row_id"], within=("attempt",), name="sequence")
    return numbered.select(
        "landing_row_id",
        F.col("attempt").cast("string").alias("pattern_attempt_id_text"),
        "pattern_type_text",
        F.concat("pattern_type_text", F.lit(":  "), "extent").alias("pattern_description_text"),
        F.col("sequence").cast("string").alias("pattern_sequence_text"),
        *TRANSACTION_FIELDS,
    )


def account_landing(spark: SparkSession, sf_dir: str, second_snapshot: bool = False) -> DataFrame:
    """Customers and suppliers as account masters.

    Some rows are dirty, so that rejects and unknown-key lookups occur. The second
    snapshot moves every 100th customer to another entity and renames banks.
    """
    renamed = " || if(nation % 10 = 0, ' NEW', '')" if second_snapshot else ""
    moved = "if(c_custkey % 100 = 0, c_custkey + 7, c_custkey)" if second_snapshot else "c_custkey"
    customers = _table(spark, sf_dir, "customer").selectExpr(
        "c_custkey * 2 + 1 as landing_row_id",
        "c_nationkey as nation",
        "if(c_custkey % 2 = 1, ' plc', '') as suffix",
        "if(c_custkey % 251 = 250, 'X', '') as bank_prefix",
        "concat(' c', lpad(cast(c_custkey as string), 9, '0')) as account_number_text",
        f"concat('e', cast({moved} % 1000 as string)) as entity_id_text",
        f"{moved} % 1000 as entity_no",
    )
    suppliers = _table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey * 2 + 2 as landing_row_id",
        "s_nationkey as nation",
        "'' as suffix",
        "'' as bank_prefix",
        "if(s_suppkey % 97 = 96, ' ', concat('s', lpad(cast(s_suppkey as string), 9, '0')))"
        " as account_number_text",
        "if(s_suppkey % 50 = 0, '', concat('e', cast(s_suppkey % 1000 as string))) as entity_id_text",
        "s_suppkey % 1000 as entity_no",
    )
    return customers.unionByName(suppliers).selectExpr(
        "landing_row_id",
        f"'Bank ' || cast(nation % 20 as string) || suffix{renamed} as bank_name_text",
        "bank_prefix || lpad(cast(nation as string), 4, '0') as bank_id_text",
        *ACCOUNT_FIELDS[2:4],
        "if(entity_no % 10 = 0, '', 'Entity ' || cast(entity_no as string)) as entity_name_text",
    )

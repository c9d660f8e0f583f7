"""Questions to the written, partitioned copy of the transfers, and its comparison with another copy."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.measures import rate_percent
from ledgerlake.operators.recon import compare_by_key, count_where
from ledgerlake.session import stage

#: What both copies hold, in the same types. The first column is the key.
SHARED = [
    "transaction_key",
    "date_key",
    "payment_format",
    "payment_currency",
    "receiving_currency",
    "amount_paid",
    "amount_received",
    "is_laundering",
    "is_cross_bank",
    "is_cross_currency",
    "is_self_transfer",
]
#: Checksums of a copy; a fixed number, so their comparison is small at every size.
BUCKETS = 4096
COUNTS = ["transaction_count", "laundering_count"]


def _counts() -> list[Column]:
    return [F.count("*").alias(COUNTS[0]), count_where(F.col("is_laundering").cast("int") == 1).alias(COUNTS[1])]


def daily(fact: DataFrame) -> DataFrame:
    return fact.groupBy("txn_date").agg(*_counts())


def format_rate(fact: DataFrame) -> DataFrame:
    return fact.groupBy("payment_format").agg(*_counts()).withColumn("laundering_rate_percent", rate_percent(*reversed(COUNTS)))


def aml_rate(fact: DataFrame) -> DataFrame:
    return fact.agg(*_counts()).withColumn("laundering_rate_percent", rate_percent(*reversed(COUNTS)))


def flag_counts(fact: DataFrame) -> DataFrame:
    """From the stored flags; no bank or account column is read."""
    flags = ("cross_bank", "self_transfer", "cross_currency")
    return fact.agg(*[count_where(F.col(f"is_{flag}")).alias(f"{flag}_count") for flag in flags])


# -- two copies ------------------------------------------------------------------------------------


def shared_columns(fact: DataFrame) -> DataFrame:
    """The curated copy in the columns and types both copies hold."""
    day = F.col("txn_date")
    return fact.withColumns(
        {
            "date_key": F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day),
            "is_laundering": F.col("is_laundering") == 1,
        }
    ).select(SHARED)


def warehouse_copy(fact: DataFrame, dim_currency: DataFrame, dim_payment_format: DataFrame) -> DataFrame:
    """The warehouse's fact in the same columns, keys replaced by names."""
    named = fact.join(dim_payment_format, "payment_format_key", "left")
    for side in ("payment", "receiving"):
        names = dim_currency.select(
            F.col("currency_key").alias(f"{side}_currency_key"), F.col("currency_name").alias(f"{side}_currency")
        )
        named = named.join(names, f"{side}_currency_key", "left")
    return named.select(SHARED)


def _totals(copy: DataFrame, name: str) -> DataFrame:
    flags = ("cross_bank", "self_transfer", "cross_currency")
    found = copy.agg(
        *_counts(),
        *[count_where(F.col(f"is_{flag}")).alias(f"{flag}_count") for flag in flags],
        F.min("date_key").alias("first_date_key"),
        F.max("date_key").alias("last_date_key"),
    ).withColumn("laundering_rate_percent", rate_percent(*reversed(COUNTS)))
    entries = [F.struct(F.lit(c).alias("measure"), F.col(c).cast("decimal(38,6)").alias(name)) for c in found.columns]
    return found.select(F.inline(F.array(*entries)))


def totals_compared(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows, labels, rate, flags and first and last day of both copies, one row a figure."""
    both = _totals(left, "source_value").join(_totals(right, "target_value"), "measure")
    return both.withColumn("matches", F.col("source_value").eqNullSafe(F.col("target_value")))


def days_compared(left: DataFrame, right: DataFrame) -> DataFrame:
    sides = [copy.groupBy("date_key").agg(*_counts()) for copy in (left, right)]
    return compare_by_key(*sides, ["date_key"], COUNTS)


def _marked(column: str) -> list[Column]:
    """A value and whether it is there: the hash alone passes over missing values."""
    return [F.col(column).isNull(), F.col(column)]


def _bucket(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*_marked(key)), F.lit(buckets)).cast("int")


def checksums(copy: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    """For each bucket of keys: rows, and a sum and a mix of their hashes, in whatever order they lie."""
    row = F.xxhash64(*[x for c in sorted(copy.columns) for x in _marked(c)])
    hashed = copy.select(_bucket(key, buckets).alias("bucket"), row.alias("h"))
    return hashed.groupBy("bucket").agg(
        F.count("*").alias("n_rows"), F.sum(F.col("h").cast("decimal(38,0)")).alias("total"), F.bit_xor("h").alias("mixed")
    )


def unequal_buckets(left: DataFrame, right: DataFrame, key: str, buckets: int = BUCKETS) -> DataFrame:
    parts = ["n_rows", "total", "mixed"]
    compared = compare_by_key(*[checksums(copy, key, buckets) for copy in (left, right)], ["bucket"], parts)
    return compared.where("not matches").select("bucket")


def differing_rows(
    left: DataFrame, right: DataFrame, key: str, names: tuple[str, str], buckets: int = BUCKETS
) -> DataFrame:
    """Rows that one copy has more often than the other, with ``copy`` and ``surplus``.

    Both copies are reduced to one checksum a bucket of keys where they lie; only rows of buckets
    that differ are shuffled. A changed row comes back twice, once from each copy. Columns must be
    the same; missing values equal each other, repeated rows are counted. Equal copies, empty ones
    too, give no row.
    """
    odd = stage(unequal_buckets(left, right, key, buckets), "copies-unequal")
    columns = left.columns

    def suspects(copy: DataFrame, sign: int) -> DataFrame:
        placed = copy.select(*columns, _bucket(key, buckets).alias("_bucket"), F.lit(sign).cast("long").alias("_sign"))
        # At most ``buckets`` numbers.
        return placed.join(F.broadcast(odd), F.col("_bucket") == F.col("bucket"), "left_semi").drop("_bucket")

    balance = suspects(left, 1).unionByName(suspects(right, -1)).groupBy(*columns).agg(F.sum("_sign").alias("_balance"))
    return balance.where("_balance != 0").select(
        *columns,
        F.when(F.col("_balance") > 0, names[0]).otherwise(names[1]).alias("copy"),
        F.abs("_balance").alias("surplus"),
    )

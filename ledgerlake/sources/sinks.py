"""Sinks: report CSVs, typed lakehouse tables, curated facts and rejects."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.session import run_together

TRUE_TOKENS = ["true", "t", "1", "yes", "y"]


def export_views(views: dict[str, DataFrame], folder: str) -> None:
    """One CSV folder with a header per view."""
    spark = next(iter(views.values())).sparkSession

    def write(name: str) -> None:
        views[name].write.option("header", True).csv(f"{folder}/{name}")

    run_together(spark, [partial(write, name) for name in views])


def _typed(column: str, kind: T.DataType):
    text = F.col(column)
    if isinstance(kind, T.BooleanType):
        return F.lower(text).isin(TRUE_TOKENS).alias(column)
    return text.cast(kind).alias(column)


def load_lakehouse(
    spark: SparkSession, folder: str, schemas: dict[str, T.StructType], target: str, prefix: str
) -> list[str]:
    """Exported CSVs back as typed tables; a malformed line stops the load.

    Money stays decimal and bank ids stay text.
    """
    tables = []
    for name, schema in schemas.items():
        as_text = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
        rows = spark.read.schema(as_text).option("header", True).option("mode", "FAILFAST").csv(f"{folder}/{name}")
        typed = rows.select(*[_typed(f.name, f.dataType) for f in schema])
        table = f"{prefix}{name}"
        typed.write.mode("overwrite").option("path", f"{target}/{name}").saveAsTable(table)
        tables.append(table)
    return tables


def write_curated(curated: DataFrame, folder: str, partition: str = "txn_date", add: bool = False) -> None:
    """Valid rows as Snappy Parquet by ``partition``, rejects apart.

    Only the partitions in ``curated`` are replaced, so running one again appends
    nothing twice. The rebalance splits a hot day over several tasks. With ``add`` the
    rows go beside those that are there: a new copy may be written slice by slice.
    """
    valid = curated.where("is_valid").drop("is_valid")
    (
        valid.hint("rebalance", partition)
        .write.mode("append" if add else "overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(partition)
        .parquet(f"{folder}/fact_transaction")
    )


def write_rejects(rejects: DataFrame, folder: str) -> None:
    rejects.write.mode("overwrite").parquet(f"{folder}/rejects/transaction")


def write_bridge(patterns: DataFrame, folder: str) -> None:
    """The transfers of each pattern attempt beside the curated facts, a folder for each of the few types."""
    bridge = patterns.select(
        "pattern_transaction_id",
        F.col("pattern_attempt_id").alias("attempt_id"),
        "pattern_sequence",
        "transaction_timestamp",
        "from_bank_id",
        "from_account_id",
        "to_bank_id",
        "to_account_id",
        "amount_paid",
        "payment_currency",
        "pattern_type",
    )
    (
        bridge.hint("rebalance", "pattern_type")
        .write.mode("overwrite")
        .partitionBy("pattern_type")
        .parquet(f"{folder}/bridge_pattern_transaction")
    )

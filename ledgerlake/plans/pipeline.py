"""The whole run on source files: land, type, load, check, refresh, test, export."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.ordinals import dense_ordinal, file_ordinal
from ledgerlake.plans import acceptance, source_load
from ledgerlake.plans.store import Clock, TableStore, utc_now
from ledgerlake.plans.warehouse import Warehouse
from ledgerlake.session import stage
from ledgerlake.sources import files, sinks
from ledgerlake.sources.patterns import read_pattern_blocks


@dataclass
class RunResult:
    source_batch: int
    dw_batch: int
    validation: str
    test_run: int
    warehouse: Warehouse
    rejected_pattern_lines: DataFrame


def landing_from_files(
    spark: SparkSession, accounts: str, transactions: str, pattern_text: str
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Landing frames numbered in file order, and the pattern lines that fit no block."""
    blocks, rejected = read_pattern_blocks(spark, pattern_text)
    place = blocks.withColumns(
        {
            "attempt": F.col("pattern_attempt_id_text").cast("long"),
            "step": F.col("pattern_sequence_text").cast("long"),
        }
    )
    numbered = {
        "account": file_ordinal(files.read_accounts(spark, accounts)),
        "transaction": file_ordinal(files.read_transactions(spark, transactions)),
        "pattern": dense_ordinal(place, ["attempt", "step"], name="landing_row_id").drop("attempt", "step"),
    }
    # Written once: the gate, the typing and the duplicate check read the same numbers.
    return {name: stage(frame, f"landing-{name}") for name, frame in numbered.items()}, rejected


def run_pipeline(
    spark: SparkSession,
    root: str,
    accounts: str,
    transactions: str,
    pattern_text: str,
    load_type: str = "FULL",
    expected_rows: dict[str, int] | None = None,
    expected_figures: dict[str, str] | None = None,
    export_folder: str | None = None,
    clock: Clock = utc_now,
    append: bool = False,
) -> RunResult:
    """One run below ``root``, a folder all executors can reach.

    With ``append`` the files hold transfers and patterns that are new since the last run, and
    a whole account snapshot; ids continue, and an INCREMENTAL load takes in what is new.
    """
    landing, rejected = landing_from_files(spark, accounts, transactions, pattern_text)
    source_store = TableStore(spark, f"{root}/source")
    earlier = source_load.completed_batches(source_store) if append else []
    if earlier:
        landing = source_load.continued(landing, source_store, earlier)
    batch = source_load.load_source_batch(source_store, landing, clock=clock, expected_rows=expected_rows)
    source = source_load.source_tables(source_store, batch, earlier)
    lines = rejected.withColumn("load_batch_id", F.lit(batch).cast("long"))
    source_store.write(lines, "rejected_pattern_line", batch)

    warehouse = Warehouse(TableStore(spark, f"{root}/warehouse"), clock)
    dw_batch = warehouse.load(source, load_type)
    verdict = warehouse.validate(source)
    warehouse.refresh_marts()
    reports = warehouse.reports()
    tests = TableStore(spark, f"{root}/tests")
    test_run = acceptance.record_run(
        tests,
        lambda run_id: acceptance.run_acceptance(
            source,
            warehouse.tables(),
            reports,
            warehouse.batches(),
            warehouse.validations(),
            warehouse.marts(),
            expected_figures or {},
            run_id,
        ),
        clock=clock,
    )
    if export_folder:
        sinks.export_views(reports, export_folder)
    kept_lines = spark.read.schema(lines.schema).parquet(source_store.path("rejected_pattern_line", batch))
    return RunResult(batch, dw_batch, verdict, test_run, warehouse, kept_lines)

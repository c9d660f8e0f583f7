"""One loaded warehouse per session and input folder, shared by the registered queries.

Like the warehouse itself, the queries read tables a load has written: landing is
written once, typed once, loaded once (FULL, then an INCREMENTAL without news).
"""

from __future__ import annotations

from datetime import datetime, timedelta
from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators import enrich, semantic
from ledgerlake.operators import typing as ty
from ledgerlake.plans import source_load as sl
from ledgerlake.plans.source_load import SourceTables
from ledgerlake.plans.store import Clock, TableStore
from ledgerlake.plans.warehouse import Warehouse
from ledgerlake.session import (
    CODEC,
    ROW_GROUP_BYTES,
    drop,
    drop_shuffles_early,
    fresh_path,
    passing_stages,
    run_together,
    slices,
    stage,
    write_parts,
)
from ledgerlake.sources import sinks, testtables

CLOCK_START = datetime(2024, 1, 1)
CLOCK_STEP = timedelta(seconds=90)


def step_clock(start: datetime = CLOCK_START, step: timedelta = CLOCK_STEP) -> Clock:
    """A clock that advances by ``step`` per reading, so that audit times repeat."""
    ticks = [0]

    def read() -> datetime:
        ticks[0] += 1
        return start + step * (ticks[0] - 1)

    return read


class Workspace:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        drop_shuffles_early(spark)

    def path(self, label: str) -> str:
        return fresh_path(self.spark, label)

    def settled(self, result: DataFrame, *folders: str) -> DataFrame:
        """A small result, written, so that the scratch folders it was made of can go."""
        result = stage(result, "settled")
        for folder in folders:
            drop(self.spark, folder)
        return result

    def scratch_warehouse(self) -> Warehouse:
        return Warehouse(TableStore(self.spark, self.path("dw")), step_clock())

    @cached_property
    def landing(self) -> dict[str, DataFrame]:
        """Landing frames, written once: the files a source folder would hold. Transfers lie in the order of their ids' ranges."""
        spark, tables = self.spark, self.sf_dir

        def write(name: str, parts: list) -> DataFrame:
            path = self.path(f"landing-{name}")
            schema = write_parts(spark, parts, path, compression=CODEC, **{"parquet.block.size": ROW_GROUP_BYTES})
            return spark.read.schema(schema).parquet(path)

        with passing_stages(spark):  # of the numbered lines
            lines = testtables.lines(spark, tables)
            parts = {
                "account": [partial(testtables.account_landing, spark, tables)],
                "transaction": [
                    partial(testtables.transaction_landing, spark, tables, part) for part in slices(lines, "l_orderkey")
                ],
                "pattern": [partial(testtables.pattern_landing, spark, tables, lines)],
            }
            return dict(zip(parts, run_together(spark, [partial(write, *entry) for entry in parts.items()])))

    @cached_property
    def second_accounts(self) -> DataFrame:
        """A later account snapshot: some entities moved, some banks renamed."""
        return stage(
            testtables.account_landing(self.spark, self.sf_dir, second_snapshot=True), "landing-account-2"
        )

    @cached_property
    def source_store(self) -> TableStore:
        store = TableStore(self.spark, self.path("source"))
        sl.load_source_batch(store, self.landing, clock=step_clock())
        return store

    @cached_property
    def source(self) -> SourceTables:
        return sl.source_tables(self.source_store, 1)

    @cached_property
    def warehouse(self) -> Warehouse:
        warehouse = self.scratch_warehouse()
        for load_type in ("FULL", "INCREMENTAL"):
            warehouse.load(self.source, load_type)
            warehouse.validate(self.source)
        warehouse.refresh_marts()
        return warehouse

    @cached_property
    def tables(self) -> dict[str, DataFrame]:
        return self.warehouse.tables()

    @cached_property
    def marts(self) -> dict[str, DataFrame]:
        return self.warehouse.marts()

    @cached_property
    def reports(self) -> dict[str, DataFrame]:
        return self.warehouse.reports()

    @cached_property
    def curated(self) -> dict[str, DataFrame]:
        """The curated copy as a lakehouse reads it: valid facts by month, and the bridge to pattern attempts."""
        folder = self.path("curated")
        for number, part in enumerate(slices(self.landing["transaction"], "landing_row_id")):
            rows = enrich.curated_transactions(ty.lenient_transactions(part), "run-1")
            by_month = rows.withColumn("txn_month", F.date_format("txn_date", "yyyyMM").cast("int"))
            sinks.write_curated(by_month, folder, "txn_month", add=number > 0)
        sinks.write_bridge(self.source.patterns, folder)
        names = ("fact_transaction", "bridge_pattern_transaction")
        return {name: self.spark.read.parquet(f"{folder}/{name}") for name in names}

    @property
    def daily(self) -> DataFrame:
        return semantic.sliced_daily(self.reports)


_open: dict[tuple[str, str], Workspace] = {}


def workspace(spark: SparkSession, sf_dir: str) -> Workspace:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _open:
        _open[key] = Workspace(spark, key[1])
    return _open[key]

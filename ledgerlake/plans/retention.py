"""Mark and sweep of folders that no log row needs any more.

A folder is marked while a published state names it, or named it less than the given age ago, so a
reader that opened a state keeps its files for that long. So is every folder of a load that has
started and not ended. What is left is swept once its newest file has that age: folders of failed
loads, replaced tables, old refreshes and the staging of applications that are gone. The age must
exceed the longest refresh, which shows in the log only at its end. Folders of other tables under
the same root are never touched.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession

from ledgerlake.operators import marts as mt
from ledgerlake.plans.source_load import LOG as SOURCE_LOG
from ledgerlake.plans.source_load import OBJECTS
from ledgerlake.plans.store import Clock, TableStore, utc_now, versions_from
from ledgerlake.plans.warehouse import FACT_SCHEMAS, FACT_TOTALS, MART_LOG, MART_REFRESH, PRINTS, SOURCE_TOTALS, Warehouse
from ledgerlake.schemas import DIM_SCHEMAS, LOAD_BATCH
from ledgerlake.session import shared_dir

SOURCE_TABLES = [*(f"tagged_{name}" for name in OBJECTS), "rejected_pattern_line"]
WAREHOUSE_TABLES = [*DIM_SCHEMAS, *FACT_SCHEMAS, PRINTS, SOURCE_TOTALS, FACT_TOTALS, "validation_result", *mt.MART_NAMES, *mt.ROLLUPS]


@dataclass
class Marks:
    """Versions to keep of each table, and loads under way, whose folders are kept in every table."""

    versions: dict[str, set[int]] = field(default_factory=dict)
    running: set[int] = field(default_factory=set)

    def add(self, named: dict[str, Iterable[int]]) -> None:
        for table, versions in named.items():
            self.versions.setdefault(table, set()).update(versions)


def _children(spark: SparkSession, path: str) -> list:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return list(fs.listStatus(jvm_path)) if fs.exists(jvm_path) else []


def _newest(spark: SparkSession, status) -> datetime:
    """When something below a folder was last written."""
    times, todo = [status.getModificationTime()], [status]
    while todo:
        folder = todo.pop()
        if folder.isDirectory():
            for child in _children(spark, folder.getPath().toString()):
                times.append(child.getModificationTime())
                todo.append(child)
    return datetime.fromtimestamp(max(times) / 1000, timezone.utc).replace(tzinfo=None)


def _delete(spark: SparkSession, status) -> None:
    path = status.getPath()
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def warehouse_marks(warehouse: Warehouse, since: datetime) -> Marks:
    """Folders of every state that was current at ``since`` or later."""
    marks, rows = Marks(), warehouse.batch_rows()
    marks.running = {r["dw_batch_id"] for r in rows if r["status"] == "STARTED"}
    done = [r for r in rows if r["status"] == "COMPLETED"]
    for i in range(len(done)):
        if i + 1 == len(done) or done[i + 1]["completed_at"] > since:
            marks.add(warehouse._published(done[: i + 1]))
    marks.add({"validation_result": [r["dw_batch_id"] for r in rows if r["validation_status"]]})
    history = warehouse.store.log_rows(MART_LOG, MART_REFRESH, "refresh_id")
    for i, row in enumerate(history):
        if i + 1 == len(history) or history[i + 1]["refreshed_at"] > since:
            marks.add({name: [row["refresh_id"]] for name in mt.MART_NAMES})
            marks.add({name: versions_from(row["rollups"])["refreshes"] for name in mt.ROLLUPS})
    return marks


def source_marks(store: TableStore) -> Marks:
    """Every completed batch stays: later ones continue its ids."""
    rows = store.log_rows(SOURCE_LOG, LOAD_BATCH, "batch_id")
    marks = Marks(running={r["batch_id"] for r in rows if r["status"] == "STARTED"})
    done = [r["batch_id"] for r in rows if r["status"] == "COMPLETED"]
    marks.add({name: done for name in SOURCE_TABLES})
    return marks


def _sweep(store: TableStore, tables: list[str], marks: Marks, written_before: datetime) -> list[tuple[str, int]]:
    swept = []
    for name in tables:
        for folder in _children(store.spark, f"{store.root}/{name}"):
            label, _, number = folder.getPath().getName().partition("=")
            if label != "load" or not number.isdigit():
                continue
            version = int(number)
            if version in marks.running or version in marks.versions.get(name, ()):
                continue
            if _newest(store.spark, folder) <= written_before:
                _delete(store.spark, folder)
                swept.append((name, version))
    return sorted(swept)


def sweep_warehouse(warehouse: Warehouse, age: timedelta) -> list[tuple[str, int]]:
    """Remove what no state of the last ``age`` names; returns (table, version) of each folder."""
    written_before = utc_now() - age  # before the log is read: what starts now is younger
    return _sweep(warehouse.store, WAREHOUSE_TABLES, warehouse_marks(warehouse, warehouse.clock() - age), written_before)


def sweep_source(store: TableStore, age: timedelta) -> list[tuple[str, int]]:
    """The same for the landed and typed folders of failed batches."""
    written_before = utc_now() - age
    return _sweep(store, SOURCE_TABLES, source_marks(store), written_before)


def sweep_staging(spark: SparkSession, age: timedelta, clock: Clock = utc_now) -> list[str]:
    """Remove staging folders of other applications into which nothing was written for ``age``."""
    written_before, swept = clock() - age, []
    for folder in _children(spark, f"{shared_dir(spark)}/ledgerlake"):
        name = folder.getPath().getName()
        if name != spark.sparkContext.applicationId and _newest(spark, folder) <= written_before:
            _delete(spark, folder)
            swept.append(name)
    return sorted(swept)

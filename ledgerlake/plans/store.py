"""Versioned Parquet folders and small append-only logs.

A load writes each table below ``<table>/load=<id>`` and publishes it by
appending one log row that names the folders. A path is never overwritten while
somebody may read it, and the folders of a failed load are never looked at.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.measures import moment
from ledgerlake.operators.dims import ddl_fields
from ledgerlake.session import CODEC, drop, write_parts

Clock = Callable[[], datetime]


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root

    def path(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/load={version}"

    def write(self, df: DataFrame, table: str, version: int, partition_by: list[str] | None = None) -> None:
        self.write_parts([lambda: df], table, version, partition_by)

    def write_parts(
        self, parts: Iterable[Callable[[], DataFrame]], table: str, version: int, partition_by: list[str] | None = None
    ) -> None:
        """One version out of several frames, as :func:`ledgerlake.session.write_parts` does."""
        write_parts(self.spark, parts, self.path(table, version), "overwrite", partition_by or (), compression=CODEC)

    def read(self, table: str, versions: list[int], ddl: str) -> DataFrame:
        """Rows of the named versions; sizes come from the files, so the planner can size a broadcast."""
        if not versions:
            return self.spark.createDataFrame([], ddl)
        names = [field.split()[0] for field in ddl_fields(ddl)]
        paths = [self.path(table, v) for v in versions]
        rows = self.spark.read.schema(ddl).option("basePath", f"{self.root}/{table}").parquet(*paths)
        return rows.select(*names)

    def append_event(self, log: str, ddl: str, row: dict) -> None:
        """Add one state row. The newest row of an id is its current state."""
        number = len(self._events(log, ddl)) + 1
        cells = [F.lit(number).cast("long").alias("event_no")]
        for field in ddl_fields(ddl):
            name, kind = field.split(" ", 1)
            value = row.get(name)
            cell = moment(value) if isinstance(value, datetime) else F.lit(value)
            cells.append(cell.cast(kind).alias(name))
        self.spark.range(1).select(*cells).coalesce(1).write.mode("append").parquet(f"{self.root}/log/{log}")

    def log_rows(self, log: str, ddl: str, key: str) -> list[dict]:
        """Current state per id, on the driver: control data, a few rows per load."""
        latest = {event[key]: event for event in self._events(log, ddl)}
        return [latest[k] for k in sorted(latest)]

    def log(self, log: str, ddl: str, key: str) -> DataFrame:
        """The same as a DataFrame."""
        rows = self.log_rows(log, ddl, key)
        names = [field.split()[0] for field in ddl_fields(ddl)]
        if not rows:
            return self.spark.createDataFrame([], ddl)
        newest = F.col("event_no").isin([row["event_no"] for row in rows])
        return self._event_frame(log, ddl).where(newest).select(*names)

    def _event_frame(self, log: str, ddl: str) -> DataFrame:
        return self.spark.read.schema(f"event_no long, {ddl}").parquet(f"{self.root}/log/{log}")

    def _events(self, log: str, ddl: str) -> list[dict]:
        if not self.exists(f"{self.root}/log/{log}"):
            return []
        return sorted((r.asDict() for r in self._event_frame(log, ddl).collect()), key=lambda r: r["event_no"])

    def exists(self, path: str) -> bool:
        fs, jvm_path = self._open(path)
        return fs.exists(jvm_path)

    def numbers(self, path: str, column: str) -> set[int]:
        """The values of a partition column whose folders lie below ``path``."""
        fs, jvm_path = self._open(path)
        names = [s.getPath().getName() for s in fs.listStatus(jvm_path)] if fs.exists(jvm_path) else []
        return {int(n.removeprefix(f"{column}=")) for n in names if n.startswith(f"{column}=")}

    def drop(self, path: str) -> None:
        drop(self.spark, path)

    def _open(self, path: str):
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration()), jvm_path


def versions_text(versions: dict[str, list[int]]) -> str:
    return json.dumps(versions, sort_keys=True)


def versions_from(text: str | None) -> dict[str, list[int]]:
    return json.loads(text) if text else {}

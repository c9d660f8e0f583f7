"""Landing to typed source tables: one batch, published when its log row says COMPLETED."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators import typing as ty
from ledgerlake.plans.store import Clock, TableStore, utc_now
from ledgerlake.schemas import ACCOUNT_COLUMNS, LOAD_BATCH, PATTERN_COLUMNS, TAGGED, TRANSACTION_COLUMNS
from ledgerlake.session import run_together

LOG = "load_batch"
# Object -> (tagging function, typed columns, source object name).
OBJECTS = {
    "account": (ty.tag_accounts, ACCOUNT_COLUMNS, ty.ACCOUNT),
    "transaction": (ty.tag_transactions, TRANSACTION_COLUMNS, ty.TRANSACTION),
    "pattern": (ty.tag_patterns, PATTERN_COLUMNS, ty.PATTERN),
}


class LandingGateError(RuntimeError):
    """``wrong`` holds (found, expected) for each landing frame that stopped the batch."""

    def __init__(self, wrong: dict[str, tuple[int | None, int]]):
        super().__init__(f"landing rows differ (found, expected): {wrong}")
        self.wrong = wrong


@dataclass
class SourceTables:
    accounts: DataFrame
    transactions: DataFrame
    patterns: DataFrame
    rejected: DataFrame
    load_batch_id: int


def landing_counts(landing: dict[str, DataFrame]) -> DataFrame:
    """Rows per landing frame."""
    parts = [
        frame.agg(F.lit(name).alias("source_object"), F.count("*").alias("row_count"))
        for name, frame in landing.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def landing_gate(landing: dict[str, DataFrame], expected: dict[str, int]) -> None:
    """Stop the run when a landing frame does not hold the expected number of rows."""
    counted = {r["source_object"]: r["row_count"] for r in landing_counts(landing).collect()}
    wrong = {k: (counted.get(k), v) for k, v in expected.items() if counted.get(k) != v}
    if wrong:
        raise LandingGateError(wrong)


def load_source_batch(
    store: TableStore,
    landing: dict[str, DataFrame],
    dataset_name: str = "AML transfers",
    source_version: str = "1",
    clock: Clock = utc_now,
    expected_rows: dict[str, int] | None = None,
) -> int:
    """Land, gate, type and reject one batch; returns its id.

    A batch still STARTED from an earlier run is marked FAILED. Each landing frame
    is scanned once: valid rows and rejects go to two folders of one write.
    """
    history = store.log_rows(LOG, LOAD_BATCH, "batch_id")
    for row in history:
        if row["status"] == "STARTED":
            note = "replaced by a newer load before it finished"
            store.append_event(
                LOG, LOAD_BATCH, {**row, "status": "FAILED", "completed_at": clock(), "error_message": note}
            )
    batch_id = max([row["batch_id"] for row in history], default=0) + 1
    state = {
        "batch_id": batch_id,
        "dataset_name": dataset_name,
        "source_version": source_version,
        "started_at": clock(),
        "status": "STARTED",
    }
    store.append_event(LOG, LOAD_BATCH, state)
    try:
        if expected_rows:
            landing_gate(landing, expected_rows)
        splits = run_together(
            store.spark, [partial(_load_object, store, name, landing[name], batch_id) for name in OBJECTS]
        )
        for name, split in zip(OBJECTS, splits):
            state[f"{name}_loaded_rows"] = split.get(True, 0)
            state[f"{name}_landing_rows"] = sum(split.values())
        rejected = sum(split.get(False, 0) for split in splits)
    except Exception as error:
        failed = {"status": "FAILED", "completed_at": clock(), "error_message": str(error)}
        store.append_event(LOG, LOAD_BATCH, {**state, **failed})
        raise
    state |= {"rejected_rows": rejected, "status": "COMPLETED", "completed_at": clock()}
    store.append_event(LOG, LOAD_BATCH, state)
    return batch_id


def _load_object(store: TableStore, name: str, landing: DataFrame, batch_id: int) -> dict[bool, int]:
    """Write one tagged frame; returns rows per validity, counted from folder names and file footers."""
    tagged = OBJECTS[name][0](landing, batch_id).withColumn("is_valid", F.col("error_code").isNull())
    store.write(tagged, f"tagged_{name}", batch_id, ["is_valid"])
    return {r["is_valid"]: r["count"] for r in _tagged(store, name, batch_id).groupBy("is_valid").count().collect()}


def _tagged(store: TableStore, name: str, batch_id: int) -> DataFrame:
    return store.read(f"tagged_{name}", [batch_id], TAGGED[name])


def source_tables(store: TableStore, batch_id: int, earlier: list[int] | None = None) -> SourceTables:
    """Typed tables and rejects of a batch. ``is_valid`` is a folder, so each side reads only its files.

    With ``earlier`` batches, whose ids the batch continues, their transfers, patterns and
    rejects belong to the source, too, which keeps the name of the first. Accounts are the
    newest snapshot.
    """
    batches = [*(earlier or []), batch_id]
    typed, rejected = {}, None
    for name, (_, columns, source_object) in OBJECTS.items():
        tagged = store.read(f"tagged_{name}", [batch_id] if name == "account" else batches, TAGGED[name])
        typed[name] = tagged.where("is_valid").select(columns)
        bad = ty.rejects(tagged.where("not is_valid"), source_object)
        rejected = bad if rejected is None else rejected.unionByName(bad)
    return SourceTables(typed["account"], typed["transaction"], typed["pattern"], rejected, batches[0])


def completed_batches(store: TableStore) -> list[int]:
    return [r["batch_id"] for r in store.log_rows(LOG, LOAD_BATCH, "batch_id") if r["status"] == "COMPLETED"]


def continued(landing: dict[str, DataFrame], store: TableStore, batches: list[int]) -> dict[str, DataFrame]:
    """Landing frames whose ids go on after those of the given batches."""
    out = {}
    for name, frame in landing.items():
        held = store.read(f"tagged_{name}", batches, TAGGED[name])
        last = held.agg(F.max("source_row_id")).first()[0] or 0
        out[name] = frame.withColumn("landing_row_id", F.col("landing_row_id") + F.lit(last))
    return out


def unprocessed_landing(landing: dict[str, DataFrame], store: TableStore, batch_id: int) -> DataFrame:
    """Landing rows that reached neither the typed table nor the rejects; 0 when landing can be emptied."""
    result = None
    for name in OBJECTS:
        done = _tagged(store, name, batch_id).select(F.col("source_row_id").alias("landing_row_id"))
        left = (
            landing[name]
            .select("landing_row_id")
            .join(done, "landing_row_id", "left_anti")
            .agg(F.lit(name).alias("source_object"), F.count("*").alias("row_count"))
        )
        result = left if result is None else result.unionByName(left)
    return result

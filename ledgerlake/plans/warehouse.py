"""The warehouse load: FULL or INCREMENTAL, idempotent, published by its log row."""

from __future__ import annotations

from dataclasses import replace
from functools import partial, reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.functions.measures import moment
from ledgerlake.operators import dims as dm
from ledgerlake.operators import facts as fx
from ledgerlake.operators import marts as mt
from ledgerlake.operators import recon
from ledgerlake.operators.growth import FINGERPRINT, fingerprints, merge_on_read, touched_buckets, within
from ledgerlake.operators.held import marks, unheld
from ledgerlake.operators.reporting import reporting_views
from ledgerlake.operators.scd2 import account_snapshot, type2_delta
from ledgerlake.plans.source_load import SourceTables
from ledgerlake.plans.store import Clock, TableStore, utc_now, versions_from, versions_text
from ledgerlake.schemas import (
    DIM_SCHEMAS,
    DW_BATCH,
    DW_REJECT,
    FACT_PATTERN,
    FACT_TRANSACTION,
    VALIDATION,
)
from ledgerlake.session import CODEC, passing_stages, run_together, slices, stage

LOG = "dw_batch"
MART_LOG = "mart_refresh"
MART_REFRESH = "refresh_id long, refreshed_at timestamp_ntz, dw_batch_id long, rollups string"
PROCESS = "AML_SOURCE_TO_DW"
FACT_SCHEMAS = {
    "fact_transaction": FACT_TRANSACTION,
    "fact_pattern_transaction": FACT_PATTERN,
    "dw_rejected_row": DW_REJECT,
}


#: Dimensions that grow by deltas, with the key that tells which row a delta replaces.
GROWING = {"dim_bank": "bank_key", "dim_entity": "entity_key", "dim_account": "account_key"}
#: Deltas read beside a base; the next change folds them into a new base.
FOLD_AFTER = 8
PRINTS = "account_fingerprint"
#: Rows per currency that validations have scanned so far.
SOURCE_TOTALS, FACT_TOTALS = "recon_source", "recon_fact"


class StaleSourceError(RuntimeError):
    """The source was reloaded and hands out its ids anew; old watermarks mean nothing."""


def between(df: DataFrame, key: str, low: int, high: int) -> DataFrame:
    return df.where(F.col(key).between(low, high))


class Warehouse:
    def __init__(self, store: TableStore, clock: Clock = utc_now):
        self.store = store
        self.spark = store.spark
        self.clock = clock

    # -- state -----------------------------------------------------------------

    def batch_rows(self) -> list[dict]:
        return self.store.log_rows(LOG, DW_BATCH, "dw_batch_id")

    def batches(self) -> DataFrame:
        return self.store.log(LOG, DW_BATCH, "dw_batch_id")

    def _published(self, rows: list[dict]) -> dict[str, list[int]]:
        """Folders of every table: each completed load names those it added or replaced.

        A trailing plus marks a delta, which is read beside the folders before it.
        """
        versions: dict[str, list[int]] = {}
        for row in rows:
            if row["status"] == "COMPLETED":
                for name, added in versions_from(row["table_versions"]).items():
                    table = name.rstrip("+")
                    grows = name != table or table in FACT_SCHEMAS
                    versions[table] = versions.get(table, []) + added if grows else added
        return versions

    def _read(self, table: str, versions: dict[str, list[int]]) -> DataFrame:
        ddl = DIM_SCHEMAS.get(table) or FACT_SCHEMAS[table]
        held = versions.get(table, [])
        if table in GROWING and len(held) > 1:
            base, *deltas = (self.store.read(table, [v], ddl) for v in held)
            return merge_on_read(base, deltas, GROWING[table])
        if held or table in FACT_SCHEMAS:
            return self.store.read(table, held, ddl)
        seed = dm.unknown_member(self.spark, table)
        if table == "dim_time":
            seed = seed.unionByName(dm.time_dimension(self.spark))
        return seed

    def tables(self) -> dict[str, DataFrame]:
        """Every published dimension and fact."""
        versions = self._published(self.batch_rows())
        return {name: self._read(name, versions) for name in [*DIM_SCHEMAS, *FACT_SCHEMAS]}

    # -- load ------------------------------------------------------------------

    def watermark_window(self, source: SourceTables, load_type: str, rows: list[dict]) -> dict[str, int]:
        """Id ranges of this load. Low is the last completed high plus one, or 1 for FULL."""
        done = [r for r in rows if r["status"] == "COMPLETED"] if load_type == "INCREMENTAL" else []
        last = max((r["source_high_watermark"] for r in done), default=0)
        last_pattern = max((r["pattern_high_watermark"] for r in done), default=0)
        high = source.transactions.agg(F.max("source_transaction_id")).first()[0] or 0
        high_pattern = source.patterns.agg(F.max("pattern_transaction_id")).first()[0] or 0
        return {
            "source_low_watermark": last + 1,
            "source_high_watermark": high,
            "pattern_low_watermark": last_pattern + 1,
            "pattern_high_watermark": high_pattern,
        }

    def load(self, source: SourceTables, load_type: str = "INCREMENTAL") -> int:
        """Run one load and return its id. A failure is logged and raised again; nothing of it is published."""
        load_type = load_type.strip().upper()
        if load_type not in ("FULL", "INCREMENTAL"):
            raise ValueError(f"load type is FULL or INCREMENTAL, not {load_type}")
        rows = self.batch_rows()
        versions = self._published(rows)
        batch_id = max([r["dw_batch_id"] for r in rows], default=0) + 1
        state = {
            "dw_batch_id": batch_id,
            "process_name": PROCESS,
            "load_type": load_type,
            "status": "STARTED",
            "started_at": self.clock(),
            "source_load_batch_id": source.load_batch_id,
            **self.watermark_window(source, load_type, rows),
            **{name: 0 for name in _COUNTERS},
        }
        self.store.append_event(LOG, DW_BATCH, state)
        try:
            loaded = {r["source_load_batch_id"] for r in rows if r["status"] == "COMPLETED"}
            if versions.get("fact_transaction") and loaded - {source.load_batch_id}:
                raise StaleSourceError("source was reloaded: reset the warehouse and run a FULL load")
            with passing_stages(self.spark):
                held, versions = versions, self._load_tables(source, state, versions)
        except Exception as error:
            failed = {"status": "FAILED", "completed_at": self.clock(), "error_message": str(error)}
            self.store.append_event(LOG, DW_BATCH, {**state, **failed})
            raise
        state |= {"status": "COMPLETED", "completed_at": self.clock()}
        added = {f"{t}+" if t in GROWING and len(v) > 1 else t: [batch_id] for t, v in versions.items() if v != held.get(t)}
        state["table_versions"] = versions_text(added)
        self.store.append_event(LOG, DW_BATCH, state)
        return batch_id

    def _load_tables(self, source: SourceTables, state: dict, held: dict[str, list[int]]) -> dict[str, list[int]]:
        batch_id = state["dw_batch_id"]
        versions = dict(held)

        def publish(table: str, frame: DataFrame) -> DataFrame:
            self.store.write(frame, table, batch_id)
            versions[table] = [batch_id]
            return self._read(table, versions)

        low, high = state["source_low_watermark"], state["source_high_watermark"]
        low_p, high_p = state["pattern_low_watermark"], state["pattern_high_watermark"]
        transactions = between(source.transactions, "source_transaction_id", low, high)
        patterns = between(source.patterns, "pattern_transaction_id", low_p, high_p)
        dims = {name: self._read(name, versions) for name in DIM_SCHEMAS}

        # Only keys in buckets whose fingerprint differs from the last load's are looked at.
        prints = stage(fingerprints(source.accounts), "fingerprints")
        touched = None
        if versions.get(PRINTS):
            touched = touched_buckets(self.store.read(PRINTS, versions[PRINTS], FINGERPRINT), prints)
        changed = touched is None or any(touched.values())
        near = lambda frame, kind: frame if touched is None else frame.where(within(kind, touched[kind]))

        def grow(table: str, delta: DataFrame) -> DataFrame:
            """Add a delta, or write a new base if there is none yet or too many deltas lie beside it."""
            if not versions.get(table) or len(versions[table]) > FOLD_AFTER:
                return publish(table, merge_on_read(self._read(table, versions), [delta], GROWING[table]))
            self.store.write(delta, table, batch_id)
            versions[table] = [*versions[table], batch_id]
            return self._read(table, versions)

        # Members of the delta, banks and entities do not depend on each other. An
        # unchanged dimension keeps its version.
        tasks = []
        if changed:
            for kind, collapse in (("bank", dm.bank_source), ("entity", dm.entity_source)):
                incoming = collapse(near(source.accounts, kind))
                tasks.append(partial(self._merge_type1, kind, incoming, near(dims[f"dim_{kind}"], kind), dims, state, grow))
        if low <= high or low_p <= high_p:
            tasks.append(partial(self._add_members, transactions, patterns, dims, state, publish))
        run_together(self.spark, tasks)
        if changed:
            snapshot = account_snapshot(near(source.accounts, "account"), dims["dim_bank"], dims["dim_entity"])
            held_accounts = near(dims["dim_account"], "account")
            delta, state["account_rows_affected"] = type2_delta(dims["dim_account"], snapshot, state["started_at"], held_accounts)
            if delta is not None:
                dims["dim_account"] = grow("dim_account", delta)
            self.store.write(prints, PRINTS, batch_id)
            versions[PRINTS] = [batch_id]
        for name in DIM_SCHEMAS:
            if name not in versions:
                dims[name] = publish(name, dims[name])

        # Facts: only ids in the window that are not there yet.
        reject_frames = []
        if low <= high:
            frame, fresh = self._append_transactions(transactions, dims, state, versions)
            reject_frames += [fx.unknown_transaction_rejects(frame), fx.amount_rejects(fresh, batch_id)]
        if low_p <= high_p:
            frame = self._append_patterns(patterns, dims, state, versions)
            reject_frames.append(fx.unknown_pattern_rejects(frame))
        if reject_frames:
            rejects = reject_frames[0]
            for extra in reject_frames[1:]:
                rejects = rejects.unionByName(extra)
            self.store.write(rejects, "dw_rejected_row", batch_id)
            versions["dw_rejected_row"] = [*versions.get("dw_rejected_row", []), batch_id]
            state["rejected_rows"] = self.store.read("dw_rejected_row", [batch_id], DW_REJECT).count()
        return versions

    def _merge_type1(self, kind, incoming, held, dims, state, grow) -> None:
        dim = f"dim_{kind}"
        delta, state[f"{kind}_rows_affected"] = dm.type1_delta(dims[dim], incoming, f"{kind}_id", f"{kind}_key", held)
        if delta is not None:
            dims[dim] = grow(dim, delta)

    def _add_members(self, transactions, patterns, dims, state, publish) -> None:
        members = stage(dm.reference_members(transactions, patterns), "members")
        days = (
            members.where("kind = 'date'")
            .select(F.col("value").cast("date").alias("full_date"))
            .join(dims["dim_date"].select("full_date"), "full_date", "left_anti")
        )
        fresh_days = stage(dm.date_dimension(days), "days")
        if not fresh_days.isEmpty():
            dims["dim_date"] = publish("dim_date", dims["dim_date"].unionByName(fresh_days))
        fresh = dm.new_reference_rows(members, dims)
        if fresh is None:
            return
        added = {r["kind"]: r["count"] for r in fresh.groupBy("kind").count().collect()}
        for kind, (dim, key, name) in dm.REFERENCE_DIMS.items():
            if added.get(kind):
                rows = fresh.where(F.col("kind") == kind).select(F.col("key").alias(key), F.col("value").alias(name))
                dims[dim] = publish(dim, dims[dim].unionByName(dm.conform(rows, DIM_SCHEMAS[dim])))
        state["currency_rows_affected"] = added.get("currency", 0)
        state["payment_format_rows_affected"] = added.get("format", 0)

    def _append_transactions(self, delta, dims, state, versions) -> tuple[DataFrame, DataFrame]:
        """The rows of this load in the fact, and the delta they were made of."""
        low, high = state["source_low_watermark"], state["source_high_watermark"]
        # A refused amount is refused once; it must not come up as new in every rerun.
        fresh = self._unheld(
            delta,
            "source_transaction_id",
            versions,
            (low, high),
            {"fact_transaction": ("transaction_key", None), "dw_rejected_row": ("source_key", F.col("error_code") == fx.NON_POSITIVE)},
        )
        batch_id = state["dw_batch_id"]

        def keyed(part: DataFrame) -> DataFrame:
            rows = fx.fact_transactions(part, dims, batch_id, fx.hot_parties(part))
            # rebalance: adaptive execution splits a month that outgrows one task and merges small ones.
            return rows.hint("rebalance", "txn_month")

        # The lookups by account shuffle whole rows; on disk there is one slice of them at a time.
        parts = [partial(keyed, part) for part in slices(fresh, "source_transaction_id")]
        self.store.write_parts(parts, "fact_transaction", batch_id, ["txn_month"])
        return self._published_delta("fact_transaction", state, versions, "transaction_rows_inserted"), fresh

    def _unheld(self, delta, key, versions, ids: tuple[int, int], tables: dict) -> DataFrame:
        """The delta without ids in the key columns of the named tables, each with an optional condition.

        The id range reaches the Parquet scans, so a true delta reads no old row groups.
        """
        parts = []
        for table, (column, where) in tables.items():
            if versions.get(table):
                rows = between(self._read(table, versions), column, *ids)
                parts.append(marks(rows if where is None else rows.where(where), column))
        if not parts:
            return delta
        fresh = unheld(delta, key, reduce(DataFrame.unionByName, parts))
        # Written, so that the comparison runs once for the hot-key count, the load and the rejects.
        return delta if fresh is delta else stage(fresh, "delta", compression=CODEC)

    def _append_patterns(self, delta, dims, state, versions) -> DataFrame:
        ids = state["pattern_low_watermark"], state["pattern_high_watermark"]
        held = {"fact_pattern_transaction": ("pattern_transaction_key", None)}
        fresh = self._unheld(delta, "pattern_transaction_id", versions, ids, held)
        rows = fx.fact_patterns(fresh, dims, state["dw_batch_id"], fx.hot_parties(fresh))
        self.store.write(rows, "fact_pattern_transaction", state["dw_batch_id"])
        return self._published_delta("fact_pattern_transaction", state, versions, "pattern_rows_inserted")

    def _published_delta(self, table: str, state: dict, versions: dict, counter: str) -> DataFrame:
        batch_id = state["dw_batch_id"]
        frame = self.store.read(table, [batch_id], FACT_SCHEMAS[table])
        state[counter] = frame.count()
        if state[counter]:
            versions[table] = [*versions.get(table, []), batch_id]
        return frame

    # -- after the load ----------------------------------------------------------

    def validate(self, source: SourceTables, full: bool = False) -> str:
        """Nine checks for the latest completed load; stores them and the verdict.

        Totals of what earlier validations have scanned are kept: facts are only appended, so new
        loads are scanned alone, and of the source the ids behind the last mark. The number of source
        rows up to that mark is counted anew; if it has changed, the whole source is scanned. After a
        FULL load with kept totals, or with ``full``, both sides are scanned whole.
        """
        done = [r for r in self.batch_rows() if r["status"] == "COMPLETED"]
        if not done:
            raise RuntimeError("no completed load to validate")
        latest = done[-1]
        t = self.tables()
        totals, added = self._totals(source, done, full)
        checks = recon.warehouse_checks(
            source.transactions,
            source.patterns,
            source.accounts,
            t["fact_transaction"],
            t["fact_pattern_transaction"],
            t["dim_account"],
            t["dim_currency"],
            t["dw_rejected_row"],
            totals,
        )
        batch_id = latest["dw_batch_id"]
        rows = checks.withColumns(
            {
                "dw_batch_id": F.lit(batch_id),
                "validation_result_id": F.col("position") + (batch_id - 1) * 9,
                "checked_at": moment(self.clock()),
            }
        )
        self.store.write(dm.conform(rows, VALIDATION), "validation_result", batch_id)
        failed = self._validations([batch_id]).where("status = 'FAILED'").count()
        verdict = "PASSED" if failed == 0 else "FAILED"
        named = versions_text({**versions_from(latest["table_versions"]), **added})
        self.store.append_event(LOG, DW_BATCH, {**latest, "validation_status": verdict, "table_versions": named})
        return verdict

    def _totals(self, source: SourceTables, done: list[dict], full: bool):
        """Rows per currency of source and fact, and the folders of totals to publish with the verdict."""
        latest, versions, added = done[-1], self._published(done), {}
        batch_id, high = latest["dw_batch_id"], latest["source_high_watermark"]
        full = full or (latest["load_type"] == "FULL" and bool(versions.get(FACT_TOTALS)))

        def together(table: str, key: str, held: list[int], fresh: DataFrame | None, keep: DataFrame | None) -> DataFrame:
            """Kept totals and new ones; ``keep`` is what of the new ones will not change any more."""
            if keep is not None and not full:
                self.store.write(keep, table, batch_id)
                added[f"{table}+" if held else table] = [batch_id]
            parts = [self.spark.read.parquet(self.store.path(table, v)) for v in held] + ([] if fresh is None else [fresh])
            return stage(recon.added_up(reduce(DataFrame.unionByName, parts), key), "recon")

        def of_source() -> DataFrame:
            rows, number = source.transactions, F.col("source_transaction_id")
            held = [] if full else versions.get(SOURCE_TOTALS, [])
            if held:
                mark = max(r["source_high_watermark"] for r in done if r["dw_batch_id"] in held)
                known = self.spark.read.parquet(*[self.store.path(SOURCE_TOTALS, v) for v in held])
                counted = known.agg(F.sum(F.col("source_rows") + F.col("source_refused"))).first()[0] or 0
                if rows.where(number <= mark).count() == counted:
                    rows = rows.where(number > mark)
                else:
                    held = []
            # Rows that no load has taken up yet count now and are not kept.
            fresh = stage(recon.source_by_currency(rows.withColumn("_late", number > high), "_late"), "recon")
            keep = None if batch_id in versions.get(SOURCE_TOTALS, []) else fresh.where("not _late").drop("_late")
            return together(SOURCE_TOTALS, "currency_name", held, fresh.drop("_late"), keep)

        def of_fact() -> DataFrame:
            held = [] if full else versions.get(FACT_TOTALS, [])
            news = [v for v in versions.get("fact_transaction", []) if v > max(held, default=0)]
            if held and not news:
                return together(FACT_TOTALS, "currency_key", held, None, None)
            fresh = stage(recon.fact_by_currency(self.store.read("fact_transaction", news, FACT_TRANSACTION)), "recon")
            return together(FACT_TOTALS, "currency_key", held, fresh, fresh)

        return tuple(run_together(self.spark, [of_source, of_fact])), added

    def _validations(self, batch_ids: list[int]) -> DataFrame:
        return self.store.read("validation_result", batch_ids, VALIDATION)

    def validations(self) -> DataFrame:
        return self._validations([r["dw_batch_id"] for r in self.batch_rows() if r["validation_status"]])

    def refresh_marts(self) -> int:
        """Bring all marts up to the latest load; returns the refresh id.

        Facts are only ever appended, so each load's rollups stay true. A refresh reads the facts
        of the loads since the last one, writes their rollups and combines all kept ones; without
        news no fact is read. Names come from the dimensions as they are now. When more than
        FOLD_AFTER rollups lie side by side, the next ones are written as one with all of them.
        """
        done = [r for r in self.batch_rows() if r["status"] == "COMPLETED"]
        history = self.store.log_rows(MART_LOG, MART_REFRESH, "refresh_id")
        refresh_id = max([r["refresh_id"] for r in history], default=0) + 1
        covered = history[-1]["dw_batch_id"] if history else 0
        kept = versions_from(history[-1]["rollups"])["refreshes"] if history else []
        versions = self._published(done)
        news = {t: [v for v in versions.get(t, []) if v > covered] for t in ("fact_transaction", "fact_pattern_transaction")}
        if not history or any(news.values()):
            fresh = mt.load_rollups(*(self.store.read(t, news[t], FACT_SCHEMAS[t]) for t in news))
            if len(kept) > FOLD_AFTER:
                fresh = {n: mt.combined(n, f.unionByName(self._rollup(n, kept))) for n, f in fresh.items()}
                kept = []
            run_together(self.spark, [partial(self.store.write, frame, name, refresh_id) for name, frame in fresh.items()])
            kept = [*kept, refresh_id]
        rollups = {name: self._rollup(name, kept) for name in mt.ROLLUPS}
        if len(kept) > 1:
            rollups = {name: mt.combined(name, frame) for name, frame in rollups.items()}
        dims = {name: self._read(name, versions) for name in DIM_SCHEMAS}
        marts = mt.all_marts(dims, rollups)
        run_together(self.spark, [partial(self.store.write, frame, name, refresh_id) for name, frame in marts.items()])
        row = {
            "refresh_id": refresh_id,
            "refreshed_at": self.clock(),
            "dw_batch_id": done[-1]["dw_batch_id"],
            "rollups": versions_text({"refreshes": kept}),
        }
        self.store.append_event(MART_LOG, MART_REFRESH, row)
        return refresh_id

    def _rollup(self, name: str, refreshes: list[int]) -> DataFrame:
        return self.spark.read.parquet(*[self.store.path(name, r) for r in refreshes])

    def marts(self) -> dict[str, DataFrame]:
        """The marts of the latest refresh."""
        history = self.store.log_rows(MART_LOG, MART_REFRESH, "refresh_id")
        if not history:
            raise RuntimeError("marts were never refreshed")
        latest = history[-1]["refresh_id"]
        return {name: self.spark.read.parquet(self.store.path(name, latest)) for name in mt.MART_NAMES}

    def reports(self) -> dict[str, DataFrame]:
        return reporting_views(self.tables(), self.marts(), self.batches(), self.validations())

    def reset(self) -> "Warehouse":
        """Start over in an empty folder; the old one and the source stay untouched."""
        empty = TableStore(self.spark, f"{self.store.root}-reset-{int(utc_now().timestamp() * 1e6)}")
        return Warehouse(empty, self.clock)


_COUNTERS = [
    "bank_rows_affected",
    "entity_rows_affected",
    "account_rows_affected",
    "currency_rows_affected",
    "payment_format_rows_affected",
    "transaction_rows_inserted",
    "pattern_rows_inserted",
    "rejected_rows",
]


def source_upto(source: SourceTables, high: int) -> SourceTables:
    """The source as it looked before ids above ``high`` arrived."""
    return replace(
        source,
        transactions=source.transactions.where(F.col("source_transaction_id") <= high),
        patterns=source.patterns.where(F.col("pattern_transaction_id") <= high),
    )

"""Mark and sweep: what readers, running loads and later loads need stays."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F
from test_load import _landing, _txn, _warehouse

from ledgerlake.plans import retention
from ledgerlake.plans import source_load as sl
from ledgerlake.plans.store import TableStore
from ledgerlake.plans.warehouse import LOG
from ledgerlake.plans.workspace import step_clock
from ledgerlake.schemas import DW_BATCH
from ledgerlake.session import fresh_path

NOW, HOUR = timedelta(0), timedelta(hours=1)


@pytest.fixture(scope="module")
def source(spark):
    store = TableStore(spark, fresh_path(spark, "retained-source"))
    sl.load_source_batch(store, _landing(spark, [_txn(n) for n in range(1, 6)]), clock=step_clock())
    return sl.source_tables(store, 1)


def folders(store: TableStore, tables) -> set:
    found = set()
    for table in tables:
        for status in retention._children(store.spark, f"{store.root}/{table}"):
            found.add((table, int(status.getPath().getName().split("=")[1])))
    return found


def broken(source):
    return replace(source, transactions=source.transactions.withColumn("payment_format", F.raise_error(F.lit("unreadable")).cast("string")))


def test_failed_load_goes_and_published_tables_stay(spark, source):
    warehouse = _warehouse(spark)
    warehouse.load(source, "FULL")
    before = {name: sorted(map(repr, frame.collect())) for name, frame in warehouse.tables().items()}
    with pytest.raises(Exception, match="unreadable"):
        warehouse.load(broken(source), "FULL")
    warehouse.store.write(spark.range(3), "dim_bank", 2)  # what a load that broke later would have left
    tables = retention.WAREHOUSE_TABLES
    assert any(version == 2 for _, version in folders(warehouse.store, tables))
    assert retention.sweep_warehouse(warehouse, HOUR) == []  # all of it is younger
    swept = retention.sweep_warehouse(warehouse, NOW)
    assert swept and {version for _, version in swept} == {2}
    assert {version for _, version in folders(warehouse.store, tables)} == {1}
    assert before == {name: sorted(map(repr, frame.collect())) for name, frame in warehouse.tables().items()}
    assert warehouse.load(source, "FULL") == 3 and warehouse.batch_rows()[-1]["status"] == "COMPLETED"
    # A rerun that inserts nothing leaves an empty folder which no row names.
    assert retention.sweep_warehouse(warehouse, NOW) == [("fact_transaction", 3)]
    assert retention.sweep_warehouse(warehouse, NOW) == []


def test_a_reader_keeps_the_state_it_opened_for_the_given_age(spark, source):
    warehouse = _warehouse(spark)
    warehouse.load(source, "FULL")
    warehouse.refresh_marts()
    reader = warehouse.marts()["mart_daily_transaction"]
    rows = reader.count()
    warehouse.refresh_marts()  # replaces every mart
    replaced = warehouse.store.log_rows("mart_refresh", retention.MART_REFRESH, "refresh_id")[-1]["refreshed_at"]
    early = retention.warehouse_marks(warehouse, replaced - timedelta(seconds=1))
    assert early.versions["mart_daily_transaction"] == {1, 2}
    assert retention.warehouse_marks(warehouse, replaced).versions["mart_daily_transaction"] == {2}
    assert retention.sweep_warehouse(warehouse, HOUR) == [] and reader.count() == rows
    swept = retention.sweep_warehouse(warehouse, NOW)
    assert {("mart_daily_transaction", 1), ("mart_kpi_overview", 1)} <= set(swept)
    assert {version for _, version in swept} == {1}
    assert warehouse.marts()["mart_daily_transaction"].count() == rows
    assert warehouse.refresh_marts() == 3  # the kept rollups are all there


def test_folders_of_a_running_load_stay(spark, source):
    warehouse = _warehouse(spark)
    warehouse.load(source, "FULL")
    state = {**warehouse.batch_rows()[-1], "dw_batch_id": 2, "status": "STARTED", "completed_at": None}
    warehouse.store.append_event(LOG, DW_BATCH, state)
    warehouse.store.write(spark.range(3), "fact_transaction", 2)
    warehouse.store.write(spark.range(3), "fact_transaction", 7)  # nobody's
    assert retention.sweep_warehouse(warehouse, NOW) == [("fact_transaction", 7)]


def test_source_keeps_completed_batches_and_other_tables(spark):
    store = TableStore(spark, fresh_path(spark, "swept-source"))
    landing = _landing(spark, [_txn(1), _txn(2)])
    sl.load_source_batch(store, landing, clock=step_clock())
    bad = {**landing, "transaction": landing["transaction"].withColumn("is_laundering_text", F.raise_error(F.lit("lost")).cast("string"))}
    with pytest.raises(Exception, match="lost"):
        sl.load_source_batch(store, bad, clock=step_clock())
    sl.load_source_batch(store, landing, clock=step_clock())
    store.write(spark.range(3), "somebody_elses", 2)
    swept = retention.sweep_source(store, NOW)
    assert swept and all(table in retention.SOURCE_TABLES and version == 2 for table, version in swept)
    assert folders(store, ["somebody_elses"]) == {("somebody_elses", 2)}
    assert [sl.source_tables(store, batch).transactions.count() for batch in (1, 3)] == [2, 2]


def test_an_empty_store_has_nothing_to_sweep(spark):
    assert retention.sweep_warehouse(_warehouse(spark), NOW) == []
    assert retention.sweep_source(TableStore(spark, fresh_path(spark, "empty")), NOW) == []


def test_staging_of_other_applications(spark, monkeypatch):
    shared = fresh_path(spark, "shared")
    monkeypatch.setattr(retention, "shared_dir", lambda _: shared)
    own = spark.sparkContext.applicationId
    for app in (own, "gone"):
        spark.range(5).write.parquet(f"{shared}/ledgerlake/{app}/step")
    assert retention.sweep_staging(spark, HOUR) == []
    assert retention.sweep_staging(spark, NOW) == ["gone"]
    assert spark.read.parquet(f"{shared}/ledgerlake/{own}/step").count() == 5

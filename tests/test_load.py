"""Warehouse loads over a hand-written source: windows, idempotency, rejects, failures."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import recon
from ledgerlake.plans import source_load as sl
from ledgerlake.plans.source_load import SourceTables
from ledgerlake.plans.store import TableStore
from ledgerlake.plans.warehouse import StaleSourceError, Warehouse, source_upto
from ledgerlake.plans.workspace import step_clock
from ledgerlake.schemas import ACCOUNT_FIELDS, LOAD_BATCH, PATTERN_FIELDS, TRANSACTION_FIELDS
from ledgerlake.session import fresh_path


def _txn(n, bank="1", account="A", to_bank="2", to="B", paid="10", got="10", cur="Euro", rec="Euro", fmt="ACH", label="0", day="01"):
    return (n, f"2022/09/{day} 10:{n:02d}", bank, account, to_bank, to, got, rec, paid, cur, fmt, label)


def _landing(spark, transactions, patterns=(), accounts=None):
    accounts = accounts or [
        (1, "Bank One", "01", "a", "e1", "Corp"),
        (2, "Bank Two", "2", "b", "", ""),
        (3, "Bank One", "1", "c", "e1", "Corp"),
    ]
    ddl = lambda fields: "landing_row_id long, " + ", ".join(f"{f} string" for f in fields)
    return {
        "account": spark.createDataFrame(accounts, ddl(ACCOUNT_FIELDS)),
        "transaction": spark.createDataFrame(transactions, ddl(TRANSACTION_FIELDS)),
        "pattern": spark.createDataFrame(list(patterns), ddl(PATTERN_FIELDS)),
    }


@pytest.fixture(scope="module")
def source(spark):
    transactions = [
        _txn(1),
        _txn(2, account="C", label="1", cur="Yen", rec="Euro", paid="8", got="4"),
        _txn(3, to_bank="1", to="A"),  # self-transfer
        _txn(4, account="NOBODY", day="02"),  # account not in the master
        _txn(5, paid="0"),  # stays in the source, not in the fact
        _txn(6, fmt="Wire", day="04"),
        _txn(7, bank="bad"),
    ]
    patterns = [(1, "1", "CYCLE", "CYCLE: Max 3 hops", "1", *_txn(2, account="C", label="1")[1:])]
    store = TableStore(spark, fresh_path(spark, "test-source"))
    batch = sl.load_source_batch(store, _landing(spark, transactions, patterns), clock=step_clock())
    return sl.source_tables(store, batch), store


def _warehouse(spark) -> Warehouse:
    return Warehouse(TableStore(spark, fresh_path(spark, "test-dw")), step_clock())


@pytest.fixture(scope="module")
def loaded(spark, source):
    warehouse = _warehouse(spark)
    warehouse.load(source_upto(source[0], 4), "FULL")
    warehouse.load(source[0], "incremental ")
    warehouse.load(source[0], "INCREMENTAL")
    warehouse.load(source[0], "FULL")
    return warehouse


def test_source_balance(source):
    row = source[1].log_rows(sl.LOG, LOAD_BATCH, "batch_id")[0]
    assert (row["transaction_landing_rows"], row["transaction_loaded_rows"], row["rejected_rows"]) == (7, 6, 1)
    assert row["status"] == "COMPLETED" and row["completed_at"] > row["started_at"]


def test_windows_and_inserted_rows(loaded):
    rows = loaded.batch_rows()
    window = [(r["load_type"], r["source_low_watermark"], r["source_high_watermark"]) for r in rows]
    assert window == [("FULL", 1, 4), ("INCREMENTAL", 5, 6), ("INCREMENTAL", 7, 6), ("FULL", 1, 6)]
    # id 5 has a zero amount; the rerun of FULL finds everything in place.
    assert [r["transaction_rows_inserted"] for r in rows] == [4, 1, 0, 0]
    assert [r["pattern_rows_inserted"] for r in rows] == [1, 0, 0, 0]
    assert [r["account_rows_affected"] for r in rows] == [3, 0, 0, 0]
    assert all(r["status"] == "COMPLETED" for r in rows)


def test_fact_rows(loaded):
    t = loaded.tables()
    facts = {r.transaction_key: r for r in t["fact_transaction"].collect()}
    assert sorted(facts) == [1, 2, 3, 4, 6]
    assert facts[2].is_cross_currency and facts[2].implied_exchange_rate == Decimal("0.500000000000")
    assert facts[1].implied_exchange_rate is None
    assert facts[3].is_self_transfer and not facts[3].is_cross_bank
    assert facts[4].from_account_key == -1 and facts[4].from_entity_key == -1 and facts[4].from_bank_key == 1
    assert facts[1].to_account_key != -1 and facts[1].to_entity_key == -1  # account without entity
    assert (facts[6].date_key, facts[6].time_key, facts[6].dw_batch_id) == (20220904, 1006, 2)


def test_dimensions_grow_and_keys_stay(loaded):
    t = loaded.tables()
    formats = {r.payment_format: r.payment_format_key for r in t["dim_payment_format"].collect()}
    assert formats == {"Unknown": -1, "ACH": 1, "Wire": 2}
    assert sorted(r.date_key for r in t["dim_date"].collect()) == [-1, 20220901, 20220902, 20220904]
    assert t["dim_time"].count() == 1441
    for dim in ("dim_date", "dim_time", "dim_currency", "dim_payment_format", "dim_pattern_type", "dim_bank", "dim_entity", "dim_account"):
        assert t[dim].where(F.col(t[dim].columns[0]) == -1).count() == 1


def test_rejects_name_row_and_reason(loaded):
    rows = [(r.dw_batch_id, r.source_key, r.error_code) for r in loaded.tables()["dw_rejected_row"].collect()]
    assert sorted(rows) == [
        (1, 4, "UNKNOWN_DIMENSION_KEY"),
        (2, 5, "NON_POSITIVE_AMOUNT"),  # once, however often the load is rerun
    ]


def test_validation_reports_what_is_wrong(loaded, source):
    assert loaded.validate(source[0]) == "FAILED"
    failed = {r.check_name for r in loaded.validations().where("status = 'FAILED'").collect()}
    assert failed == {"UNKNOWN_DIMENSION_LOOKUP"}  # a refused amount is no difference


def test_clean_source_passes_and_marts_add_up(spark):
    transactions = [_txn(1), _txn(2, label="1", fmt="Cash"), _txn(3, account="C", day="03")]
    store = TableStore(spark, fresh_path(spark, "test-source"))
    batch = sl.load_source_batch(store, _landing(spark, transactions), expected_rows={"transaction": 3})
    clean = sl.source_tables(store, batch)
    warehouse = _warehouse(spark)
    warehouse.load(clean, "FULL")
    assert warehouse.validate(clean) == "PASSED"
    warehouse.refresh_marts()
    marts = warehouse.marts()
    for mart in ("mart_daily_transaction", "mart_aml_by_payment_format", "mart_currency_flow", "mart_kpi_overview"):
        assert marts[mart].agg(F.sum("transaction_count"), F.sum("laundering_count")).first() == (3, 1)
    assert marts["mart_bank_activity"].agg(F.sum("total_participations")).first()[0] == 6
    assert marts["mart_aml_account_risk"].agg(F.sum("laundering_participations")).first()[0] == 2
    reports = warehouse.reports()
    assert len(reports) == 16
    assert recon.grain_checks(reports).agg(F.sum("error_count")).first()[0] == 0
    assert recon.orphan_checks(reports).agg(F.sum("error_count")).first()[0] == 0


def test_landing_gate_stops_the_batch(spark):
    store = TableStore(spark, fresh_path(spark, "test-source"))
    with pytest.raises(sl.LandingGateError):
        sl.load_source_batch(store, _landing(spark, [_txn(1)]), expected_rows={"transaction": 2})
    assert [r["status"] for r in store.log_rows(sl.LOG, LOAD_BATCH, "batch_id")] == ["FAILED"]


def test_abandoned_batch_is_marked_failed(spark):
    store = TableStore(spark, fresh_path(spark, "test-source"))
    left_over = {"batch_id": 1, "status": "STARTED", "started_at": datetime(2024, 1, 1)}
    store.append_event(sl.LOG, LOAD_BATCH, left_over)
    sl.load_source_batch(store, _landing(spark, [_txn(1)]))
    assert [r["status"] for r in store.log_rows(sl.LOG, LOAD_BATCH, "batch_id")] == ["FAILED", "COMPLETED"]


def test_failed_load_publishes_nothing_and_the_next_one_works(spark, source):
    warehouse = _warehouse(spark)
    poison = F.when(F.col("source_transaction_id") == 2, F.raise_error(F.lit("poison")).cast("string")).otherwise(F.col("from_account_id"))
    broken = replace(source[0], transactions=source[0].transactions.withColumn("from_account_id", poison))
    with pytest.raises(Exception, match="poison"):
        warehouse.load(broken, "FULL")
    row = warehouse.batch_rows()[0]
    assert row["status"] == "FAILED" and "poison" in row["error_message"]
    assert warehouse.tables()["fact_transaction"].count() == 0
    assert warehouse.tables()["dim_bank"].count() == 1
    warehouse.load(source[0], "INCREMENTAL")
    assert [r["transaction_rows_inserted"] for r in warehouse.batch_rows()] == [0, 5]


def test_reloaded_source_needs_a_reset(loaded, source):
    renumbered = replace(source[0], load_batch_id=99)
    with pytest.raises(StaleSourceError):
        loaded.load(renumbered, "INCREMENTAL")
    fresh = loaded.reset()
    fresh.load(renumbered, "FULL")
    assert fresh.tables()["fact_transaction"].count() == 5


def test_unknown_load_type(spark, source):
    with pytest.raises(ValueError):
        _warehouse(spark).load(source[0], "DELTA")


def test_failed_batch_keeps_fact_of_earlier_loads(loaded):
    assert loaded.tables()["fact_transaction"].count() == 5
    assert isinstance(loaded.batch_rows()[-1]["error_message"], str)

"""Marts kept up to date from the rollups of each load."""

from __future__ import annotations

import pytest

from ledgerlake.operators import marts as mt
from ledgerlake.plans import source_load as sl
from ledgerlake.plans import warehouse as wh
from ledgerlake.plans.store import TableStore, versions_from
from ledgerlake.plans.workspace import step_clock
from ledgerlake.schemas import ACCOUNT_FIELDS, PATTERN_FIELDS, TRANSACTION_FIELDS
from ledgerlake.session import fresh_path


def _txn(n):
    formats, coins = ("ACH", "Wire", "Cash"), ("Euro", "Yen")
    day, coin = f"2022/09/0{1 + n % 5} 10:{n % 60:02d}", coins[n % 2]
    return (n, day, str(1 + n % 3), f"A{n % 7}", str(1 + n % 2), f"A{n % 5}", f"{n}.5", coins[n % 3 == 0], f"{n}.25", coin, formats[n % 3], str(int(n % 4 == 0)))


@pytest.fixture(scope="module")
def source(spark):
    ddl = lambda fields: "landing_row_id long, " + ", ".join(f"{f} string" for f in fields)
    accounts = [(i + 1, f"Bank {i % 3}", str(1 + i % 3), f"A{i // 3}", f"e{i % 4}", f"Entity {i % 4}") for i in range(21)]
    # Attempt 1 begins in an earlier load than it ends in.
    patterns = [(i, str(1 + i // 9), "CYCLE" if i < 9 else "STACK", "x", str(1 + i % 9), *_txn(i * 4)[1:]) for i in range(1, 13)]
    landing = {
        "account": spark.createDataFrame(accounts, ddl(ACCOUNT_FIELDS)),
        "transaction": spark.createDataFrame([_txn(n) for n in range(1, 61)], ddl(TRANSACTION_FIELDS)),
        "pattern": spark.createDataFrame(patterns, ddl(PATTERN_FIELDS)),
    }
    store = TableStore(spark, fresh_path(spark, "test-source"))
    return sl.source_tables(store, sl.load_source_batch(store, landing, clock=step_clock()))


def upto(source, rows, patterns):
    from dataclasses import replace

    return replace(
        source,
        transactions=source.transactions.where(f"source_transaction_id <= {rows}"),
        patterns=source.patterns.where(f"pattern_transaction_id <= {patterns}"),
    )


def whole(tables):
    """The marts computed from the whole facts."""
    fact, pattern = tables["fact_transaction"], tables["fact_pattern_transaction"]
    return {
        "mart_kpi_overview": mt.kpi_overview(mt.as_measures(fact), tables["dim_date"]),
        "mart_daily_transaction": mt.daily_transaction(mt.as_measures(fact), tables["dim_date"], tables["dim_currency"], tables["dim_payment_format"]),
        "mart_aml_by_payment_format": mt.aml_by_payment_format(mt.as_measures(fact), tables["dim_payment_format"]),
        "mart_bank_activity": mt.bank_activity(fact, tables["dim_bank"]),
        "mart_currency_flow": mt.currency_flow(mt.as_measures(fact), tables["dim_currency"]),
        "mart_pattern_summary": mt.pattern_summary(pattern, tables["dim_pattern_type"]),
        "mart_aml_account_risk": mt.aml_account_risk(fact, tables["dim_account"]),
    }


def rows_of(frame):
    return sorted(map(repr, frame.select(*sorted(frame.columns)).collect()))


def test_refreshes_read_the_facts_of_new_loads_only(spark, source, monkeypatch):
    monkeypatch.setattr(wh, "FOLD_AFTER", 2)
    warehouse, read = wh.Warehouse(TableStore(spark, fresh_path(spark, "test-dw")), step_clock()), []

    def recorded(fact, pattern, plain=mt.load_rollups):
        read.append(sorted({f.split("/load=")[1].split("/")[0] for x in (fact, pattern) for f in x.inputFiles()}))
        return plain(fact, pattern)

    monkeypatch.setattr(mt, "load_rollups", recorded)
    kept = []
    for load, (rows, patterns) in enumerate([(20, 5), (30, 9), (40, 9), (45, 12), (60, 12)]):
        warehouse.load(upto(source, rows, patterns), "FULL" if not load else "INCREMENTAL")
        warehouse.refresh_marts()
        log = warehouse.store.log_rows(wh.MART_LOG, wh.MART_REFRESH, "refresh_id")[-1]
        kept.append(versions_from(log["rollups"])["refreshes"])
        expected, marts = whole(warehouse.tables()), warehouse.marts()
        for name in mt.MART_NAMES:
            assert rows_of(marts[name]) == rows_of(expected[name]), (load, name)
            assert marts[name].dtypes == expected[name].dtypes, name
    assert read == [["1"], ["2"], ["3"], ["4"], ["5"]]
    assert kept == [[1], [1, 2], [1, 2, 3], [4], [4, 5]]

    warehouse.load(upto(source, 60, 12), "INCREMENTAL")
    warehouse.refresh_marts()
    assert len(read) == 5  # nothing new: no fact is read
    expected, marts = whole(warehouse.tables()), warehouse.marts()
    assert all(rows_of(marts[n]) == rows_of(expected[n]) for n in mt.MART_NAMES)


def test_a_refresh_without_loads_between_catches_up(spark, source):
    warehouse = wh.Warehouse(TableStore(spark, fresh_path(spark, "test-dw")), step_clock())
    warehouse.load(upto(source, 20, 5), "FULL")
    warehouse.load(source, "INCREMENTAL")
    warehouse.refresh_marts()
    expected, marts = whole(warehouse.tables()), warehouse.marts()
    assert all(rows_of(marts[n]) == rows_of(expected[n]) for n in mt.MART_NAMES)

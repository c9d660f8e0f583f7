"""Reconciliation over kept totals: the verdicts of a whole scan, while only new rows are read."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans.store import TableStore, versions_from
from ledgerlake.plans.warehouse import FACT_TOTALS, SOURCE_TOTALS, Warehouse, source_upto
from ledgerlake.plans import source_load as sl
from ledgerlake.plans.workspace import step_clock
from ledgerlake.session import fresh_path
from test_load import _landing, _txn


@pytest.fixture(scope="module")
def source(spark):
    rows = [_txn(n, cur="Yen" if n % 3 else "Euro", rec="Euro", label=str(n % 2), paid="0" if n == 5 else "10") for n in range(1, 13)]
    store = TableStore(spark, fresh_path(spark, "test-source"))
    return sl.source_tables(store, sl.load_source_batch(store, _landing(spark, rows)))


@pytest.fixture
def warehouse(spark):
    return Warehouse(TableStore(spark, fresh_path(spark, "test-dw")), step_clock())


def checks(warehouse):
    last = max(r["dw_batch_id"] for r in warehouse.batch_rows())
    rows = warehouse.validations().where(F.col("dw_batch_id") == last).collect()
    return {r.check_name: (r.source_value, r.target_value, r.status) for r in rows}


def both(warehouse, source):
    """The checks over kept totals, after seeing that a whole scan gives the same."""
    warehouse.validate(source)
    kept = checks(warehouse)
    warehouse.validate(source, full=True)
    assert checks(warehouse) == kept
    return kept


def failed(found):
    return {name for name, (_, _, status) in found.items() if status == "FAILED"}


def test_equal_to_a_whole_scan_over_several_loads(source, warehouse):
    for n, upto in enumerate((4, 7, 7, 12)):
        part = source_upto(source, upto)
        warehouse.load(part, "INCREMENTAL" if n else "FULL")
        found = both(warehouse, part)
        assert not failed(found) and found["TRANSACTION_ROW_COUNT"][0] == upto
    kept = warehouse._published(warehouse.batch_rows())
    assert kept[FACT_TOTALS] == [1, 2, 4] and kept[SOURCE_TOTALS] == [1, 2, 3, 4]
    warehouse.load(source, "FULL")  # a FULL load is checked whole and keeps nothing
    assert not failed(both(warehouse, source))
    assert warehouse._published(warehouse.batch_rows())[FACT_TOTALS] == [1, 2, 4]


def test_facts_of_earlier_loads_are_not_read_again(spark, source, warehouse):
    warehouse.load(source_upto(source, 4), "FULL")
    warehouse.validate(source_upto(source, 4))
    warehouse.load(source, "INCREMENTAL")
    held = warehouse.store.path("fact_transaction", 1)
    warehouse.store.drop(held)
    spark.range(0).write.parquet(f"{held}/txn_month=202209")
    assert warehouse.validate(source) == "PASSED"
    assert warehouse.validate(source, full=True) == "FAILED"


def test_rows_not_loaded_are_found_and_not_kept(source, warehouse):
    warehouse.load(source_upto(source, 4), "FULL")
    found = both(warehouse, source)  # ids 5 to 12 have arrived and wait for a load
    assert found["TRANSACTION_ROW_COUNT"][:2] == (12, 4) and "PAYMENT_AMOUNT_BY_CURRENCY" in failed(found)
    warehouse.load(source, "INCREMENTAL")
    assert not failed(both(warehouse, source))


def test_a_row_behind_the_mark_is_found(source, warehouse):
    """An id that came in late is below the mark of every increment; only the check can tell."""
    without = replace(source, transactions=source.transactions.where("source_transaction_id <> 3"))
    warehouse.load(source_upto(without, 7), "FULL")
    assert not failed(both(warehouse, source_upto(without, 7)))
    warehouse.load(source, "INCREMENTAL")
    assert both(warehouse, source)["TRANSACTION_ROW_COUNT"][:2] == (12, 11)
    warehouse.load(source, "FULL")
    assert not failed(both(warehouse, source))


def test_totals_of_failed_validations_are_not_named(source, warehouse):
    warehouse.load(source, "FULL")
    assert FACT_TOTALS not in versions_from(warehouse.batch_rows()[0]["table_versions"])
    warehouse.validate(source)
    assert versions_from(warehouse.batch_rows()[0]["table_versions"])[FACT_TOTALS] == [1]

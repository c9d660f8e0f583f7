"""Dimensions that grow by deltas: bytes written, merge-on-read, folding, untouched snapshots."""

from __future__ import annotations

import os
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import dims as dm
from ledgerlake.operators import scd2
from ledgerlake.operators.growth import fingerprints, merge_on_read, touched_buckets
from ledgerlake.plans import source_load as sl
from ledgerlake.plans import warehouse as wh
from ledgerlake.plans.store import TableStore, versions_from
from ledgerlake.plans.workspace import step_clock
from ledgerlake.schemas import ACCOUNT_FIELDS, PATTERN_FIELDS, TRANSACTION_FIELDS
from ledgerlake.session import fresh_path

DIMS = ("dim_bank", "dim_entity", "dim_account")


def account_rows(n, changed=()):
    """(bank, name, account, entity, entity name); ``changed`` accounts have moved to another entity."""
    return [
        (i, f"Bank {i % (n // 20)}", str(i % (n // 20)), f"A{i}", f"e{i % (n // 2)}" if i not in changed else f"moved{i}", f"Entity {i % (n // 2)}")
        for i in range(1, n + 1)
    ]


def source(spark, accounts):
    ddl = lambda fields: "landing_row_id long, " + ", ".join(f"{f} string" for f in fields)
    txn = (1, "2022/09/01 10:00", "1", "A1", "2", "A2", "10", "Euro", "10", "Euro", "ACH", "0")
    landing = {
        "account": spark.createDataFrame(accounts, ddl(ACCOUNT_FIELDS)),
        "transaction": spark.createDataFrame([txn], ddl(TRANSACTION_FIELDS)),
        "pattern": spark.createDataFrame([], ddl(PATTERN_FIELDS)),
    }
    store = TableStore(spark, fresh_path(spark, "test-source"))
    return sl.source_tables(store, sl.load_source_batch(store, landing, clock=step_clock()))


def warehouse(spark):
    return wh.Warehouse(TableStore(spark, fresh_path(spark, "test-dw")), step_clock())


def written(warehouse, load):
    """Rows and bytes of the dimensions' folders of one load."""
    rows, size = {}, 0
    for dim in DIMS:
        path = warehouse.store.path(dim, load)
        if os.path.isdir(path):
            rows[dim] = warehouse.spark.read.parquet(path).count()
            size += sum(os.path.getsize(os.path.join(path, f)) for f in os.listdir(path) if f.endswith(".parquet"))
    return rows, size


def rows_of(frame):
    return sorted(map(repr, frame.collect()))


@pytest.fixture(scope="module")
def pair(spark):
    """A small and a large warehouse, each loaded twice; ten accounts change in between."""
    out = {}
    for n in (200, 4000):
        w, first = warehouse(spark), source(spark, account_rows(n))
        w.load(first, "FULL")
        second = replace(source(spark, account_rows(n, changed=range(11, 21))), load_batch_id=first.load_batch_id)
        w.load(second, "INCREMENTAL")
        out[n] = (w, first, second)
    return out


def test_bytes_of_a_small_change_do_not_follow_the_dimension(pair):
    small, large = (written(pair[n][0], 2) for n in (200, 4000))
    # Ten versions closed, ten opened, ten new entities, no bank.
    assert small[0] == large[0] == {"dim_entity": 10, "dim_account": 20}
    assert large[1] < 1.3 * small[1]
    assert written(pair[4000][0], 1)[1] > 3 * large[1]
    assert versions_from(pair[4000][0].batch_rows()[1]["table_versions"]) == {"dim_account+": [2], "dim_entity+": [2], "account_fingerprint": [2]}


def test_current_state_equals_a_merge_of_whole_tables(spark, pair):
    w, first, second = pair[4000]
    dims = {d: dm.unknown_member(spark, d) for d in DIMS}
    for accounts, row in ((first.accounts, w.batch_rows()[0]), (second.accounts, w.batch_rows()[1])):
        dims["dim_bank"], _ = dm.type1_merge(dims["dim_bank"], dm.bank_source(accounts), "bank_id", "bank_key")
        dims["dim_entity"], _ = dm.type1_merge(dims["dim_entity"], dm.entity_source(accounts), "entity_id", "entity_key")
        snapshot = scd2.account_snapshot(accounts, dims["dim_bank"], dims["dim_entity"])
        dims["dim_account"], _ = scd2.type2_merge(dims["dim_account"], snapshot, row["started_at"])
    held = w.tables()
    for dim in DIMS:
        assert rows_of(held[dim]) == rows_of(dims[dim]), dim


def test_a_base_is_not_shuffled_for_its_deltas(pair):
    plan = pair[4000][0].tables()["dim_account"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_an_untouched_snapshot_is_one_aggregate(pair, monkeypatch):
    w, _, second = pair[200]

    def never(*_):
        raise AssertionError("an untouched snapshot must not be joined")

    for module, name in ((wh, "account_snapshot"), (dm, "bank_source"), (dm, "entity_source"), (dm, "type1_delta")):
        monkeypatch.setattr(module, name, never)
    load = w.load(second, "INCREMENTAL")
    row = w.batch_rows()[-1]
    assert row["account_rows_affected"] == row["bank_rows_affected"] == row["entity_rows_affected"] == 0
    assert row["table_versions"] == "{}" and written(w, load) == ({}, 0)


def test_deltas_fold_into_a_new_base(spark, monkeypatch):
    monkeypatch.setattr(wh, "FOLD_AFTER", 2)
    w, n = warehouse(spark), 60
    first = source(spark, account_rows(n))
    w.load(first, "FULL")
    seen = []
    for step in range(1, 5):
        moved = first.accounts.withColumn("entity_id", F.when(F.col("account_number") == "A7", F.lit(f"step{step}")).otherwise(F.col("entity_id")))
        w.load(replace(first, accounts=moved), "INCREMENTAL")
        seen.append([k for k in versions_from(w.batch_rows()[-1]["table_versions"]) if k.startswith("dim_account")])
    assert seen == [["dim_account+"], ["dim_account+"], ["dim_account"], ["dim_account+"]]
    history = w.tables()["dim_account"].where("account_number = 'A7'").orderBy("account_key").collect()
    assert [r.entity_id for r in history] == ["E7", "step1", "step2", "step3", "step4"]
    assert [r.is_current for r in history] == [False] * 4 + [True]
    assert all(a.effective_to == b.effective_from for a, b in zip(history, history[1:]))
    assert w.tables()["dim_account"].count() == 1 + n + 4 and scd2.overlapping_versions(w.tables()["dim_account"]).isEmpty()


def test_the_newest_delta_wins(spark):
    frame = lambda *rows: spark.createDataFrame(rows, "k long, v string")
    merged = merge_on_read(frame((1, "a"), (2, "b"), (3, "c")), [frame((2, "x"), (4, "y")), frame((2, None), (5, "z"))], "k")
    assert sorted(map(tuple, merged.collect())) == [(1, "a"), (2, None), (3, "c"), (4, "y"), (5, "z")]


def test_fingerprints_see_every_change(spark):
    ddl = "bank_id string, bank_name string, account_number string, entity_id string, entity_name string"
    rows = [(str(i % 5), f"B{i % 5}", f"A{i}", f"e{i}", None) for i in range(50)]
    plain = fingerprints(spark.createDataFrame(rows, ddl))

    def touched(changed):
        return {k for k, v in touched_buckets(plain, fingerprints(spark.createDataFrame(changed, ddl))).items() if v}

    assert touched(rows[::-1]) == set()
    every = {"account", "bank", "entity"}
    assert touched(rows[1:]) == touched([*rows, rows[0]]) == every
    assert touched([("0", "B0", "A0", None, "e0"), *rows[1:]]) == every  # moved between columns
    assert touched([("0", "B0", "A0", "e0", ""), *rows[1:]]) == every

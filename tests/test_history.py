"""Type 1 and type 2 dimensions over several snapshots."""

from __future__ import annotations

from datetime import datetime

import pytest

from ledgerlake.operators import dims as dm
from ledgerlake.operators import scd2
from ledgerlake.schemas import DIM_SCHEMAS

T1, T2, T3 = datetime(2024, 1, 1), datetime(2024, 2, 1), datetime(2024, 3, 1)
OPEN = datetime(9999, 12, 31, 23, 59, 59)


def _accounts(spark, rows):
    return spark.createDataFrame(rows, "bank_id string, bank_name string, account_number string, entity_id string, entity_name string")


def _load(spark, dims, rows, at):
    accounts = _accounts(spark, rows)
    dims["dim_bank"], banks = dm.type1_merge(dims["dim_bank"], dm.bank_source(accounts), "bank_id", "bank_key")
    dims["dim_entity"], entities = dm.type1_merge(
        dims["dim_entity"], dm.entity_source(accounts), "entity_id", "entity_key"
    )
    snapshot = scd2.account_snapshot(accounts, dims["dim_bank"], dims["dim_entity"])
    dims["dim_account"], touched = scd2.type2_merge(dims["dim_account"], snapshot, at)
    return banks, entities, touched


@pytest.fixture(scope="module")
def history(spark):
    dims = {d: dm.unknown_member(spark, d) for d in ("dim_bank", "dim_entity", "dim_account")}
    first = [("1", "B", "X", "E1", "One"), ("1", "A", "Y", None, None), ("2", "C", "X", "E2", None)]
    second = [("1", "A2", "X", "E2", "Two"), ("1", "A2", "Y", None, None), ("3", "D", "Q", "E3", "Three")]
    counts = [_load(spark, dims, first, T1), _load(spark, dims, second, T2), _load(spark, dims, second, T3)]
    return dims, counts


def test_counts(history):
    # Closed plus opened: one account changes entity, one is new; the third load changes nothing.
    assert history[1] == [(2, 2, 3), (2, 2, 3), (0, 0, 0)]


def test_type1_overwrites_and_keeps_keys(history):
    banks = {r.bank_id: (r.bank_key, r.bank_name) for r in history[0]["dim_bank"].collect()}
    assert banks == {"~UNKNOWN": (-1, "Unknown"), "1": (1, "A2"), "2": (2, "C"), "3": (3, "D")}
    entities = {r.entity_id: (r.entity_key, r.entity_name) for r in history[0]["dim_entity"].collect()}
    assert entities == {"~UNKNOWN": (-1, "Unknown"), "E1": (1, "One"), "E2": (2, "Two"), "E3": (3, "Three")}


def test_type2_versions(history):
    rows = history[0]["dim_account"].where("account_key <> -1").collect()
    got = sorted(
        (r.account_key, r.bank_id, r.account_number, r.entity_key, r.effective_from, r.effective_to, r.is_current)
        for r in rows
    )
    assert got == [
        (1, "1", "X", 1, T1, T2, False),
        (2, "1", "Y", -1, T1, OPEN, True),
        (3, "2", "X", 2, T1, OPEN, True),  # missing from later snapshots, stays current
        (4, "1", "X", 2, T2, OPEN, True),
        (5, "3", "Q", 3, T2, OPEN, True),
    ]


def test_one_current_version_and_no_overlap(history):
    accounts = history[0]["dim_account"]
    assert accounts.where("is_current").groupBy("bank_id", "account_number").count().where("count > 1").isEmpty()
    assert scd2.overlapping_versions(accounts).isEmpty()


def test_overlap_is_found_but_touching_is_fine(spark):
    rows = [
        (1, 1, 1, "1", "X", None, "h", T1, T3, False),
        (2, 1, 1, "1", "X", None, "i", T2, OPEN, True),
        (3, 1, 1, "2", "X", None, "h", T1, T2, False),
        (4, 1, 1, "2", "X", None, "i", T2, OPEN, True),
    ]
    accounts = spark.createDataFrame(rows, DIM_SCHEMAS["dim_account"])
    assert [r.account_key for r in scd2.overlapping_versions(accounts).collect()] == [2]

"""Typing and rejects on hand-written landing rows."""

from __future__ import annotations

from datetime import datetime
from decimal import Decimal

import pytest

from ledgerlake.operators import typing as ty
from ledgerlake.schemas import ACCOUNT_FIELDS, PATTERN_FIELDS, TRANSACTION_FIELDS

GOOD = {
    "timestamp_text": " 2022/09/01 00:20 ",
    "from_bank_text": " 0010 ",
    "from_account_text": " 8000ebd30 ",
    "to_bank_text": "00070",
    "to_account_text": "x1",
    "amount_received_text": "3697.34",
    "receiving_currency_text": " US Dollar ",
    "amount_paid_text": "+3697.34",
    "payment_currency_text": "US Dollar",
    "payment_format_text": "Wire",
    "is_laundering_text": " 1 ",
}
# Field -> texts that must send the whole row to the rejects.
BAD = {
    "timestamp_text": ["2022-09-01 00:20", "2022/13/01 00:20", "2022/02/30 00:20", "2022/09/01 99:99", "", None, "2022/09/01 00:20:00", "2022/09/01 00:20\n"],
    "from_bank_text": ["X10", "", None, "-1", "1.0", "99999999999999999999", "10\n"],
    "to_bank_text": ["1 0", "99999999999999999999"],
    "from_account_text": ["", "   ", None],
    "to_account_text": [" "],
    "amount_received_text": ["n/a", "1,5", "1.", ".5", "1e5", "", None, "123456789012345678901"],
    "amount_paid_text": ["--1", "NaN"],
    "receiving_currency_text": ["", None],
    "payment_currency_text": ["  "],
    "payment_format_text": [None],
    "is_laundering_text": ["2", "true", "", None],
}


def _landing(spark, rows, fields):
    ddl = "landing_row_id long, " + ", ".join(f"{f} string" for f in fields)
    return spark.createDataFrame([(i, *[r[f] for f in fields]) for i, r in enumerate(rows, 1)], ddl)


def test_good_row_is_normalised(spark):
    tagged = ty.tag_transactions(_landing(spark, [GOOD], TRANSACTION_FIELDS), 7)
    row = ty.typed_transactions(tagged).first()
    assert row.transaction_timestamp == datetime(2022, 9, 1, 0, 20)
    assert (row.raw_from_bank_id, row.from_bank_id, row.to_bank_id) == ("0010", "10", "70")
    assert (row.from_account_id, row.to_account_id) == ("8000EBD30", "X1")
    assert row.amount_paid == Decimal("3697.34000000") and row.receiving_currency == "US Dollar"
    assert row.is_laundering is True and row.load_batch_id == 7


def test_every_guard_rejects_alone(spark):
    rows = [GOOD] + [{**GOOD, field: text} for field, texts in BAD.items() for text in texts]
    tagged = ty.tag_transactions(_landing(spark, rows, TRANSACTION_FIELDS))
    typed = ty.typed_transactions(tagged).collect()
    rejected = ty.rejects(tagged, ty.TRANSACTION).collect()
    assert [r.source_row_id for r in typed] == [1]
    assert sorted(r.source_row_id for r in rejected) == list(range(2, len(rows) + 1))
    assert {r.error_code for r in rejected} == {"INVALID_TRANSACTION"}


def test_zero_and_negative_amounts_stay_in_the_source(spark):
    rows = [{**GOOD, "amount_paid_text": "0"}, {**GOOD, "amount_received_text": "-5.25"}]
    tagged = ty.tag_transactions(_landing(spark, rows, TRANSACTION_FIELDS))
    assert ty.typed_transactions(tagged).count() == 2


def test_payload_keeps_the_raw_text(spark):
    row = {**GOOD, "is_laundering_text": "2", "payment_format_text": None}
    reject = ty.rejects(ty.tag_transactions(_landing(spark, [row], TRANSACTION_FIELDS)), ty.TRANSACTION).first()
    assert reject.raw_payload == "|".join(row[f] for f in TRANSACTION_FIELDS if row[f] is not None)


def test_accounts_reject_duplicates_and_blanks(spark):
    base = dict(zip(ACCOUNT_FIELDS, ["Bank A", "0012", " ab1", " e9 ", "Corp"]))
    rows = [
        base,
        {**base, "bank_id_text": "12", "account_number_text": "AB1", "bank_name_text": "Bank B"},
        {**base, "bank_id_text": "x"},
        {**base, "account_number_text": " "},
        {**base, "account_number_text": "ab2", "entity_id_text": " ", "entity_name_text": ""},
    ]
    tagged = ty.tag_accounts(_landing(spark, rows, ACCOUNT_FIELDS))
    typed = {r.source_row_id: r for r in ty.typed_accounts(tagged).collect()}
    assert set(typed) == {1, 5}
    assert typed[1].bank_name == "Bank A" and typed[1].entity_id == "E9"
    assert typed[5].entity_id is None and typed[5].entity_name is None
    codes = {r.source_row_id: r.error_code for r in ty.rejects(tagged, ty.ACCOUNT).collect()}
    assert codes == {2: "DUPLICATE_ACCOUNT", 3: "INVALID_ACCOUNT", 4: "INVALID_ACCOUNT"}


@pytest.mark.parametrize(
    "field, text",
    [
        ("pattern_attempt_id_text", "a"),
        ("pattern_sequence_text", "99999999999"),
        ("pattern_type_text", " "),
        ("pattern_description_text", None),
        ("is_laundering_text", "3"),
    ],
)
def test_pattern_guards(spark, field, text):
    row = {
        **GOOD,
        "pattern_attempt_id_text": "4",
        "pattern_type_text": "CYCLE",
        "pattern_description_text": "CYCLE:  Max 10 hops",
        "pattern_sequence_text": "2",
    }
    tagged = ty.tag_patterns(_landing(spark, [row, {**row, field: text}], PATTERN_FIELDS))
    assert [r.pattern_transaction_id for r in ty.typed_patterns(tagged).collect()] == [1]
    assert [r.error_code for r in ty.rejects(tagged, ty.PATTERN).collect()] == ["INVALID_PATTERN_TRANSACTION"]

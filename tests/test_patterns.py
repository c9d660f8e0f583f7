"""Pattern blocks against a small line-by-line reader."""

from __future__ import annotations

import csv

import pytest

from ledgerlake.session import fresh_path
from ledgerlake.sources.files import landing_from_csv
from ledgerlake.sources.patterns import read_pattern_blocks

LINE = "2022/09/01 0{h}:00,00{b},8{n},0012,9{n},10.5,Euro,10.5,Euro,ACH,1"


def _line(i: int) -> str:
    return LINE.format(h=i % 10, b=i % 7, n=i)


def _brute_force(text: str):
    attempt, header, sequence, rows, rejected = 0, "", 0, [], []
    for raw in text.lstrip("﻿").splitlines():
        line = raw.strip()
        if not line:
            continue
        if line.startswith("BEGIN LAUNDERING ATTEMPT - "):
            attempt, sequence = attempt + 1, 0
            header = line[len("BEGIN LAUNDERING ATTEMPT - "):].strip()
        elif line.startswith("END LAUNDERING ATTEMPT - "):
            header = ""
        elif not header:
            rejected.append(("PATTERN_LINE_OUTSIDE_BLOCK", line))
        else:
            fields = next(csv.reader([line]))
            if len(fields) != 11:
                rejected.append(("PATTERN_FIELD_COUNT", line))
            else:
                sequence += 1
                kind = header.split(":", 1)[0].strip().upper()
                rows.append((str(attempt), kind, header, str(sequence), *fields))
    return rows, rejected


def _text() -> str:
    out = ["﻿" + _line(0)]  # before any block
    for attempt in range(60):
        kind = ["fan-out", "CYCLE", "STACK"][attempt % 3]
        out.append(f"BEGIN LAUNDERING ATTEMPT - {kind}:  Max {attempt}-degree")
        # one attempt is far longer than all others together
        out += [_line(i) for i in range(900 if attempt == 30 else attempt % 5)]
        if attempt % 7 == 0:
            out += ["", "too,few,fields", "  " + _line(attempt) + "  ", _line(attempt) + ",extra"]
        if attempt % 11:
            out.append(f"END LAUNDERING ATTEMPT - {kind}")
            if attempt % 13 == 0:
                out.append(_line(attempt))
    return "\r\n".join(out) + "\r\n"


@pytest.mark.parametrize("split_bytes", [None, 2048])
def test_blocks_match_a_line_reader(spark, tmp_path, split_bytes):
    text = _text()
    path = tmp_path / "patterns.txt"
    path.write_bytes(text.encode())
    if split_bytes:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows, rejected = read_pattern_blocks(spark, str(path))
        got = sorted(tuple(r) for r in rows.collect())
        got_rejected = sorted(tuple(r) for r in rejected.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected, expected_rejected = _brute_force(text)
    assert got == sorted(expected)
    assert got_rejected == sorted(expected_rejected)


def test_repeated_header_is_read_by_position(spark, tmp_path):
    path = tmp_path / "trans.csv"
    path.write_text(
        "Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency,Amount Paid,"
        "Payment Currency,Payment Format,Is Laundering\n"
        "2022/09/01 00:20,010,AAA,020,BBB,1.5,Euro,1.5,Euro,ACH,0\n"
    )
    accounts = tmp_path / "accounts.csv"
    accounts.write_text("Bank Name,Bank ID,Account Number,Entity ID,Entity Name\nA,010,AAA,E1,Corp\n")
    patterns = fresh_path(spark, "no-patterns")
    spark.createDataFrame([], "x string").write.option("header", True).csv(patterns)
    landing = landing_from_csv(spark, str(accounts), str(path), patterns)
    row = landing["transaction"].first()
    assert (row.from_account_text, row.to_account_text, row.landing_row_id) == ("AAA", "BBB", 1)
    assert landing["account"].first().bank_id_text == "010"

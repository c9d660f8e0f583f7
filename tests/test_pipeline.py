"""Source files through to reports in one run, and a second run on a grown warehouse."""

from __future__ import annotations

import pytest

from ledgerlake.plans import acceptance
from ledgerlake.plans.pipeline import run_pipeline
from ledgerlake.plans.store import TableStore
from ledgerlake.plans.warehouse import StaleSourceError
from ledgerlake.session import fresh_path

HEADER = (
    "Timestamp,From Bank,Account,To Bank,Account,Amount Received,Receiving Currency,Amount Paid,"
    "Payment Currency,Payment Format,Is Laundering"
)


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    folder = tmp_path_factory.mktemp("source")
    lines = [f"2022/09/0{1 + i % 3} 00:{i:02d},0{i % 2},A{i % 2},1,A1,5.25,Euro,5.25,Euro,ACH,{i % 4 // 3}" for i in range(20)]
    (folder / "trans.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    (folder / "accounts.csv").write_text(
        "Bank Name,Bank ID,Account Number,Entity ID,Entity Name\nZero,0,A0,E0,\nOne,01,a1,E1,Corp\n"
    )
    blocks = ["BEGIN LAUNDERING ATTEMPT - STACK:  2", lines[3], lines[7], "END LAUNDERING ATTEMPT - STACK", "stray"]
    (folder / "patterns.txt").write_text("\n".join(blocks) + "\n")
    return folder


def test_run_from_files(spark, files):
    root = fresh_path(spark, "test-pipeline")
    paths = (str(files / "accounts.csv"), str(files / "trans.csv"), str(files / "patterns.txt"))
    figures = {"laundering": "5", "period": "2022-09-01 -> 2022-09-03"}
    export = fresh_path(spark, "test-export")
    result = run_pipeline(
        spark, root, *paths, expected_rows={"transaction": 20}, expected_figures=figures, export_folder=export
    )
    assert result.validation == "PASSED"
    assert [r.error_code for r in result.rejected_pattern_lines.collect()] == ["PATTERN_LINE_OUTSIDE_BLOCK"]
    tests = TableStore(spark, f"{root}/tests")
    failed = acceptance.test_results(tests).where("status = 'FAILED'")
    # A first load alone cannot show an idle increment; everything else holds.
    assert [r.test_code for r in failed.collect()] == ["ETL_03"]
    runs = acceptance.test_runs(tests).collect()
    assert [(r.test_count, r.passed_count, r.failed_count, r.status) for r in runs] == [(20, 19, 1, "FAILED")]
    kpi = result.warehouse.reports()["kpi_overview"].first()
    assert (kpi.transaction_count, kpi.laundering_count, kpi.self_transfer_count) == (20, 5, 10)
    exported = spark.read.option("header", True).csv(f"{export}/fact_pattern_summary")
    assert exported.first()["pattern_transaction_count"] == "2"
    # Reading the files again hands out the ids anew: the warehouse refuses to mix them.
    with pytest.raises(StaleSourceError):
        run_pipeline(spark, root, *paths, load_type="INCREMENTAL")


def test_wrong_expected_figure_fails_the_test(spark, files):
    root = fresh_path(spark, "test-pipeline")
    paths = (str(files / "accounts.csv"), str(files / "trans.csv"), str(files / "patterns.txt"))
    run_pipeline(spark, root, *paths, expected_figures={"laundering": "6"})
    results = acceptance.test_results(TableStore(spark, f"{root}/tests"))
    assert {r.test_code for r in results.where("status = 'FAILED'").collect()} == {"ETL_03", "BR_01"}


def test_new_files_continue_the_ids_and_load_incrementally(spark, files, tmp_path):
    root = fresh_path(spark, "test-pipeline")
    run_pipeline(spark, root, str(files / "accounts.csv"), str(files / "trans.csv"), str(files / "patterns.txt"))
    lines = [f"2022/09/05 01:{i:02d},00,A0,1,A1,7.5,Euro,7.5,Euro,Wire,0" for i in range(5)] + ["no date,0,A0,1,A1,1,Euro,1,Euro,ACH,0"]
    (tmp_path / "trans.csv").write_text("\n".join([HEADER, *lines]) + "\n")
    (tmp_path / "patterns.txt").write_text("stray line\n")
    result = run_pipeline(
        spark, root, str(files / "accounts.csv"), str(tmp_path / "trans.csv"), str(tmp_path / "patterns.txt"), load_type="INCREMENTAL", append=True
    )
    assert result.validation == "PASSED"
    loads = [(r.load_type, r.source_low_watermark, r.source_high_watermark, r.transaction_rows_inserted) for r in result.warehouse.batches().collect()]
    assert sorted(loads) == [("FULL", 1, 20, 20), ("INCREMENTAL", 21, 25, 5)]
    assert result.warehouse.reports()["kpi_overview"].first().transaction_count == 25
    assert [(r.error_code, r.load_batch_id) for r in result.rejected_pattern_lines.collect()] == [("PATTERN_LINE_OUTSIDE_BLOCK", 2)]
    # Each log row names only what its load added.
    rows = result.warehouse.batch_rows()
    assert all("[1, 2]" not in r["table_versions"] for r in rows)

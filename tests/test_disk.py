"""What a query leaves on disk, and the same rows when tables are written slice by slice."""

from __future__ import annotations

import glob
import os
import time

import pytest
from pyspark.sql import functions as F
from test_testtables import SHIFTS, large_keys  # noqa: F401

from ledgerlake import session
from ledgerlake.plans.workspace import Workspace
from ledgerlake.queries import REGISTRY
from ledgerlake.session import fresh_path, passing_stages, shared_dir, slices, stage, write_parts
from ledgerlake.streaming import ingest

SHARED_LOAD = [
    "demo_latest_run",
    "recon_9_checks",
    "demo_format_rate",
    "dim_bank_semi",
    "scd2_overlap",
    "account_snapshot",
    "perf_daily_rollup",
    "pattern_rank",
    "ds_risk_account_count",
    "mart_aml_account_risk",
    "rpt_etl_batch_monitor",
    "daily_prev_day",
    "acceptance_latest",
    "curated_vs_local_daily",
    "curated_completeness",
    "curated_vs_local_totals",
]
OWN_FOLDERS = ["src_manifest", "incremental_files", "incremental_stream", "retention_sweep"]


def local_path(path: str) -> str:
    return path.removeprefix("file://").removeprefix("file:")


def folders(spark) -> set[str]:
    app = spark.sparkContext.applicationId
    return set(glob.glob(f"{local_path(shared_dir(spark))}/ledgerlake/{app}/*"))


def labels(paths: set[str]) -> set[str]:
    return {os.path.basename(p).rsplit("-", 1)[0] for p in paths}


def shuffle_files(spark) -> set[str]:
    dirs = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    return {f for d in dirs for f in glob.glob(f"{d.getPath()}/*/shuffle_*")}


def same_rows(left, right) -> bool:
    return sorted(map(repr, left.collect())) == sorted(map(repr, right.collect()))


@pytest.fixture(scope="module")
def sliced(spark, sf_dir):
    """A workspace of its own in which every table is written in several slices."""
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(session, "SLICE_ROWS", 2500)
        patch.setattr(ingest, "INTAKE_BYTES", 64 << 10)
        yield Workspace(spark, sf_dir)


def test_slices_hold_every_row_once_and_in_order(spark, monkeypatch):
    monkeypatch.setattr(session, "SLICE_ROWS", 100)
    rows = spark.range(950).select(F.when(F.col("id") % 50 != 0, F.col("id") * 7 % 1000).alias("k"), "id")
    parts = [part.collect() for part in slices(rows, "k")]
    assert len(parts) == 10
    assert sorted(r.id for part in parts for r in part) == list(range(950))
    assert [any(r.k is None for r in part) for part in parts] == [True] + 9 * [False]
    ends = [(min(ks), max(ks)) for part in parts if (ks := [r.k for r in part if r.k is not None])]
    assert all(high < low for (_, high), (low, _) in zip(ends, ends[1:]))


def test_one_key_in_all_rows_is_not_cut(spark, monkeypatch):
    monkeypatch.setattr(session, "SLICE_ROWS", 100)
    rows = spark.range(950).withColumn("k", F.lit(2**62))
    assert sum(part.count() for part in slices(rows, "k")) == 950


def test_a_failing_part_takes_the_folder_with_it(spark):
    path, rows = fresh_path(spark, "parts"), spark.range(10)
    broken = rows.select(F.raise_error(F.lit("broken")).cast("long").alias("id"))
    with pytest.raises(Exception, match="broken"):
        write_parts(spark, [lambda: rows, lambda: broken], path)
    assert not os.path.exists(local_path(path))


def test_passing_stages_go_and_the_others_stay(spark):
    kept = stage(spark.range(3), "kept")
    with passing_stages(spark):
        before = folders(spark)
        session.run_together(spark, [lambda: stage(spark.range(5), "passing")])
        assert labels(folders(spark) - before) == {"passing"}
    assert folders(spark) == before and kept.count() == 3


def test_landing_leaves_no_numbered_copy_and_no_shuffle_files(spark, large_keys):  # noqa: F811
    ws = Workspace(spark, large_keys)
    held, files = folders(spark), shuffle_files(spark)
    assert ws.landing["transaction"].count() == 12_000
    assert labels(folders(spark) - held) == {"landing-account", "landing-transaction", "landing-pattern"}
    assert settled_files(spark, files) == set()


def settled_files(spark, before: set[str]) -> set[str]:
    """Shuffle files that are new; they are removed in the background."""
    for _ in range(50):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.2)
    return left


def test_the_shared_load_leaves_its_tables_only(spark, sliced):
    held, files = folders(spark), shuffle_files(spark)
    assert sliced.warehouse.tables()["fact_transaction"].count() == sliced.source.transactions.count()
    assert labels(folders(spark) - held) <= {"landing-account", "landing-transaction", "landing-pattern", "source", "dw", "recon"}
    assert settled_files(spark, files) == set()


@pytest.mark.parametrize("name", SHARED_LOAD)
def test_rows_of_a_load_in_slices(ws, sliced, name):
    assert same_rows(REGISTRY[name](sliced), REGISTRY[name](ws))


@pytest.mark.parametrize("name", OWN_FOLDERS)
def test_rows_and_folders_of_queries_with_tables_of_their_own(spark, ws, sliced, name):
    assert sliced.source and ws.source
    before = folders(spark)
    found = REGISTRY[name](sliced)
    left = labels(folders(spark) - before)
    assert left <= ({"stream", "stream-checkpoint"} if name == "incremental_stream" else {"settled"})
    assert same_rows(found, REGISTRY[name](ws))


def test_a_large_drop_comes_in_several_micro_batches(spark, sliced):
    rows = REGISTRY["incremental_stream"](sliced)
    paths = {r[0] for r in rows.select(F.regexp_extract(F.input_file_name(), r"stream_batch=(\d+)", 1)).distinct().collect()}
    assert len(paths) > 2

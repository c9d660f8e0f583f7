"""File stream replays and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.plans.store import TableStore
from ledgerlake.session import fresh_path
from ledgerlake.sources import sinks
from ledgerlake.streaming import ingest
from ledgerlake.streaming.ingest import TransactionStream


def test_replayed_micro_batch_changes_nothing(spark, ws):
    inbox = fresh_path(spark, "test-inbox")
    landed = ws.landing["transaction"]
    landed.where("landing_row_id % 2 = 0").write.parquet(inbox)
    target = fresh_path(spark, "test-stream")
    stream = TransactionStream(spark, inbox, target, fresh_path(spark, "test-checkpoint"))
    stream.run_available()
    before = stream.table().count()
    assert before == ws.source.transactions.where("source_transaction_id % 2 = 0").count()
    stream.run_available()  # nothing new
    assert stream.table().count() == before
    stream._sink(spark.read.parquet(inbox), 0)  # the same micro-batch again after a crash
    assert stream.table().count() == before
    # A lost checkpoint delivers every file again, under a new batch number.
    stream._sink(spark.read.parquet(inbox), 5)
    assert stream.table().count() == before


def _stream(spark):
    return TransactionStream(spark, fresh_path(spark, "test-inbox"), fresh_path(spark, "test-stream"), fresh_path(spark, "test-checkpoint"))


def _ids(stream):
    return sorted(r["source_transaction_id"] for r in stream.table().select("source_transaction_id").collect())


def test_a_batch_reads_words_and_no_rows_of_others(spark, ws):
    """Rows of an earlier batch made unreadable: the next batches still leave its keys out."""
    landed, stream = ws.landing["transaction"], _stream(spark)
    stream._sink(landed.where("landing_row_id % 2 = 0"), 0)
    want = _ids(stream)
    spark.createDataFrame([("no such row",)], "source_transaction_id string").write.mode("overwrite").parquet(
        f"{stream.target}/rows/stream_batch=0"
    )
    stream._sink(landed.where("landing_row_id % 2 = 0 or landing_row_id % 3 = 0"), 1)
    added = sorted(r[0] for r in spark.read.parquet(f"{stream.target}/rows/stream_batch=1").select("source_transaction_id").collect())
    valid = [r[0] for r in ws.source.transactions.select("source_transaction_id").collect()]
    assert want == sorted(i for i in valid if i % 2 == 0)
    assert added == sorted(i for i in valid if i % 2 and i % 3 == 0)


def test_every_row_once_over_folds_replays_lost_state_and_a_lost_checkpoint(spark, ws, monkeypatch):
    monkeypatch.setattr(ingest, "FOLD_EVERY", 2)
    landed, stream = ws.landing["transaction"].where("landing_row_id <= 3000"), _stream(spark)
    store = TableStore(spark, stream.target)
    drop = lambda n: landed.where(f"landing_row_id % 5 = {n} or landing_row_id % 7 = {n}")
    valid = sorted(r[0] for r in ws.source.transactions.where("source_transaction_id <= 3000").select("source_transaction_id").collect())
    upto = lambda n: [i for i in valid if any(i % 5 == k or i % 7 == k for k in range(n + 1))]
    for n in range(4):
        stream._sink(drop(n), n)
        assert _ids(stream) == upto(n)
    assert store.numbers(f"{stream.target}/folds/rows", "upto") == {2}
    stream._sink(drop(3), 3)  # a replay of the last batch
    assert _ids(stream) == upto(3)
    store.drop(f"{stream.target}/seen/rows/stream_batch=3")  # a crash between rows and words
    stream._sink(drop(4), 4)
    assert _ids(stream) == upto(4)
    assert store.numbers(f"{stream.target}/folds/rows", "upto") == {2, 4}
    # The checkpoint is lost: batches start anew, cut in another way, and rewrite their folders.
    stream._sink(landed.where("landing_row_id % 2 = 0"), 0)
    assert store.numbers(f"{stream.target}/folds/rows", "upto") == set()
    stream._sink(landed.where("landing_row_id % 2 = 1"), 1)
    assert _ids(stream) == valid


def test_empty_batches(spark, ws):
    stream = _stream(spark)
    for n in range(3):
        stream._sink(ws.landing["transaction"].limit(0), n)
    assert _ids(stream) == [] and stream.rejects().count() == 0


def test_curated_rerun_replaces_only_its_partition(spark):
    rows = spark.createDataFrame(
        [(1, "2024-01-01", True), (2, "2024-01-02", True), (3, "2024-01-02", False)],
        "transaction_key long, txn_date string, is_valid boolean",
    ).withColumn("txn_date", F.to_date("txn_date"))
    folder = fresh_path(spark, "test-curated")
    sinks.write_curated(rows, folder)
    sinks.write_curated(rows.where("txn_date = '2024-01-02'"), folder)
    got = sorted(r.transaction_key for r in spark.read.parquet(f"{folder}/fact_transaction").collect())
    assert got == [1, 2]


def test_boolean_tokens_and_types_survive_csv(spark):
    folder, target = fresh_path(spark, "test-csv"), fresh_path(spark, "test-lake")
    text = spark.createDataFrame(
        [("1", "t", "12345678901234567890.12345678", "0012"), ("2", "No", "1", "7")],
        "date_key string, is_weekend string, amount string, bank_id string",
    )
    sinks.export_views({"small": text}, folder)
    typed = spark.createDataFrame([], "date_key int, is_weekend boolean, amount decimal(38,8), bank_id string").schema
    sinks.load_lakehouse(spark, folder, {"small": typed}, target, "test_lake_")
    rows = {r.date_key: r for r in spark.table("test_lake_small").collect()}
    assert rows[1].is_weekend is True and rows[2].is_weekend is False
    assert str(rows[1].amount) == "12345678901234567890.12345678" and rows[1].bank_id == "0012"

"""Numbering against plain Python, with one group holding most of the rows."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.ordinals import dense_ordinal, dense_rank_desc, file_ordinal
from ledgerlake.session import fresh_path


@pytest.fixture(scope="module")
def skewed():
    rng = random.Random(3)
    ids = rng.sample(range(10**9), 3000)
    return [("hot" if i % 3 else f"g{i % 40}", n) for i, n in enumerate(ids)]


def test_dense_ordinal_over_everything(spark, skewed):
    rows = spark.createDataFrame(skewed, "g string, n long").repartition(7)
    got = {(r.g, r.n): r.ordinal for r in dense_ordinal(rows, ["g", "n"]).collect()}
    assert got == {key: i for i, key in enumerate(sorted(skewed), 1)}


def test_dense_ordinal_restarts_per_group(spark, skewed):
    rows = spark.createDataFrame(skewed, "g string, n long")
    got = {(r.g, r.n): r.place for r in dense_ordinal(rows, ["n"], within=("g",), name="place").collect()}
    expected, seen = {}, {}
    for g, n in sorted(skewed):
        seen[g] = seen.get(g, 0) + 1
        expected[(g, n)] = seen[g]
    assert got == expected


def test_dense_ordinal_descending(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)], "n long")
    got = {r.n: r.ordinal for r in dense_ordinal(rows, [F.desc("n")]).collect()}
    assert got == {n: 50 - n for n in range(50)}


def test_dense_rank_has_no_gaps(spark):
    rows = spark.createDataFrame([("a", 5), ("b", 9), ("c", 5), ("d", 1)], "k string, v long")
    got = {r.k: r.place for r in dense_rank_desc(rows, "v", "place").collect()}
    assert got == {"b": 1, "a": 2, "c": 2, "d": 3}


def test_file_ordinal_over_many_splits(spark):
    path = fresh_path(spark, "test-ordinal")
    rows = spark.range(4000, numPartitions=3).select(F.format_string("row %05d", "id").alias("value"))
    rows.write.text(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        read = spark.read.text(path)
        assert read.rdd.getNumPartitions() > 5
        got = {r.value: r.landing_row_id for r in file_ordinal(read).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {f"row {i:05d}": i + 1 for i in range(4000)}

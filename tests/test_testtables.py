"""The adapter's ids on tables whose keys are larger than those of the given ones."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerlake.plans.workspace import Workspace
from ledgerlake.sources import testtables

PACKED = (
    "(((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 1000 + l_suppkey) * 10000"
    " + datediff(cast(l_shipdate as date), date'1990-01-01')"
)
SHIFTS = {
    "customer": {"c_custkey": 885_000},
    "supplier": {"s_suppkey": 59_000},
    "orders": {"o_orderkey": 8_850_000, "o_custkey": 885_000},
    "lineitem": {"l_orderkey": 8_850_000, "l_partkey": 1_180_000, "l_suppkey": 59_000},
}


@pytest.fixture(scope="module")
def large_keys(spark, sf_dir, tmp_path_factory):
    """The tables twice, the second time with shifted keys."""
    folder = str(tmp_path_factory.mktemp("large-keys"))
    for name, shifts in SHIFTS.items():
        rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
        moved = rows.select(*((F.col(c) + shifts.get(c, 0)).alias(c) if c in shifts else c for c in rows.columns))
        rows.unionByName(moved).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_ids_that_fit_are_the_packed_keys(spark, sf_dir):
    given = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(f"{PACKED} as id")
    ids = testtables.lines(spark, sf_dir).selectExpr("landing_row_id as id")
    assert ids.exceptAll(given).isEmpty() and given.exceptAll(ids).isEmpty()


def test_larger_keys_are_numbered_in_the_same_order(spark, sf_dir, large_keys):
    small, large = Workspace(spark, sf_dir).landing, Workspace(spark, large_keys).landing
    small_ids = [r[0] for r in small["transaction"].select("landing_row_id").orderBy("landing_row_id").collect()]
    ids = [r[0] for r in large["transaction"].select("landing_row_id").orderBy("landing_row_id").collect()]
    assert ids == list(range(1, 2 * len(small_ids) + 1))
    # The first half are the given rows, in their order.
    place = {id_: n for n, id_ in enumerate(small_ids, 1)}
    for name in ("transaction", "pattern"):
        want = sorted(((place[r[0]], *r[1:]) for r in small[name].collect()), key=repr)
        first = large[name].where(F.col("landing_row_id") <= len(small_ids))
        assert sorted((tuple(r) for r in first.collect()), key=repr) == want
        assert large[name].count() >= len(want) * (2 if name == "transaction" else 1)
    # A pattern row has the id of its transfer.
    shared = [c for c in large["pattern"].columns if c in large["transaction"].columns]
    assert large["pattern"].select(shared).exceptAll(large["transaction"].select(shared)).isEmpty()

"""Dimensions that grow by deltas, and fingerprints that tell which keys a snapshot has touched.

A load writes only the rows it adds or changes. The current state is the base without the keys a
delta holds, plus the newest row of each of those keys. A row is never deleted, so the surrogate
key alone decides which row is replaced.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fingerprints of a snapshot for each kind of key; a fixed number, whatever the snapshot's size.
BUCKETS = 512
KEYS = {"account": ["bank_id", "account_number"], "bank": ["bank_id"], "entity": ["entity_id"]}
_CONTENT = ["bank_id", "bank_name", "account_number", "entity_id", "entity_name"]
FINGERPRINT = "kind string, bucket int, n_rows long, total decimal(38,0), mixed long"


def newest(deltas: list[DataFrame], key: str) -> DataFrame:
    """The row of the last delta for each key; ``deltas`` in the order they were written."""
    if len(deltas) == 1:
        return deltas[0]
    rows = reduce(DataFrame.unionByName, [d.withColumn("_load", F.lit(i)) for i, d in enumerate(deltas)])
    columns = deltas[0].columns
    latest = rows.groupBy(key).agg(F.max_by(F.struct(*columns), "_load").alias("_row"))
    return latest.select(*[F.col(f"_row.{c}").alias(c) for c in columns])


def merge_on_read(base: DataFrame, deltas: list[DataFrame], key: str) -> DataFrame:
    """Base and deltas as one table. Small deltas travel to the base, which is not shuffled."""
    if not deltas:
        return base
    changed = newest(deltas, key)
    return base.join(changed.select(key), key, "left_anti").select(*base.columns).unionByName(changed)


def bucket(kind: str) -> Column:
    """The fingerprint bucket of a key of this kind."""
    return F.pmod(F.xxhash64(*KEYS[kind]), F.lit(BUCKETS)).cast("int")


def fingerprints(accounts: DataFrame) -> DataFrame:
    """Number, sum and exclusive or of the row hashes of each bucket of each kind: one map-side aggregate."""
    # A null is hashed by its flag: xxhash64 alone skips it, so a value could move between columns unseen.
    row = F.xxhash64(*[x for c in _CONTENT for x in (F.col(c), F.col(c).isNull())])
    places = F.array(*[F.struct(F.lit(kind).alias("kind"), bucket(kind).alias("bucket")) for kind in KEYS])
    return (
        accounts.select(F.inline(places), row.alias("row"))
        .groupBy("kind", "bucket")
        .agg(F.count("*").alias("n_rows"), F.sum(F.col("row").cast("decimal(20,0)")).cast("decimal(38,0)").alias("total"), F.bit_xor("row").alias("mixed"))
    )


def touched_buckets(held: DataFrame, now: DataFrame) -> dict[str, list[int]]:
    """For each kind the buckets whose fingerprints differ. At most BUCKETS rows a kind reach the driver."""
    before, after = ({(r["kind"], r["bucket"]): tuple(r) for r in frame.collect()} for frame in (held, now))
    differing = sorted(k for k in before.keys() | after.keys() if before.get(k) != after.get(k))
    return {kind: [b for k, b in differing if k == kind] for kind in KEYS}


def within(kind: str, buckets: list[int] | None) -> Column:
    """Rows whose key of this kind lies in one of the buckets; None stands for all."""
    return F.lit(True) if buckets is None else bucket(kind).isin(buckets)

"""Type 2 history of accounts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.functions.measures import change_hash, moment
from ledgerlake.operators.dims import conform, next_key, with_surrogate_keys
from ledgerlake.operators.growth import merge_on_read
from ledgerlake.operators.lookup import hot_keys, key_counts, left_lookup
from ledgerlake.schemas import DIM_SCHEMAS, OPEN_END, UNKNOWN_KEY
from ledgerlake.session import stage

ACCOUNT_KEYS = ["bank_id", "account_number"]


def account_snapshot(accounts: DataFrame, banks: DataFrame, entities: DataFrame) -> DataFrame:
    """Accounts with bank and entity keys and the hash that decides on a new version."""
    entity_text = F.coalesce("entity_id", F.lit(""))
    rows = accounts.select("bank_id", "account_number", "entity_id")
    for side, key in ((banks.select("bank_id", "bank_key"), "bank_id"), (entities.select("entity_id", "entity_key"), "entity_id")):
        # A bank with a third of all accounts, or accounts without an entity, do not meet in one task.
        rows = left_lookup(rows, side, {key: key}, "account_number", hot_keys(key_counts(accounts, [key]), [key]))
    return (
        rows.where(F.col("bank_key").isNotNull())
        .select(
            "bank_id",
            "account_number",
            "bank_key",
            F.coalesce("entity_key", F.lit(UNKNOWN_KEY).cast("long")).alias("entity_key"),
            "entity_id",
            change_hash(F.col("bank_id"), F.col("account_number"), entity_text).alias("source_hash"),
        )
    )


def new_versions(snapshot: DataFrame, dim_account: DataFrame) -> DataFrame:
    """Snapshot rows without a current version of the same hash: new accounts and changed ones."""
    held = dim_account.where("is_current").select(*ACCOUNT_KEYS, "source_hash")
    return snapshot.join(held, [*ACCOUNT_KEYS, "source_hash"], "left_anti")


def type2_delta(
    dim_account: DataFrame, snapshot: DataFrame, started_at: datetime, held: DataFrame | None = None
) -> tuple[DataFrame | None, int]:
    """Closing rows of changed versions and their successors, and the number of both; None if there are none.

    A closing row carries the key of the version it closes at ``started_at``. Intervals are half
    open. Accounts missing from the snapshot stay current. ``held`` may name the part of
    ``dim_account`` that the snapshot can touch.
    """
    start, held = moment(started_at), dim_account if held is None else held
    opened = stage(new_versions(snapshot, held), "scd2")
    n_opened = opened.count()
    if n_opened == 0:
        return None, 0
    current = held.where(F.col("is_current") & (F.col("account_key") != UNKNOWN_KEY))
    closed = stage(
        current.join(opened.select(*ACCOUNT_KEYS), ACCOUNT_KEYS, "left_semi")
        .withColumn("effective_to", start)
        .withColumn("is_current", F.lit(False)),
        "scd2-closed",
    )
    added = (
        with_surrogate_keys(opened, ACCOUNT_KEYS, "account_key", next_key(dim_account, "account_key"))
        .withColumn("effective_from", start)
        .withColumn("effective_to", F.lit(OPEN_END).cast("timestamp_ntz"))
        .withColumn("is_current", F.lit(True))
    )
    ddl = DIM_SCHEMAS["dim_account"]
    return conform(closed, ddl).unionByName(conform(added, ddl)), n_opened + closed.count()


def type2_merge(dim_account: DataFrame, snapshot: DataFrame, started_at: datetime) -> tuple[DataFrame, int]:
    """The dimension with changed versions closed and their successors opened, and the number of both."""
    delta, touched = type2_delta(dim_account, snapshot, started_at)
    return (dim_account, 0) if delta is None else (merge_on_read(dim_account, [delta], "account_key"), touched)


def overlapping_versions(dim_account: DataFrame) -> DataFrame:
    """Versions that start before their predecessor ends; touching intervals are fine.

    The window is per account: a load adds at most one version to an account, so a
    partition never holds more rows than there were loads.
    """
    history = Window.partitionBy(*ACCOUNT_KEYS).orderBy("effective_from")
    return (
        dim_account.where(F.col("account_key") != UNKNOWN_KEY)
        .withColumn("previous_effective_to", F.lag("effective_to").over(history))
        .where("previous_effective_to > effective_from")
    )

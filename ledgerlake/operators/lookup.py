"""Left lookups that stay even when a few keys hold most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.session import stage

# A key is hot when it alone would fill this part of a task's even share of the rows.
# So there are at most HOT_PARTS x (shuffle width) hot keys, at every size.
HOT_PARTS = 8


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def key_counts(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows for each key, combined on the map side before they move; written once."""
    return stage(rows.groupBy(*keys).agg(F.count("*").alias("_rows")), "key-counts")


def hot_keys(counts: DataFrame, keys: list[str]) -> DataFrame:
    """The hot keys of :func:`key_counts`; null keys are spread anyway and are none."""
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    most = total // (HOT_PARTS * shuffle_width(counts))
    hot = counts.where(F.col("_rows") > most).select(*keys)
    for key in keys:
        hot = hot.where(F.col(key).isNotNull())
    return hot


def left_lookup(rows: DataFrame, side: DataFrame, on: dict[str, str], spread_by: str, hot: DataFrame) -> DataFrame:
    """Add the non-key columns of ``side``; ``on`` maps row columns to ``side`` columns, unique in ``side``.

    Rows of ``hot`` keys (under the names of ``side``) find their match in a broadcast
    of bounded size. In the join with the whole side, they and rows without a key carry
    a key that matches nothing and differs from row to row, so they spread over all
    tasks instead of meeting in one. The first key column must be text.
    """
    added = [c for c in side.columns if c not in on.values()]
    renamed = side.select(*[F.col(key).alias(f"_{key}") for key in on.values()], *added)
    first_column, first_key = next(iter(on.items()))
    found = hot.join(side, list(on.values()), "left").select(
        *[F.col(key).alias(f"_hot_{key}") for key in on.values()],
        *[F.col(name).alias(f"_hot_{name}") for name in added],
        F.lit(True).alias("_is_hot"),
    )
    hot_match = [F.col(column) == F.col(f"_hot_{key}") for column, key in on.items()]
    parts = 64 * shuffle_width(rows)
    spread = F.concat(F.lit("~"), F.pmod(F.xxhash64(spread_by), F.lit(parts)).cast("string"))
    # At most HOT_PARTS rows for each shuffle partition.
    marked = rows.join(F.broadcast(found), hot_match, "left").withColumn(
        "_cold", F.when(F.col("_is_hot") | F.col(first_column).isNull(), spread).otherwise(F.col(first_column))
    )
    cold_match = [F.col("_cold") == F.col(f"_{first_key}")] + [
        F.col(column) == F.col(f"_{key}") for column, key in list(on.items())[1:]
    ]
    joined = marked.join(renamed, cold_match, "left").withColumns(
        {name: F.coalesce(F.col(f"_hot_{name}"), F.col(name)) for name in added}
    )
    helpers = ["_is_hot", "_cold", *[f"_{key}" for key in on.values()], *[f"_hot_{c}" for c in side.columns]]
    return joined.drop(*helpers)

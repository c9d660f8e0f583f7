"""Dense numbering without a single-task window.

``row_number() over (order by ...)`` pulls all rows into one task, and a window
partitioned by a hot key pulls that key into one task. Here the rows are range
partitioned on the full sort key, so even one key holding a third of the rows is
spread over many tasks; each row's place inside its task is fixed by a written
table, and only one count per task is summed up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.session import stage

_TASK_BITS = 33  # monotonically_increasing_id: task index above, row position below


def dense_ordinal(
    df: DataFrame,
    order_by: list[str | Column],
    within: tuple[str, ...] = (),
    name: str = "ordinal",
) -> DataFrame:
    """Number rows 1..n in ``order_by`` order, restarting for each ``within`` group.

    ``order_by`` must be unique inside a group for a repeatable result.
    """
    sort = [*within, *order_by]
    placed = stage(
        df.repartitionByRange(*sort)
        .sortWithinPartitions(*sort)
        .withColumn("_slot", F.monotonically_increasing_id()),
        "ordinal",
    )
    task = F.shiftrightunsigned("_slot", _TASK_BITS)
    position = F.col("_slot").bitwiseAND(F.lit((1 << _TASK_BITS) - 1))
    # One row per write task, so both the window and the broadcast are bounded by the task count.
    before = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(task.alias("_task"))
        .agg(F.count("*").alias("_rows"))
        .select("_task", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    numbered = (
        placed.withColumn("_task", task)
        .join(F.broadcast(starts), "_task")
        .withColumn(name, F.col("_start") + position + 1)
        .drop("_start", "_slot")
    )
    if not within:
        return numbered.drop("_task")
    # A group's start is looked up by task and group, so the rows of a giant group stay spread.
    groups = [F.col(c).alias(f"_group{i}") for i, c in enumerate(within)]
    in_task = numbered.groupBy(F.col("_task").alias("_in"), *groups).agg(F.min(name).alias("_first"))
    whole = Window.partitionBy(*[f"_group{i}" for i in range(len(within))])  # one row per task that holds the group
    starts = in_task.withColumn("_start", F.min("_first").over(whole)).drop("_first")
    match = [F.col("_task") == F.col("_in")] + [F.col(c).eqNullSafe(F.col(f"_group{i}")) for i, c in enumerate(within)]
    return numbered.join(starts, match).withColumn(name, F.col(name) - F.col("_start") + 1).select(*df.columns, name)


def dense_rank_desc(df: DataFrame, value: str, name: str) -> DataFrame:
    """Dense rank by ``value``, largest first.

    Only the distinct values are numbered. k distinct positive counts add up to at
    least k(k+1)/2, so this lookup stays tiny against the rows it was counted from;
    the planner broadcasts it when its written size allows.
    """
    ranks = dense_ordinal(df.select(value).distinct(), [F.desc(value)], name=name)
    return df.join(ranks, value, "left")


def file_ordinal(df: DataFrame, name: str = "landing_row_id") -> DataFrame:
    """Number the rows of a file read in file order.

    ``df`` must come straight from a file reader. Files rank by path and splits by
    offset; a split's rows are contiguous in its task, so a row's number is the
    rows in earlier splits plus its place in its own split.
    """
    placed = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_slot"),
    )
    # One row per input split: a few MB even for a million splits, so it travels to the rows.
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = (
        placed.groupBy("_file", "_block")
        .agg(F.count("*").alias("_rows"), F.min("_slot").alias("_first"))
        .select(
            "_file",
            "_block",
            "_first",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
        )
    )
    return (
        placed.join(F.broadcast(splits), ["_file", "_block"])
        .withColumn(name, F.col("_start") + F.col("_slot") - F.col("_first") + 1)
        .drop("_file", "_block", "_slot", "_first", "_start")
    )

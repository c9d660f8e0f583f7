"""Pattern text files: BEGIN/END blocks of CSV lines.

The file is read line by line and never grouped by attempt, so a block may be as
long as it likes. Within an input split a window keeps the running state; between
splits only one summary row per split is carried forward. Split size, set by
``spark.sql.files.maxPartitionBytes``, bounds every window partition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.schemas import TRANSACTION_FIELDS
from ledgerlake.session import stage

# Block markers.
BEGIN = "BEGIN LAUNDERING ATTEMPT - "
END = "END LAUNDERING ATTEMPT - "

_SPLIT = ["_file", "_block"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    text = F.regexp_replace("value", r"^[\s\x{FEFF}]+|\s+\z", "")
    begins, ends = F.col("line").startswith(BEGIN), F.col("line").startswith(END)
    return (
        spark.read.text(path)
        .select(
            text.alias("line"),
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block"),
            F.monotonically_increasing_id().alias("_slot"),
        )
        .where("line <> ''")
        .withColumn("is_begin", begins)
        .withColumn("is_end", ends)
        .withColumn(
            "header",
            F.when(begins, F.trim(F.regexp_replace("line", f"^{BEGIN}", ""))).when(ends, F.lit("")),
        )
    )


def _marked(lines: DataFrame) -> DataFrame:
    """Every line with the header of its block ('' outside) and the number of its attempt."""
    here = Window.partitionBy(*_SPLIT).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    local = lines.withColumn("begins_here", F.sum(F.col("is_begin").cast("long")).over(here)).withColumn(
        "header_here", F.last("header", ignorenulls=True).over(here)
    )
    # One row per split.
    earlier = Window.orderBy(*_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy(*_SPLIT).agg(
        F.sum(F.col("is_begin").cast("long")).alias("begins"),
        F.max_by("header", F.when(F.col("header").isNotNull(), F.col("_slot"))).alias("last_header"),
    )
    carried = splits.select(
        *_SPLIT,
        F.coalesce(F.sum("begins").over(earlier), F.lit(0)).alias("begins_before"),
        F.last("last_header", ignorenulls=True).over(earlier).alias("header_before"),
    )
    return local.join(carried, _SPLIT).select(
        *_SPLIT,
        "_slot",
        "line",
        "is_begin",
        "is_end",
        (F.col("begins_here") + F.col("begins_before")).alias("attempt_id"),
        F.coalesce("header_here", "header_before", F.lit("")).alias("description"),
    )


def _with_sequence(marked: DataFrame) -> DataFrame:
    """Place of each accepted line in its attempt: accepted lines so far less those before its BEGIN."""
    here = Window.partitionBy(*_SPLIT).orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0)
    counted = marked.withColumn("so_far", F.sum(F.col("accepted").cast("long")).over(here)).withColumn(
        "at_begin", F.last(F.when(F.col("is_begin"), F.col("so_far")), ignorenulls=True).over(here)
    )
    earlier = Window.orderBy(*_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    splits = counted.groupBy(*_SPLIT).agg(
        F.max("so_far").alias("accepted_rows"),
        F.max("at_begin").alias("last_begin"),
    )
    totals = splits.withColumn("rows_before", F.coalesce(F.sum("accepted_rows").over(earlier), F.lit(0)))
    carried = totals.select(
        *_SPLIT,
        "rows_before",
        F.last(F.col("last_begin") + F.col("rows_before"), ignorenulls=True).over(earlier).alias("begin_before"),
    )
    total = F.col("so_far") + F.col("rows_before")
    begin = F.coalesce(F.col("at_begin") + F.col("rows_before"), "begin_before", F.lit(0))
    return counted.join(carried, _SPLIT).withColumn("sequence", total - begin)


def read_pattern_blocks(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(pattern landing rows, rejected lines) of a pattern file or a folder of its parts in name order."""
    schema = ", ".join(f"{name} string" for name in TRANSACTION_FIELDS) + ", broken string"
    parsed = F.from_csv("line", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "broken"})
    data = ~F.col("is_begin") & ~F.col("is_end")
    fields = _marked(_lines(spark, path)).withColumn("fields", F.when(data, parsed))
    whole = data & F.col("fields.broken").isNull()
    inside = F.col("description") != ""
    marked = stage(
        fields.withColumn("accepted", whole & inside).withColumn(
            "error_code",
            F.when(data & ~inside, "PATTERN_LINE_OUTSIDE_BLOCK").when(data & ~whole, "PATTERN_FIELD_COUNT"),
        ),
        "pattern-lines",
    )
    rows = (
        _with_sequence(marked)
        .where("accepted")
        .select(
            F.col("attempt_id").cast("string").alias("pattern_attempt_id_text"),
            F.upper(F.trim(F.substring_index("description", ":", 1))).alias("pattern_type_text"),
            F.col("description").alias("pattern_description_text"),
            F.col("sequence").cast("string").alias("pattern_sequence_text"),
            *[F.col(f"fields.{name}").alias(name) for name in TRANSACTION_FIELDS],
        )
    )
    rejected = marked.where("error_code is not null").select("error_code", F.col("line").alias("raw_payload"))
    return rows, rejected


def write_pattern_blocks(patterns: DataFrame, path: str) -> None:
    """Write pattern landing rows as block text, the inverse of the reader."""
    place = ["attempt", "step", "sequence"]
    attempt = F.col("pattern_attempt_id_text").cast("long").alias("attempt")
    header = F.col("pattern_description_text")
    none = F.lit(0).cast("long").alias("sequence")
    heads = patterns.select(attempt, header.alias("header")).distinct()
    lines = patterns.select(
        attempt,
        F.lit(1).alias("step"),
        F.col("pattern_sequence_text").cast("long").alias("sequence"),
        F.concat_ws(",", *TRANSACTION_FIELDS).alias("line"),
    )
    begins = heads.select("attempt", F.lit(0).alias("step"), none, F.concat(F.lit(BEGIN), "header").alias("line"))
    ends = heads.select("attempt", F.lit(2).alias("step"), none, F.concat(F.lit(END), "header").alias("line"))
    ordered = begins.unionByName(lines).unionByName(ends).repartitionByRange(*place).sortWithinPartitions(*place)
    ordered.select("line").write.text(path)

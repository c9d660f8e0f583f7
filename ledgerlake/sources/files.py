"""Landing files: CSV readers and the file manifest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.ordinals import file_ordinal
from ledgerlake.schemas import ACCOUNT_FIELDS, PATTERN_FIELDS, TRANSACTION_FIELDS, text_schema


def _read_csv(spark: SparkSession, path: str, fields: list[str]) -> DataFrame:
    # The given schema stands in for the header, which repeats a column name.
    return (
        spark.read.schema(text_schema(fields))
        .option("header", True)
        .option("enforceSchema", True)
        .option("encoding", "UTF-8")
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_accounts(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, ACCOUNT_FIELDS)


def read_transactions(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, TRANSACTION_FIELDS)


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, PATTERN_FIELDS)


def landing_from_csv(spark: SparkSession, accounts: str, transactions: str, patterns: str) -> dict[str, DataFrame]:
    """The three landing frames of a source folder, numbered in file order."""
    return {
        "account": file_ordinal(read_accounts(spark, accounts)),
        "transaction": file_ordinal(read_transactions(spark, transactions)),
        "pattern": file_ordinal(read_patterns(spark, patterns)),
    }


#: Lines under one node of the digest tree, and nodes under the next one.
DIGEST_FAN = 4096


def ordered_digest(lines: DataFrame, place: str = "place", value: str = "value") -> DataFrame:
    """One row (digest, line_count): a tree of SHA-256 digests over lines numbered from 1.

    A line's digest goes, in order, into that of its block of DIGEST_FAN lines, a block's into
    that of its group of DIGEST_FAN blocks, and the groups' into the digest of the whole. Blocks
    follow line numbers, so the result does not depend on how files were split, a swapped pair
    of lines changes it, and no task holds more than one node's children. No lines give the
    digest of the empty text. Between the levels digests travel as 32 bytes, not as their text.
    """
    level = lines.select((F.col(place) - 1).alias("at"), F.unhex(F.sha2(F.coalesce(value, F.lit("")), 256)).alias("digest"))
    counted = None
    for _ in range(2):
        nodes = level.groupBy(F.expr(f"at div {DIGEST_FAN}").alias("node")).agg(
            F.unhex(_in_order()).alias("digest"), F.count("*").alias("n") if counted is None else F.sum("n").alias("n")
        )
        counted = level = nodes.select(F.col("node").alias("at"), "digest", "n")
    return level.agg(_in_order().alias("digest"), F.coalesce(F.sum("n"), F.lit(0)).alias("line_count"))


def _in_order() -> Column:
    children = F.sort_array(F.collect_list(F.struct("at", "digest")))
    return F.sha2(F.array_join(F.transform(children, lambda x: F.lower(F.hex(x["digest"]))), ""), 256)


def manifest(spark: SparkSession, expected: dict[str, tuple]) -> DataFrame:
    """Per source: expected and actual bytes and digest, lines, and a status.

    ``expected`` maps a source name to its path (file or folder), its size and, if known, its
    :func:`ordered_digest`. A source of the right size whose lines differ or stand in another
    order is a DIGEST_MISMATCH. ``binaryFile`` lists sizes only, as the content column is never
    selected.
    """
    result = None
    for name, (path, size, *digest) in expected.items():
        part = _manifest_row(spark, name, path, size, digest[0] if digest else None)
        result = part if result is None else result.unionByName(part)
    return result


def _manifest_row(spark: SparkSession, name: str, path: str, expected: int, expected_digest: str | None) -> DataFrame:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path):
        row = (name, expected, 0, 0, expected_digest, None, "MISSING")
        return spark.createDataFrame([row], _MANIFEST)
    size = spark.read.format("binaryFile").load(path).agg(F.sum("length").alias("actual_bytes"))
    lines = ordered_digest(file_ordinal(spark.read.text(path), "place"))
    right_size = F.col("actual_bytes") == F.col("expected_bytes")
    other = F.col("expected_digest").isNotNull() & (F.col("digest") != F.col("expected_digest"))
    return (
        size.crossJoin(lines)
        .withColumn("source_name", F.lit(name))
        .withColumn("expected_bytes", F.lit(expected).cast("long"))
        .withColumn("expected_digest", F.lit(expected_digest).cast("string"))
        .withColumn("status", F.when(~right_size, "SIZE_MISMATCH").when(other, "DIGEST_MISMATCH").otherwise("OK"))
        .select("source_name", "expected_bytes", "actual_bytes", "line_count", "expected_digest", "digest", "status")
    )


_MANIFEST = (
    "source_name string, expected_bytes long, actual_bytes long, line_count long, expected_digest string, digest string, status string"
)

"""From raw documents to packed training sequences, in five stages over whole tables.

Each stage reads the Parquet files that the one before wrote to the shared folder, so a lost
executor costs the stage it worked on at most. All stages but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.common import numbered, odd_ids, stage
from ledgerlake.llm.language import accepted_languages
from ledgerlake.llm.ngram_join import near_duplicates
from ledgerlake.llm.packing import pack_documents
from ledgerlake.llm.spaced_seeds import without_overlap
from ledgerlake.llm.suffix_array import drop_repeated_bytes

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents without letters, or unlike every learned language, go."""
    return accepted_languages(docs.select(*COLUMNS))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: of each class of near duplicates the document of the smallest id stays.

    Rows without an id count as larger than all others; of rows that share an id, or have none,
    the first in a written copy counts as smaller.
    """
    docs = docs.select(*COLUMNS)
    if odd_ids(docs, "doc_id"):
        docs = numbered(docs, "doc_id", "_row", "pipeline-rows")
    else:
        docs = docs.withColumn("_row", F.col("doc_id"))
    first = near_duplicates(docs, id_col="_row").filter("is_first").select(F.col("doc_id").alias("_row"))
    return docs.join(first.hint("shuffle_hash"), "_row", "left_semi").select(*COLUMNS)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: passages of 50 bytes or more that a smaller document holds are cut out.

    A document of which nothing is left goes; n_chars is counted anew.
    """
    cut = drop_repeated_bytes(docs, as_text=True, carried=("lang", "source")).filter("n_bytes = 0 or n_removed < n_bytes")
    return cut.select("doc_id", F.col("kept").alias("text"), "rest.lang", "rest.source", F.length("kept").cast("long").alias("n_chars"))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that overlap a benchmark item go."""
    return without_overlap(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: pieces of token ids and their places in the training sequences."""
    return pack_documents(docs)


STAGES = [
    ("language", known_languages),
    ("near_duplicates", one_of_each),
    ("repeated_passages", without_repeats),
    ("benchmark", without_benchmark),
    ("packing", packed_sequences),
]
#: The stages learn, hash and tokenize, which SQL cannot express; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces that the last stage makes of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)

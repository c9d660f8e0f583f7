"""Insert-if-absent for numbered rows, decided by words of bits before any row moves.

A word tells for 64 neighbouring numbers which of them occur: two bits a number where numbers are
dense, 16 bytes for one that stands alone. Two sets are compared word by word and summed up over at
most BLOCKS ranges of numbers: where no number of a range is held, its rows pass; where all are held,
its rows go; only rows of ranges that are held in part meet the held words. A rerun and a true
increment therefore shuffle words, and no row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = "_word long, _bits long"
FRESH, HELD, MIXED = "fresh", "held", "mixed"
#: Ranges a comparison tells apart; their states, one short row each, pass through the driver.
BLOCKS = 4096


def word_of(number: Column) -> Column:
    return F.shiftright(number.cast("long"), 6)


def _place(key: str) -> Column:
    return F.col(key).cast("long").bitwiseAND(F.lit(63)).cast("int")


def bit_of(key: str) -> Column:
    """The word in which only this number's bit is set."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), _place(key))


def marks(rows: DataFrame, key: str) -> DataFrame:
    """The non-null numbers of ``key`` as word and bit, one row each; what follows combines them in each task."""
    return rows.where(F.col(key).isNotNull()).select(word_of(F.col(key)).alias("_word"), bit_of(key).alias("_bits"))


def merged(parts: DataFrame) -> DataFrame:
    """One word for each 64 numbers out of marks or several sets of words."""
    return parts.groupBy("_word").agg(F.bit_or("_bits").alias("_bits"))


def words(rows: DataFrame, key: str) -> DataFrame:
    """The numbers of ``key`` as one word of bits for each 64."""
    return merged(marks(rows, key))


def block_states(incoming: DataFrame, held: DataFrame, block: Column) -> DataFrame:
    """For each range of the incoming marks: are none, all or some of its numbers held?"""
    new, old = (F.bit_or(F.when(F.col("_side") == side, F.col("_bits"))) for side in (0, 1))
    sides = incoming.withColumn("_side", F.lit(0)).unionByName(held.withColumn("_side", F.lit(1)))
    pairs = sides.groupBy("_word").agg(new.alias("_new"), F.coalesce(old, F.lit(0)).alias("_old")).where("_new is not null")
    both = F.col("_new").bitwiseAND(F.col("_old"))
    told = pairs.select(block.alias("_block"), (both == 0).alias("_none"), (both == F.col("_new")).alias("_whole"))
    state = F.when(F.every("_none"), FRESH).when(F.every("_whole"), HELD).otherwise(MIXED)
    return told.groupBy("_block").agg(state.alias("_state"))


def _clear(rows: DataFrame, key: str, held: DataFrame) -> DataFrame:
    """Rows with ``_word`` whose bit is not set in the held word."""
    bit = F.coalesce(F.getbit(F.col("_bits"), _place(key)), F.lit(0))
    return rows.join(held, "_word", "left").where(bit == 0)


def unheld(rows: DataFrame, key: str, held: DataFrame | None) -> DataFrame:
    """Rows whose ``key`` is not among the ``held`` numbers (marks or words; None: nothing is held).

    A null key is never held. Rows that repeat a key pass or go together. ``rows`` is read twice
    for its keys and once or twice for the rows, and ``held`` once or twice; written tables suit.
    """
    if held is None:
        return rows
    low, high = rows.agg(F.min(key).cast("long"), F.max(key).cast("long")).first()
    if low is None:
        return rows
    first, width = low >> 6, ((high >> 6) - (low >> 6)) // BLOCKS + 1
    block = F.expr(f"(_word - {first}) div {width}")  # whole numbers; word numbers have 58 bits
    told = block_states(marks(rows, key), held, block).collect()  # at most BLOCKS short rows
    found = {state for _, state in told}
    if found <= {FRESH}:
        return rows
    if found == {HELD}:
        return rows.where(F.col(key).isNull())
    columns = rows.columns
    numbered = rows.withColumn("_word", word_of(F.col(key))).withColumn("_block", block)
    states = rows.sparkSession.createDataFrame(told, "_block long, _state string")
    placed = numbered.join(F.broadcast(states), "_block", "left")
    fresh = placed.where(F.coalesce("_state", F.lit(FRESH)) == FRESH).select(columns)
    if MIXED not in found:
        return fresh
    partly = placed.where(F.col("_state") == MIXED).select(*columns, "_word")
    part = F.broadcast(states.where(F.col("_state") == MIXED).select("_block"))
    needed = merged(held).withColumn("_block", block).join(part, "_block", "left_semi").drop("_block")
    return fresh.unionByName(_clear(partly, key, needed).select(columns))

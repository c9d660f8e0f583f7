"""Filter interaction audit on sorted posting lists.

For each part and range of ids every filter leaves the sorted list of the rows that fail it.
Galloping merges give the union of each set of filters; its sizes, summed over the ranges, hold
all there is to know: what a filter removes at a step of an order is the difference of two unions.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import stage
from ledgerlake.operators.lookup import hot_keys, key_counts, left_lookup

_WORD_BREAK = r"[\x20\x09-\x0D]+"
_BLOCK = 256  # ids looked up behind one gallop
SIZES = "docs long, good long, toxic long"
RESULT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, "
    "unique_fails long, good_lost long, toxic_lost long, shapley long"
)


def text_filters(text: str = "text") -> dict[str, Column]:
    """The failure conditions A to D of a text; null counts as empty."""
    body = F.coalesce(F.col(text), F.lit(""))
    inner = F.btrim(body, F.lit(" \t\n\x0b\f\r"))
    words = F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, _WORD_BREAK))
    capitals = F.length(F.regexp_replace(body, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": capitals * 100 > F.length(body) * 3,
        "D": body.rlike("[#$%&*|]"),
    }


def failing_rows(
    docs: DataFrame, filters: dict[str, Column], copies: str | None, id_col: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """(id, part, digest, rows, one boolean for each filter): equal rows as one with their number.

    ``copies`` names a further filter, which a row fails if a row of a smaller id has the same
    text; texts are compared by their SHA-256. The first holder of a text is found by a map-side
    minimum and looked up by text and id together, so a text that fills a third of the table
    meets nowhere.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    facts = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.coalesce(F.col(part), F.lit("")).alias("part"),
        F.sha2(body, 256).alias("digest"),
        *[fails.alias(name) for name, fails in filters.items()],
    )
    rows = stage(facts.groupBy(*facts.columns).agg(F.count("*").alias("rows")), "audit-rows")
    if not copies:
        return rows
    key = F.concat("digest", F.lit(":"), F.col("id").cast("string"))
    firsts = rows.groupBy("digest").agg(F.min("id").alias("id")).select(key.alias("_key"), F.lit(True).alias("_first"))
    # A row without an id is no copy of a smaller one; its key matches nothing.
    held = rows.withColumn("_key", F.coalesce(key, F.concat(F.lit("~"), "digest"))).join(firsts, "_key", "left")
    return held.withColumn(copies, F.col("id").isNotNull() & F.col("_first").isNull()).drop("_key", "_first")


def with_labels(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``rows`` with ``good`` and ``toxic``: whether any label of the id says so."""
    marks = labels.groupBy(F.col(id_col).cast("string").alias("_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    keyed = rows.withColumn("_id", F.col("id").cast("string"))
    found = left_lookup(keyed, marks, {"_id": "_id"}, "digest", hot_keys(key_counts(keyed, ["_id"]), ["_id"]))
    return found.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in ("good", "toxic")}).drop("_id")


def gallop(held: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Where each of the sorted ``ids`` belongs in the sorted ``held``.

    From the place of the block before, the step doubles until it passes the block's last id;
    only the stretch in between is searched.
    """
    out, low = np.empty(len(ids), np.int64), 0
    for at in range(0, len(ids), _BLOCK):
        block, reach = ids[at : at + _BLOCK], 1
        while low + reach < len(held) and held[low + reach] < block[-1]:
            reach *= 2
        out[at : at + len(block)] = low + np.searchsorted(held[low : low + reach + 1], block)
        low = int(out[at + len(block) - 1])
    return out


def merged(held: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The sorted union of two sorted lists."""
    if len(ids) > len(held):
        held, ids = ids, held
    if not len(ids):
        return held
    place = gallop(held, ids)
    new = held[np.minimum(place, len(held) - 1)] != ids
    return np.insert(held, place[new], ids[new])


def unions(lists: list[np.ndarray]) -> list[np.ndarray]:
    """The union of every set of lists; bit i of a set's number stands for list i."""
    out = [np.empty(0, np.int64)]
    for x in lists:
        out += [merged(held, x) for held in out]
    return out


def union_sizes(rows: DataFrame, names: str) -> DataFrame:
    """(part, filters, docs, good, toxic): for each set of filters the rows that fail any of them.

    Rows come sorted by part and id, and each batch of them is a range of ids with its own
    posting lists, so a part of any size is spread over tasks. Set 0 holds the whole part.
    """

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], np.ndarray] = {}
        for batch in batches:
            parts = np.array(batch.column("part").to_pylist(), object)
            fails = {n: batch.column(n).to_numpy(zero_copy_only=False) for n in names}
            rows = batch.column("rows").to_numpy()
            marks = [batch.column(c).to_numpy(zero_copy_only=False) for c in ("good", "toxic")]
            weights = np.stack([rows, *(rows * m for m in marks)], 1)
            cuts = [0, *(np.flatnonzero(parts[1:] != parts[:-1]) + 1).tolist(), len(parts)] if len(parts) else []
            for lo, hi in zip(cuts, cuts[1:]):
                sets = unions([np.flatnonzero(fails[n][lo:hi]) + lo for n in names])
                for number, ids in enumerate(sets):
                    key = (parts[lo], number)
                    found[key] = found.get(key, 0) + (weights[ids].sum(0) if number else weights[lo:hi].sum(0))
            if len(found) > 1 << 16:  # very many parts: send what is summed so far
                yield _table(found)
                found = {}
        yield _table(found)

    def _table(found: dict) -> pa.RecordBatch:
        columns = [pa.array([p for p, _ in found], pa.string()), pa.array([s for _, s in found], pa.int32())]
        numbers = np.array(list(found.values()), np.int64).reshape(-1, 3)
        columns += [pa.array(numbers[:, i]) for i in range(3)]
        return pa.RecordBatch.from_arrays(columns, ["part", "filters", "docs", "good", "toxic"])

    order = ["part", "id", "digest"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("part", "rows", "good", "toxic", *names)
    summed = ordered.mapInArrow(sizes, f"part string, filters int, {SIZES}")
    return summed.groupBy("part", "filters").agg(*[F.sum(c).alias(c) for c in ("docs", "good", "toxic")])


def interactions(sizes: DataFrame, names: str) -> DataFrame:
    """One row for each part, order of the filters and step, from the sizes of the unions."""
    orders = ["".join(x) for x in permutations(names)]
    everything = (1 << len(names)) - 1

    def audit(table: pa.Table) -> pa.Table:
        size = {s: np.array(x) for s, *x in zip(*(table.column(c).to_pylist() for c in ("filters", "docs", "good", "toxic")))}
        total, size[0] = size[0][0], np.zeros(3, np.int64)
        steps, removed_by = [], dict.fromkeys(names, 0)
        for order in orders:
            before = 0
            for step, name in enumerate(order, 1):
                bit = 1 << names.index(name)
                lost = size[before | bit] - size[before]
                steps.append((order, step, bit, before, lost))
                removed_by[name] += int(lost[0])
                before |= bit
        part = table.column("part")[0].as_py()
        out = [
            (
                part, order, step, int(total - size[before | bit][0]), int(lost[0]), int(size[bit][0] - lost[0]),
                int(size[everything][0] - size[everything ^ bit][0]), int(lost[1]), int(lost[2]), removed_by[order[step - 1]],
            )
            for order, step, bit, before, lost in steps
        ]
        kinds = [pa.string(), pa.string(), pa.int32(), *[pa.int64()] * 7]
        return pa.Table.from_arrays([pa.array(x, k) for x, k in zip(zip(*out), kinds)], [x.split()[0] for x in RESULT.split(", ")])

    # At most 2^filters rows for each part.
    return sizes.groupBy("part").applyInArrow(audit, RESULT)


def op13_filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Five filters in all 120 orders, for each language.

    A null text is empty, a null language the part of the empty name. A repeated id keeps each of
    its rows; rows of one id are no smaller copies of each other, and a row without an id neither
    is a copy nor has one. A label counts if any row of its id carries it. An empty table gives
    no row; other columns are ignored. Texts of any length are judged whole.
    """
    names = "ABCDE"
    rows = with_labels(failing_rows(docs, text_filters(), copies="E"), labels)
    return interactions(union_sizes(rows, names), names)

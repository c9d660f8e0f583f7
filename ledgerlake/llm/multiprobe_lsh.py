"""Approximate nearest neighbours by cosine with multiprobe p-stable hashing.

Vectors are scaled to length 1, so cosine and Euclidean distance order them alike. A table
hashes a vector to floor((a.v + b) / w) in a few Gaussian directions a. A query visits, in
every table, the perturbed buckets of highest estimated success: the chance, by how close the
query lies to each slot's edges, that a neighbour at the expected distance falls there. What
the tables yield is merged and ranked by exact cosine. A query that found fewer than were
asked for, though there are more candidates, is compared with every vector, in blocks.

Equal vectors are one entry with their smallest ids, so a very common vector costs one row. A
bucket with too many different vectors is cut into parts that get the same probes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product
from math import erf, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import binary, stage

TABLES, HASHES, SLOT, PROBES = 8, 6, 1.5, 160
NEIGHBOUR_DISTANCE = 1.05  # at which a probe's success is estimated
GROUP_ROWS = 8192  # vectors of one table that are searched together
_SEED, _BASE, _HALF = 20, 64, 32


class Hashes:
    """The directions of all tables, fixed by the seed and the vectors' length."""

    def __init__(self, size: int, tables: int = TABLES, hashes: int = HASHES, slot: float = SLOT):
        rng = np.random.default_rng(_SEED)
        self.directions = rng.normal(size=(tables, hashes, size))
        self.shifts = rng.uniform(0, slot, (tables, hashes))
        self.tables, self.hashes, self.slot = tables, hashes, slot
        self.steps = np.array(list(product((-1, 0, 1), repeat=hashes)))
        self.weights = _BASE ** np.arange(hashes, dtype=np.int64)

    def places(self, unit: np.ndarray, table: int) -> np.ndarray:
        return (unit @ self.directions[table].T + self.shifts[table]) / self.slot

    def codes(self, places: np.ndarray) -> np.ndarray:
        return (np.clip(np.floor(places), -_HALF + 1, _HALF - 2).astype(np.int64) + _HALF) @ self.weights

    def probes(self, places: np.ndarray, count: int) -> np.ndarray:
        """Codes of the ``count`` most promising buckets of each row, best first."""
        inside = places - np.floor(places)
        spread = NEIGHBOUR_DISTANCE / self.slot * sqrt(2)
        below = 0.5 * (1 + np.vectorize(erf)(-inside / spread))
        above = 0.5 * (1 - np.vectorize(erf)((1 - inside) / spread))
        chance = np.log(np.maximum(np.stack([below, 1 - below - above, above], -1), 1e-12))
        total = sum(chance[:, m, :][:, self.steps[:, m] + 1] for m in range(self.hashes))
        best = np.argsort(-total, axis=1, kind="stable")[:, :count]
        return self.codes(places)[:, None] + (self.steps @ self.weights)[best]


def _matrix(column: pa.Array, kind: str) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)


def _unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)  # neither overflow nor underflow
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def _usable(vectors: DataFrame, id_col: str, vector: str) -> tuple[DataFrame, int, str]:
    """(id, v) of the vectors that take part, their length and the type of their numbers."""
    kind = "<f4" if vectors.schema[vector].dataType.elementType.typeName() == "float" else "<f8"
    number = "float" if kind == "<f4" else "double"
    v = F.col(vector).cast(f"array<{number}>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    some = F.exists(v, lambda x: x != 0)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v")).filter(
        F.col("id").isNotNull() & v.isNotNull() & finite & some
    )
    sizes = rows.groupBy(F.size("v").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = sizes[0]["size"] if sizes else 0
    return rows.filter(F.size("v") == size), size, kind


def _merged(kind: str, most: int):
    """Equal vectors of a task as one row with their smallest ids."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[bytes, list[int]] = {}
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(kind) + 0.0  # -0 becomes 0
            raw = flat.astype(kind).reshape(batch.num_rows, -1) if batch.num_rows else flat.reshape(0, 1)
            for key, number in zip((x.tobytes() for x in raw), batch.column("id").to_pylist()):
                found.setdefault(key, []).append(number)
            ids = [sorted(x)[:most] for x in found.values()]
            yield pa.RecordBatch.from_arrays([binary(list(found)), pa.array(ids, pa.list_(pa.int64()))], ["v", "ids"])

    return work


_ROWS = "kind int, part int, code long, ids array<long>, codes array<long>, v binary"
_NAMES = [x.split()[0] for x in _ROWS.split(", ")]


def _part(codes: np.ndarray, table: int, parts: int) -> np.ndarray:
    mixed = (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    return (table * parts + (mixed % np.uint64(parts)).astype(np.int64)).astype(np.int32)


def _entries(hashes: Hashes, kind: str, parts: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            unit = _unit(_matrix(batch.column("v"), kind))
            nothing = pa.array([None] * batch.num_rows, pa.list_(pa.int64()))
            for table in range(hashes.tables):
                codes = hashes.codes(hashes.places(unit, table))
                columns = [pa.array(np.zeros(len(codes), np.int32)), pa.array(_part(codes, table, parts)), pa.array(codes)]
                yield pa.RecordBatch.from_arrays([*columns, batch.column("ids"), nothing, batch.column("v")], _NAMES)

    return work


def _probed(hashes: Hashes, kind: str, parts: int, probes: int):
    """For each query and part of a table, the codes to visit there."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                flat = rows.column("v").flatten().to_numpy(zero_copy_only=False).astype(kind)
                raw = flat.reshape(rows.num_rows, -1)
                unit, ids = _unit(raw.astype(np.float64)), rows.column("id").to_pylist()
                out: list[tuple] = []
                for table in range(hashes.tables):
                    codes = hashes.probes(hashes.places(unit, table), probes)
                    where = _part(codes.ravel(), table, parts).reshape(codes.shape)
                    for i in range(len(ids)):
                        for part in np.unique(where[i]):
                            out.append((1, int(part), None, [ids[i]], codes[i][where[i] == part].tolist(), raw[i].tobytes()))
                types = (pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], _NAMES)

    return work


def _ranked(kind: str, nearest: int):
    """Exact cosine of what the probes of each query find in this part of a table.

    Probes without codes visit all of it.
    """

    def work(table: pa.Table) -> pa.Table:
        role = table.column("kind").to_numpy()
        entries, probes = table.filter(pa.array(role == 0)), table.filter(pa.array(role == 1))
        out: list[tuple] = []
        if entries.num_rows and probes.num_rows:
            codes = entries.column("code").to_numpy()
            order = np.argsort(codes, kind="stable")
            codes = codes[order]
            vectors = _matrix(entries.column("v"), kind)[order]
            unit, ids = _unit(vectors), entries.column("ids").to_pylist()
            lengths = np.sqrt((vectors * vectors).sum(1))
            queries = _matrix(probes.column("v"), kind)
            query_units = _unit(queries)
            for i, ([own], wanted) in enumerate(zip(probes.column("ids").to_pylist(), probes.column("codes").to_pylist())):
                if wanted is None:
                    everywhere, near = np.arange(len(unit)), unit @ query_units[i]
                else:
                    lo, hi = np.searchsorted(codes, wanted), np.searchsorted(codes, wanted, "right")
                    found = [np.arange(a, b) for a, b in zip(lo, hi) if b > a]
                    if not found:
                        continue
                    everywhere = np.concatenate(found)
                    near = unit[everywhere] @ query_units[i]
                q = queries[i]
                length = np.sqrt((q * q).sum())
                most = nearest + 1  # one more than asked for, as the query itself may be among them
                while True:
                    at = everywhere
                    if len(at) > most:
                        at = at[near >= np.partition(near, -most)[-most] - 1e-9]
                    with np.errstate(over="ignore", invalid="ignore"):
                        scores = (vectors[at] * q).sum(1) / (lengths[at] * length)
                    odd = ~np.isfinite(scores) | (lengths[at] == 0)
                    scores[odd] = (unit[at[odd]] * query_units[i]).sum(1)
                    best: dict[int, float] = {}  # each id with its best score
                    for s, x in sorted((-s, x) for s, place in zip(scores.tolist(), order[at].tolist()) for x in ids[place] if x != own):
                        best.setdefault(x, -s)
                    if len(best) >= nearest or len(at) == len(everywhere):
                        break
                    most *= 4  # ids repeat with different vectors
                out += [(own, x, s) for x, s in list(best.items())[:nearest]]
        columns = list(zip(*out)) or [(), (), ()]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "vec_id": pa.array(columns[1], pa.int64()), "score": pa.array(columns[2], pa.float64())})

    return work


_FOUND = "query_id long, vec_id long, score double"


def _best(found: DataFrame, nearest: int) -> DataFrame:
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", rank).filter(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def _compared_with_all(index: DataFrame, asked: DataFrame, kind: str, nearest: int, parts: int, group_rows: int) -> DataFrame:
    """What each asked query finds among all vectors: blocks of vectors against blocks of queries."""
    sets = max(1, -(-asked.count() // group_rows))
    none, no_codes = F.lit(None).cast("long"), F.lit(None).cast("array<long>")
    part = F.pmod(F.xxhash64("v"), F.lit(parts)).cast("int")
    entries = index.select(F.lit(0).alias("kind"), part.alias("part"), F.lit(0).cast("long").alias("code"), "ids", no_codes.alias("codes"), "v")
    entries = entries.withColumn("cut", F.explode(F.sequence(F.lit(0), F.lit(sets - 1))))

    def raw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat = batch.column("v").flatten().to_numpy(zero_copy_only=False).astype(kind)
            rows = flat.reshape(batch.num_rows, -1) if batch.num_rows else flat.reshape(0, 1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), binary([x.tobytes() for x in rows])], ["id", "v"])

    queries = asked.select("id", "v").mapInArrow(raw, "id long, v binary").withColumn("cut", F.pmod(F.xxhash64("id", "v"), F.lit(sets)).cast("int"))
    sent = queries.select(
        F.lit(1).alias("kind"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"), none.alias("code"), F.array("id").alias("ids"), no_codes.alias("codes"), "v", "cut"
    )
    return entries.unionByName(sent).groupBy("part", "cut").applyInArrow(_ranked(kind, nearest), _FOUND)


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column,
    nearest: int = 5,
    id_col: str = "vec_id",
    vector: str = "embedding",
    probes: int = PROBES,
    group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """The ``nearest`` rows found for every row that ``queries`` selects: query_id, rank, vec_id, score.

    A query gets fewer only if the table has fewer candidates.
    Every vector is indexed; the directions are drawn, not fitted. A query's own id is no
    candidate. Ties go to the smaller vec_id. Null ids, and vectors that are null, zero, not of
    the table's usual length, or hold a null or non-finite number take no part. Rows that
    repeat an id with equal vectors count once, with different vectors each; the better score
    stays. An empty table gives no row; other columns are ignored.
    """
    usable, size, kind = _usable(vectors, id_col, vector)
    hashes = Hashes(max(1, size))
    most = nearest + 1
    own = usable.mapInArrow(_merged(kind, most), "v binary, ids array<long>")
    # A task sends at most ``most`` ids of a vector, so a common one stays small here, too.
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, most)
    index = stage(own.groupBy("v").agg(ids.alias("ids")), "ann-vectors")
    parts = max(1, -(-index.count() // group_rows))
    entries = stage(index.mapInArrow(_entries(hashes, kind, parts), _ROWS), "ann-entries")
    asked = usable.filter(queries).dropDuplicates(["id", "v"])
    sent = asked.mapInArrow(_probed(hashes, kind, parts, probes), _ROWS)
    # Parts with far more vectors than the rest are cut; their probes go to every cut.
    cuts = stage(
        entries.groupBy("part").agg(F.ceil(F.count("*") / (4 * group_rows)).cast("int").alias("cuts")).filter("cuts > 1"), "ann-cuts"
    )
    cuts_of = F.coalesce("cuts", F.lit(1))
    entries = entries.join(cuts, "part", "left").withColumn("cut", F.pmod(F.xxhash64("v"), cuts_of).cast("int")).drop("cuts")
    sent = sent.join(cuts, "part", "left").withColumn("cut", F.explode(F.sequence(F.lit(0), cuts_of - 1))).drop("cuts")
    found = entries.unionByName(sent).groupBy("part", "cut").applyInArrow(_ranked(kind, nearest), _FOUND)
    best = stage(_best(found, nearest), "ann-best")
    # Queries with fewer than there are: no bucket they visit holds the others.
    wanted = min(nearest, usable.select("id").distinct().limit(nearest + 1).count() - 1)
    counts = best.groupBy(F.col("query_id").alias("id")).agg(F.count("*").alias("n"))
    short = stage(asked.join(counts, "id", "left").filter(F.coalesce("n", F.lit(0)) < wanted).select("id", "v"), "ann-short")
    if not short.limit(1).count():
        return best
    return _best(best.drop("rank").unionByName(_compared_with_all(index, short, kind, nearest, parts, group_rows)), nearest)


def op4_multiprobe_lsh(embeddings: DataFrame) -> DataFrame:
    return nearest_neighbours(embeddings, F.col("id") % 50 == 0)

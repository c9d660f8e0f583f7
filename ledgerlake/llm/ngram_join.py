"""Jaccard self-join over five-word shingles with Bayesian candidate pruning.

Documents with the same shingle set are one class from the start, so groups of copies cost
one row each. Class representatives that agree in a band of MinHash values are connected;
the components are cut into blocks of bounded size and every pair of blocks is one group. There
all pairs are candidates: their MinHash values are compared a few at a time, and a pair is
dropped once the posterior probability that its similarity reaches the threshold falls below
the tolerance, and the pairs that stay are verified on their whole shingle sets. A group emits
link counts and a spanning forest, so the rows made do not grow with the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import (
    binary,
    bucket_of,
    flat,
    hashed_words,
    keyed_rows,
    mixed,
    packed,
    rolling,
    run_starts,
    seeded,
    split_by,
    stage,
    steps,
    unpacked,
    whitespace,
    words_of,
)
from ledgerlake.llm.components import components

WIDTH, LEAST = 5, 0.8
BANDS, ROWS = 40, 5  # a pair at 0.8 that no third document connects misses all bands with probability 1e-7
TOLERANCE = 1e-6
_AT_ONCE = 40  # MinHash values compared before the posterior is looked at again
_BLOCK = 256
_STEP = 512 << 10
_WORD_SEED, _SHINGLE_SEED, _HASH_SEED, _SET_SEED = 31, 32, 33, 34


def least_matches(total: int, least: float, tolerance: float) -> int:
    """Fewest agreeing values of ``total`` at which P(similarity >= least) is not below ``tolerance``.

    With a uniform prior the posterior after m agreements of n is Beta(m + 1, n - m + 1), whose
    upper tail at ``least`` is the chance of at most m successes in n + 1 trials.
    """
    tail = 0.0
    for m in range(total + 1):
        tail += comb(total + 1, m) * least**m * (1 - least) ** (total + 1 - m)
        if tail >= tolerance:
            return m
    return total


def _shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle fingerprints of every text, and where each text's begin.

    A text of fewer words than ``width`` has one shingle of all its words, an empty one none.
    """
    data, offsets = flat(column)
    starts, ends, first = words_of(data, offsets, whitespace())
    words = hashed_words(data, starts, ends, _WORD_SEED)
    runs = rolling(words, width, _SHINGLE_SEED)
    parts, sizes = [], [0]
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist()):
        if hi - lo >= width:
            own = np.sort(runs[lo : hi - width + 1])
            own = own[run_starts(own)]
        elif hi > lo:
            place = np.arange(1, hi - lo + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            own = mixed((mixed(words[lo:hi]) * place).sum(keepdims=True, dtype=np.uint64) + np.uint64(hi - lo))
        else:
            own = words[:0]
        parts.append(own)
        sizes.append(len(own))
    return (np.concatenate(parts) if parts else words[:0]), np.cumsum(sizes)


def _minhashes(shingles: np.ndarray, first: np.ndarray, count: int) -> np.ndarray:
    """``count`` MinHash values of every non-empty set; zeros for an empty one."""
    out = np.zeros((len(first) - 1, count), np.uint32)
    full = np.flatnonzero(np.diff(first))
    if len(full):
        seeds = seeded(_HASH_SEED, 2 * count)
        for k in range(count):
            values = (shingles ^ seeds[2 * k]) * (seeds[2 * k + 1] | np.uint64(1))
            out[full, k] = np.minimum.reduceat(values, first[full]) >> np.uint64(32)
    return out


def _band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signature), bands), np.uint64)
    grouped = signature.reshape(len(signature), bands, rows).astype(np.uint64)
    for r in range(rows):
        keys = mixed(keys ^ grouped[:, :, r] + np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return keys


def _sketch(width: int, bands: int, rows: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, step=_STEP):
            shingles, first = _shingles(batch.column("text"), width)
            sizes = np.diff(first)
            keys = _band_keys(_minhashes(shingles, first, bands * rows), bands, rows)
            a, b = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
            full = np.flatnonzero(sizes)
            if len(full):
                a[full] = np.add.reduceat(mixed(shingles + np.uint64(_SET_SEED)), first[full])
                b[full] = np.add.reduceat(mixed(shingles ^ np.uint64(0x5DEECE66D5DEECE6)), first[full])
            raw = keys.astype("<u8").tobytes()
            lists = [raw[i : i + 8 * bands] for i in range(0, len(raw), 8 * bands)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(sizes, pa.int64()), binary(lists)],
                ["row", "doc_id", "a", "b", "n", "bands"],
            )

    return work


def _banded(buckets: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = batch.column("bands").to_pylist()
            if not raw:
                continue
            keys = np.frombuffer(b"".join(raw), "<u8")
            owners = np.repeat(batch.column("rep").to_numpy(zero_copy_only=False), len(raw[0]) // 8)
            names, parts = [], []
            for bucket, at in split_by(bucket_of(keys, buckets)):
                names.append(bucket)
                parts.append(packed(keys[at], 8, owners[at], np.zeros(len(at), np.int32)))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), binary(parts)], ["bucket", "payload"])

    return work


def _band_stars(table: pa.Table) -> pa.Table:
    """An edge from every member of a band's group to its smallest member."""
    keys, owners, _, _ = unpacked(table.column("payload").to_pylist())
    order = np.lexsort((owners, keys))
    heads = run_starts(keys[order])
    centre = np.repeat(owners[order[heads]], np.diff(np.append(heads, len(order))))
    own = owners[order]
    pairs = np.unique(np.stack([own, centre], 1)[own != centre], axis=0)
    return pa.table({"u": pa.array(pairs[:, 0], pa.int64()), "v": pa.array(pairs[:, 1], pa.int64())})


def _candidates(width: int, count: int):
    """Each candidate's shingles and MinHash values, for every group it takes part in."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, step=_STEP):
            shingles, first = _shingles(batch.column("text"), width)
            signature = _minhashes(shingles, first, count)
            sets = [shingles[lo:hi].tobytes() for lo, hi in zip(first[:-1], first[1:])]
            names = ["row", "root", "copies", "block", "groups"]
            columns = [batch.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*columns, binary(sets), binary([x.tobytes() for x in signature])], [*names, "shingles", "signature"])

    return work


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of the given pairs of sets."""
    if len(left) <= 48:
        return np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(left, right)], np.int64)
    rows, i = np.unique(left, return_inverse=True)
    columns, j = np.unique(right, return_inverse=True)
    used = np.unique(np.concatenate([rows, columns]))
    words = np.concatenate([sets[x] for x in used])
    owner = np.repeat(np.arange(len(used)), [len(sets[x]) for x in used])
    order = np.argsort(words, kind="stable")
    term = np.zeros(len(words), np.int64)
    heads = run_starts(words[order])
    term[order] = np.repeat(np.arange(len(heads)), np.diff(np.append(heads, len(order))))
    a, b = np.searchsorted(used, rows), np.searchsorted(used, columns)
    total = np.zeros((len(rows), len(columns)))
    by_term = np.argsort(term, kind="stable")
    for low in range(0, len(heads), 4096):  # a bounded table of documents by shingles
        lo, hi = np.searchsorted(term[by_term], (low, low + 4096))
        at = by_term[lo:hi]
        table = np.zeros((len(used), 4096), np.float32)
        table[owner[at], term[at] - low] = 1
        total += table[a] @ table[b].T
    return total[i, j].astype(np.int64)


def _links(bands: int, rows: int, least: float, tolerance: float):
    count = bands * rows
    checks = [(n, least_matches(n, least, tolerance)) for n in range(_AT_ONCE, count + 1, _AT_ONCE)]

    def work(table: pa.Table) -> pa.Table:
        row = table.column("row").to_numpy()
        between = table.column("x")[0] != table.column("y")[0]
        root, copies, block = (table.column(c).to_numpy() for c in ("root", "copies", "block"))
        signatures = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(len(row), count)
        raw = table.column("shingles").to_pylist()
        nodes, others, counted = [], [], np.zeros(len(row), np.int64)
        for _, mine in split_by(root):
            sizes = np.array([len(raw[x]) // 8 for x in mine])
            # A set less than ``least`` times as large as the other cannot reach the threshold.
            cand = np.minimum.outer(sizes, sizes) >= least * np.maximum.outer(sizes, sizes)
            blocks = block[mine]
            if between:  # pairs inside a block belong to that block's own group
                cand &= blocks[:, None] != blocks[None, :]
            i, j = np.nonzero(np.triu(cand, 1))
            agree = np.zeros(len(i), np.int64)
            own = signatures[mine]
            for n, needed in checks:
                part = own[:, n - _AT_ONCE : n]
                agree += (part[i] == part[j]).sum(1)
                alive = agree >= needed
                i, j, agree = i[alive], j[alive], agree[alive]
            if not len(i):
                continue
            sets = [np.frombuffer(raw[x], np.uint64) for x in mine]
            both = _shared(sets, i, j)
            linked = both / (sizes[i] + sizes[j] - both) >= least
            i, j = mine[i[linked]], mine[j[linked]]
            np.add.at(counted, i, copies[j])
            np.add.at(counted, j, copies[i])
            for u, v in _forest(row[i], row[j]):
                nodes.append(u)
                others.append(v)
        some = np.flatnonzero(counted)
        return pa.table(
            {
                "u": pa.array(np.append(np.array(nodes, np.int64), row[some]), pa.int64()),
                "v": pa.array(others + [None] * len(some), pa.int64()),
                "links": pa.array([None] * len(nodes) + counted[some].tolist(), pa.int64()),
            }
        )

    return work


def _forest(left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the given links."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while (above := parent.get(x, x)) != x:
            parent[x] = parent.get(above, above)
            x = above
        return x

    out = []
    for u, v in zip(left.tolist(), right.tolist()):
        a, b = root(u), root(v)
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((u, v))
    return out


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    least: float = LEAST,
    bands: int = BANDS,
    rows: int = ROWS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row for each document: doc_id, class_id, n_links, is_first.

    Words end at ASCII white space and are compared unchanged. Two documents are linked if the
    Jaccard similarity of their shingle sets is at least ``least``; a class is a connected
    component of links and named by its smallest doc_id, whose row has ``is_first``. Texts of
    one to four words have one shingle; null or empty texts have none and no link. Rows that
    share an id are documents of their own, the first in a written copy counts as smaller; rows
    without an id count as larger than all others, so class_id is null where no member has one.
    Other columns are ignored; an empty table gives no row.
    """
    base = keyed_rows(docs, id_col, text, "join-rows")
    width_conf = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sketch = stage(base.mapInArrow(_sketch(width, bands, rows), "row long, doc_id long, a long, b long, n long, bands binary"), "join-sketch")
    classes = stage(
        sketch.filter("n > 0").groupBy("a", "b", "n").agg(F.min("row").alias("rep"), F.count("*").alias("copies"), F.first("bands").alias("bands")),
        "join-classes",
    )
    n_classes = classes.count()
    buckets = max(width_conf, n_classes * bands // 2_000_000)
    starred = classes.select("rep", "bands").mapInArrow(_banded(buckets), "bucket int, payload binary").groupBy("bucket")
    near = components(starred.applyInArrow(_band_stars, "u long, v long"), "join-near")
    sizes = near.groupBy("root").agg(F.count("*").alias("members"))
    # Components above _BLOCK are cut into blocks; one group for each pair of blocks.
    parts = F.ceil(F.col("members") / _BLOCK)
    block = F.when(F.col("members") <= _BLOCK, F.lit(0)).otherwise(F.pmod(F.xxhash64("node"), parts)).cast("long")
    members = stage(
        near.join(sizes, "root")
        .join(classes.select(F.col("rep").alias("node"), "copies"), "node")
        .select(F.col("node").alias("row"), "root", "copies", block.alias("block"), parts.cast("long").alias("parts")),
        "join-members",
    )
    packs = max(width_conf, members.count() // 1000)
    pair = F.transform(
        F.sequence(F.lit(0).cast("long"), F.col("parts") - 1),
        lambda other: F.struct(F.col("root").alias("r"), F.least("block", other).alias("x"), F.greatest("block", other).alias("y")),
    )
    small = F.array(F.struct(F.pmod(F.xxhash64("root"), F.lit(packs)).alias("r"), F.lit(-1).cast("long").alias("x"), F.lit(-1).cast("long").alias("y")))
    groups = members.select("row", "root", "copies", "block", F.when(F.col("parts") > 1, pair).otherwise(small).alias("groups"))
    joined = base.select("row", "text").join(groups.hint("shuffle_hash"), "row")
    kinds = "row long, root long, copies long, block long, groups array<struct<r:bigint,x:bigint,y:bigint>>, shingles binary, signature binary"
    sent = joined.mapInArrow(_candidates(width, bands * rows), kinds).select(F.explode("groups").alias("g"), "row", "root", "copies", "block", "shingles", "signature")
    sent = sent.select("g.r", "g.x", "g.y", "row", "root", "copies", "block", "shingles", "signature")
    found = stage(sent.groupBy("r", "x", "y").applyInArrow(_links(bands, rows, least, tolerance), "u long, v long, links long"), "join-links")
    roots = components(found.filter("v is not null").select("u", "v"), "join-classes")
    links = found.filter("links is not null").groupBy(F.col("u").alias("node")).agg(F.sum("links").alias("links"))
    per_class = classes.select("a", "b", "n", F.col("rep").alias("node"), "copies").join(roots, "node", "left").join(links, "node", "left")
    per_class = per_class.select(
        "a", "b", "n", F.coalesce("root", "node").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    if sketch.filter("doc_id is null or doc_id != row").limit(1).count():
        # Rows are numbered: a class gets the id of the row it is named by.
        ids = sketch.select(F.col("row").alias("root"), F.col("doc_id").alias("root_id"))
        per_class = per_class.join(ids, "root")
    else:
        per_class = per_class.withColumn("root_id", F.col("root"))
    own = sketch.select("row", "doc_id", "a", "b", "n").join(per_class, ["a", "b", "n"], "left")
    class_id = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("root_id"))
    is_first = F.coalesce("root", "row") == F.col("row")
    return own.select("doc_id", class_id.alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), is_first.alias("is_first"))


def op7_ngram_join(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs).select("doc_id", "class_id", "n_links")

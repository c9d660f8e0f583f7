"""Staging, and vectorised work on the flat bytes of an Arrow column of texts."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import stage as _stage

STEP_BYTES = 2 << 20  # text handled at once inside a task; a longer document is a step of its own
BUCKET_BYTES = 24 << 20  # text whose fingerprints meet in one bucket
_MASK = (1 << 64) - 1
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back; the shuffle files behind it go at once."""
    with _setting(df.sparkSession, _CLEANUP, "true"):
        return _stage(df, f"llm-{label}")


def buckets_for(docs: DataFrame, column: str = "text", finer: int = 1) -> tuple[int, int]:
    """Buckets so that each one holds the fingerprints of a bounded amount of text, and of a
    ``finer`` part of it."""
    total = docs.agg(F.sum(F.octet_length(column))).first()[0] or 0
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(width, -(-total // BUCKET_BYTES)), max(width, -(-total * finer // BUCKET_BYTES))


def flat(array: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and where each row starts; null is empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    array = array.cast(pa.large_binary())
    if array.null_count:
        array = pc.fill_null(array, b"")
    if not len(array):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = array.buffers()
    offsets = np.frombuffer(offsets, np.int64)[array.offset : array.offset + len(array) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def binary(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def steps(batches: Iterator[pa.RecordBatch], column: str = "text", step: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``step`` bytes of text, so a task's memory stays bounded."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        at = np.cumsum(sizes.astype(np.int64)) // step
        cuts = [0, *(np.flatnonzero(np.diff(at)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                yield batch.slice(lo, hi - lo)


def give_back() -> None:
    """Return freed memory to the system at the end of a task: workers live on into later stages."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        ctypes.CDLL(None).malloc_trim(0)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective mix of 64-bit values (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seeded(seed: int, size: int) -> np.ndarray:
    """``size`` fixed random 64-bit values."""
    return mixed(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


def rolling(values: np.ndarray, width: int, seed: int) -> np.ndarray:
    """A fingerprint of every run of ``width`` values, by doubling; empty if there are fewer."""
    if len(values) < width:
        return np.empty(0, np.uint64)
    base = int(seeded(seed, 1)[0]) | 1
    out, taken, block, size = None, 0, values, 1
    pieces = []
    while size <= width:
        if width & size:
            pieces.append((size, block))
        if size * 2 > width:
            break
        block = block[: len(block) - size] * np.uint64(pow(base, size, 1 << 64)) + block[size:]
        size *= 2
    n = len(values) - width + 1
    for size, block in reversed(pieces):
        part = block[taken : taken + n]
        out = part.copy() if out is None else out * np.uint64(pow(base, size, 1 << 64)) + part
        taken += size
    return mixed(out)


def words_of(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and each row's first word number.

    ``separator`` tells for each of the 256 bytes whether it ends a word; a row's end always does.
    """
    n = len(data)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = ~separator[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    ends = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def whitespace() -> np.ndarray:
    """The six ASCII white-space bytes."""
    table = np.zeros(256, bool)
    table[[0x20, *range(0x09, 0x0E)]] = True
    return table


def hashed_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit fingerprint of every word."""
    lengths = ends - starts
    if not len(starts):
        return np.empty(0, np.uint64)
    first = np.cumsum(lengths) - lengths
    place = np.arange(int(lengths.sum()), dtype=np.int64) - np.repeat(first, lengths)
    base, powers = int(seeded(seed, 1)[0]) | 1, np.empty(int(lengths.max()), np.uint64)
    powers[0] = 1
    filled = 1
    while filled < len(powers):
        more = min(filled, len(powers) - filled)
        powers[filled : filled + more] = powers[:more] * np.uint64(pow(base, filled, 1 << 64))
        filled += more
    terms = seeded(seed + 7, 256)[data[place + np.repeat(starts, lengths)]] * powers[place]
    return mixed(np.add.reduceat(terms, first) + lengths.astype(np.uint64))


def run_starts(keys: np.ndarray, *more: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted keys."""
    if not len(keys):
        return np.empty(0, np.int64)
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    for other in more:
        new[1:] |= other[1:] != other[:-1]
    return np.flatnonzero(new)


# --- fingerprints on their way to a bucket: packed columns instead of one row for each ---


def packed(hashes: np.ndarray, width: int, docs: np.ndarray, places: np.ndarray, flags: np.ndarray | None = None) -> bytes:
    """Low ``width`` bytes of each hash, its row id (run-length), its place and a flag.

    Bytes of equal rank lie together, so the shuffle's compression removes the idle ones.
    """
    starts = run_starts(docs)
    counts = np.diff(np.append(starts, len(docs))).astype(np.int32)
    planes = np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8)[:, :width].T
    spots = np.ascontiguousarray(places.astype(np.int32)).view(np.uint8).reshape(-1, 4).T
    bits = np.packbits(flags) if flags is not None else np.empty(0, np.uint8)
    head = np.array([len(hashes), len(starts), width, flags is not None], np.int64)
    return b"".join(x.tobytes() for x in (head, docs[starts].astype(np.int64), counts, planes, spots, bits))


def unpacked(payloads: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, row ids, places and flags of several payloads."""
    out = []
    for raw in payloads:
        n, runs, width, flagged = np.frombuffer(raw, np.int64, 4).tolist()
        at = 32
        docs = np.frombuffer(raw, np.int64, runs, at)
        at += 8 * runs
        counts = np.frombuffer(raw, np.int32, runs, at)
        at += 4 * runs
        full = np.zeros((n, 8), np.uint8)
        full[:, :width] = np.frombuffer(raw, np.uint8, n * width, at).reshape(width, n).T
        at += n * width
        spots = np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * 4, at).reshape(4, n).T)
        at += 4 * n
        flags = np.unpackbits(np.frombuffer(raw, np.uint8, -(-n // 8), at))[:n].astype(bool) if flagged else np.zeros(n, bool)
        out.append((full.view(np.uint64).ravel(), np.repeat(docs, counts), spots.view(np.int32).ravel(), flags))
    if not out:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, bool)
    return tuple(np.concatenate(x) for x in zip(*out))


def bucket_of(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket by the hash's upper 24 bits, which ``packed`` with 5 bytes leaves out."""
    return ((hashes >> np.uint64(40)) * np.uint64(buckets) >> np.uint64(24)).astype(np.int32)


def split_by(keys: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each key with the positions that have it, in order."""
    order = np.argsort(keys, kind="stable")
    starts = run_starts(keys[order])
    for lo, hi in zip(starts, np.append(starts[1:], len(order))):
        yield int(keys[order[lo]]), order[lo:hi]


# --- places on their way back to their documents ---

LISTS = "kind int, target int, payload binary"


def pack(*columns: np.ndarray) -> bytes:
    """Columns as byte planes, which compress well where upper bytes repeat."""
    head, body = [len(columns)], []
    for x in columns:
        head += [len(x), x.dtype.itemsize]
        body.append(np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T).tobytes() if len(x) else b"")
    return np.array(head, np.int64).tobytes() + b"".join(body)


def unpack(payloads: list[bytes], kinds: tuple) -> list[np.ndarray]:
    """The columns of several payloads, one after the other."""
    parts = []
    for raw in payloads:
        n = int(np.frombuffer(raw, np.int64, 1)[0])
        head = np.frombuffer(raw, np.int64, 1 + 2 * n)[1:].reshape(n, 2).tolist()
        at, out = 8 + 16 * n, []
        for (rows, width), kind in zip(head, kinds):
            planes = np.frombuffer(raw, np.uint8, rows * width, at).reshape(width, rows)
            out.append(np.ascontiguousarray(planes.T).view(kind).ravel())
            at += rows * width
        parts.append(out)
    return [np.concatenate(x) for x in zip(*parts)] if parts else [np.empty(0, k) for k in kinds]


def to_targets(kind: int, targets: int, docs: np.ndarray, *numbers: np.ndarray) -> pa.RecordBatch:
    """32-bit ``numbers`` of documents, one row for each group of documents they belong to."""
    keys, payloads = [], []
    order = np.lexsort((*numbers[::-1], docs)) if len(docs) else np.empty(0, np.int64)
    docs, numbers = docs[order].astype(np.int64), [x[order].astype(np.int32) for x in numbers]
    for target, at in split_by(bucket_of(mixed(docs.view(np.uint64) ^ np.uint64(0x51ED270B)), targets)):
        keys.append(target)
        payloads.append(pack(docs[at], *(x[at] for x in numbers)))
    kinds = pa.array(np.full(len(keys), kind, np.int32))
    return pa.RecordBatch.from_arrays([kinds, pa.array(keys, pa.int32()), binary(payloads)], ["kind", "target", "payload"])


def place_lists(sent: DataFrame, **widths: int) -> DataFrame:
    """One row for each document in ``sent`` rows of :func:`to_targets`: row, and a list for each kind.

    Kinds are numbered in the order of ``widths``, which tells how many numbers an entry has. A
    list is the sorted entries as little-endian 32-bit integers, empty where there are none.
    """

    def work(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        payloads = table.column("payload").to_pylist()
        parts = []
        for kind, width in enumerate(widths.values()):
            docs, *numbers = unpack([payloads[i] for i in np.flatnonzero(kinds == kind)], (np.int64, *[np.int32] * width))
            order = np.lexsort((*numbers[::-1], docs))
            parts.append((docs[order], np.ascontiguousarray(np.stack([x[order] for x in numbers], 1).astype("<i4"))))
        rows = np.unique(np.concatenate([docs for docs, _ in parts]))
        columns = [pa.array(rows, pa.int64())]
        for (docs, entries), width in zip(parts, widths.values()):
            ends = np.searchsorted(docs, rows, "right")
            offsets = (np.append(0, ends) * 4 * width).astype(np.int32)
            columns.append(pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(entries)]))
        return pa.Table.from_arrays(columns, ["row", *widths])

    return sent.groupBy("target").applyInArrow(work, "row long, " + ", ".join(f"{name} binary" for name in widths))


def listed(value: bytes | None, width: int = 1) -> np.ndarray:
    """The entries of one list, one row for each if they have several numbers."""
    numbers = np.frombuffer(value or b"", "<i4").astype(np.int64)
    return numbers if width == 1 else numbers.reshape(-1, width)


def odd_ids(docs: DataFrame, id_col: str) -> bool:
    """Whether an id is null or repeats."""
    ids = docs.select(F.col(id_col).cast("long").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
    return bool(ids.filter("n > 1 or id is null").limit(1).count())


def numbered(docs: DataFrame, id_col: str, name: str, label: str) -> DataFrame:
    """``docs`` in a written copy with a unique number ``name`` that rises with the id.

    Rows without an id come last; rows that share one follow their place in a first copy. The
    range partitions hold the place, too, so rows of one id are spread over many tasks.
    """
    placed = stage(docs.withColumn("_place", F.monotonically_increasing_id()), label)
    order = [F.col(id_col).cast("long").asc_nulls_last(), F.col("_place").asc()]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ordered.select(F.monotonically_increasing_id().alias(name), *docs.columns), label)


def keyed_rows(docs: DataFrame, id_col: str, text: str, label: str, carried: tuple[str, ...] = (), odd: bool | None = None) -> DataFrame:
    """(row, id, text) with a ``row`` that is unique, the same in every scan and in id order.

    The id itself serves where it is unique and not null; otherwise the rows are numbered in
    id order in a written copy, so that repeated rows stay apart and the order of all others is
    that of their ids. ``carried`` columns come along in one column ``rest``, where their names
    clash with nothing. ``odd`` is :func:`odd_ids` where the caller knows it.
    """
    rest = [F.struct(*carried).alias("rest")] if carried else []
    own = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text).alias("text"), *rest)
    if odd_ids(docs, id_col) if odd is None else odd:
        return numbered(own, "id", "row", label)
    return own.select(F.col("id").alias("row"), *own.columns)

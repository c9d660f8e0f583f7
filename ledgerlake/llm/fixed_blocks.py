"""Substring dedup over words with fixed-block anchors.

Every document is cut into blocks of 18 words; a window of 35 words always holds a whole
block. The blocks are the index, and every rolling run of 18 words of every document probes
it. Around each hit, all windows of 35 words that hold it are held against each other, which
extends the hits to the maximal exact repeats.

Fingerprints travel as packed columns for each piece of text and bucket, so a hit's place
costs two or three bytes; a popular run is spread over the buckets by its many words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import (
    LISTS,
    binary,
    bucket_of,
    buckets_for,
    flat,
    hashed_words,
    keyed_rows,
    listed,
    packed,
    place_lists,
    rolling,
    run_starts,
    split_by,
    stage,
    steps,
    to_targets,
    unpacked,
    whitespace,
    words_of,
)

WINDOW = 35
_WORD_SEED, _BLOCK_SEED, _WINDOW_SEED = 11, 12, 13


def _word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, offsets = flat(column)
    starts, ends, first = words_of(data, offsets, whitespace())
    return hashed_words(data, starts, ends, _WORD_SEED), first


def _payloads(hashes, width, docs, places, flags, buckets: int) -> pa.RecordBatch:
    keys, parts = [], []
    for bucket, at in split_by(bucket_of(hashes, buckets)):
        keys.append(bucket)
        parts.append(packed(hashes[at], width, docs[at], places[at], flags[at] if flags is not None else None))
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), binary(parts)], ["bucket", "payload"])


def _probes(buckets: int, block: int, window: int):
    """All rolling runs of ``block`` words; those that are blocks of the index carry a flag."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            words, first = _word_hashes(batch.column("text"))
            counts = np.diff(first)
            runs = rolling(words, block, _BLOCK_SEED)
            doc = np.repeat(np.arange(len(counts)), counts)[: len(runs)]
            place = np.arange(len(runs)) - first[doc]
            good = np.flatnonzero((place + block <= counts[doc]) & (counts[doc] >= window))
            ids = batch.column("row").to_numpy(zero_copy_only=False)
            place = place[good]
            yield _payloads(runs[good], 5, ids[doc[good]], place, place % block == 0, buckets)

    return work


def _repeated(targets: int, indexed: bool):
    """Places of the fingerprints that occur again; of those in the index only, if ``indexed``."""

    def work(table: pa.Table) -> pa.Table:
        hashes, docs, places, blocks = unpacked(table.column("payload").to_pylist())
        order = np.argsort(hashes)
        starts = run_starts(hashes[order])
        counts = np.diff(np.append(starts, len(order)))
        again = counts > 1
        if indexed and len(starts):
            again &= np.logical_or.reduceat(blocks[order], starts)
        chosen = order[np.repeat(again, counts)]
        return pa.Table.from_batches([to_targets(0, targets, docs[chosen], places[chosen])])

    return work


def _windows(buckets: int, block: int, window: int):
    """The windows around the hits of each document, as full fingerprints."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            words, first = _word_hashes(batch.column("text"))
            counts = np.diff(first)
            whole = rolling(words, window, _WINDOW_SEED)
            near = np.zeros(len(words) + 1, np.int64)
            for i, value in enumerate(batch.column("places").to_pylist()):
                place = listed(value)
                np.add.at(near, first[i] + np.maximum(place - (window - block), 0), 1)
                np.add.at(near, first[i] + place + 1, -1)
            near = np.cumsum(near)[: len(whole)] > 0
            doc = np.repeat(np.arange(len(counts)), counts)[: len(whole)]
            place = np.arange(len(whole)) - first[doc]
            good = np.flatnonzero(near & (place + window <= counts[doc]))
            ids = batch.column("row").to_numpy(zero_copy_only=False)
            yield _payloads(whole[good], 8, ids[doc[good]], place[good], None, buckets)

    return work


def _without(window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            kept, totals, removed, spans = [], [], [], []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for text, value in zip(texts, batch.column("places").to_pylist()):
                words = (text or b"").split()  # bytes split at the six ASCII white-space bytes
                runs = run_bounds(listed(value), window)
                out, at = [], 0
                for lo, hi in runs:
                    out += words[at:lo]
                    at = hi
                out += words[at:]
                kept.append(b" ".join(out))
                totals.append(len(words))
                removed.append(len(words) - len(out))
                spans.append([{"start": lo, "end": hi} for lo, hi in runs])
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(span))],
                ["doc_id", "kept", "n_words", "n_removed", "spans"],
            )

    return work


def run_bounds(places: np.ndarray, width: int) -> list[tuple[int, int]]:
    """Maximal [start, end) covered by runs of ``width`` that begin at the sorted places."""
    if not len(places):
        return []
    cuts = np.flatnonzero(np.diff(places) > width)
    lows = places[np.append(0, cuts + 1)]
    highs = places[np.append(cuts, len(places) - 1)] + width
    return list(zip(lows.tolist(), highs.tolist()))


def drop_repeated_passages(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """Remove every word covered by a window of ``window`` words that also starts elsewhere.

    Returns doc_id, kept (the other words joined by one space), n_words, n_removed and spans
    (the maximal repeats, as word numbers). Windows are judged on the input, the same document
    included. A null or empty text has no words; rows with the same id stay apart, each an
    occurrence of its own; other columns are ignored; an empty table gives no row.
    """
    block = (window + 1) // 2  # the largest block that every window holds whole
    rows = keyed_rows(docs, id_col, text, "blocks-rows")
    buckets, _ = buckets_for(rows)
    sent = "bucket int, payload binary"
    probes = rows.select("row", "text").mapInArrow(_probes(buckets, block, window), sent)
    hits = stage(probes.groupBy("bucket").applyInArrow(_repeated(buckets, True), LISTS), "blocks-hits")
    near = rows.select("row", "text").join(place_lists(hits, places=1).hint("shuffle_hash"), "row")
    windows = near.mapInArrow(_windows(buckets, block, window), sent)
    repeats = stage(windows.groupBy("bucket").applyInArrow(_repeated(buckets, False), LISTS), "blocks-repeats")
    span = "spans array<struct<start:bigint,end:bigint>>"
    joined = rows.join(place_lists(repeats, places=1).hint("shuffle_hash"), "row", "left")
    return joined.mapInArrow(_without(window), f"doc_id long, kept string, n_words long, n_removed long, {span}")


def op8_fixed_blocks(docs: DataFrame) -> DataFrame:
    out = drop_repeated_passages(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))

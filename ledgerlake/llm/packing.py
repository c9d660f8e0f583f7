"""Packing of token sequences: shortest pack first, over the histogram of lengths.

Only the histogram (one count for each length up to the sequence length) reaches the
driver. It is packed there as counts of identical patterns; each piece then finds its
place by its rank among the pieces of equal length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.common import stage, steps

SEQUENCE = 2048
END_ID = 1
#: Fixed values of the byte-level vocabulary: its word pattern, and how its special token begins.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPECIAL = "<|"
#: Characters whose classes are the same in every pattern engine.
PLAIN = r"[\t\n\r !-~\u00a1-\u024f]*"


class Encoder:
    """Token ids of whole texts, each with the end id.

    ``vocabulary`` (JSON) defines the ids. ``ranks`` holds the same vocabulary for the
    faster encoder, which takes the texts of plain characters; the tests compare both.
    """

    def __init__(self, vocabulary: str, ranks: str | None):
        import base64
        import os
        import re

        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.plain = re.compile(PLAIN).fullmatch
        self.fast = None
        if ranks:
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast and SPECIAL not in text and self.plain(text):
            found = self.fast.encode_ordinary(text)
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        found.append(END_ID)
        return np.array(found, np.uint32)


def token_pieces(docs: DataFrame, vocabulary: str, ranks: str | None = None, text: str = "text", id_col: str = "doc_id", sequence: int = SEQUENCE, keep_ids: bool = True) -> DataFrame:
    """Every document's ids, cut into pieces of ``sequence`` and a rest.

    One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, ids (if
    ``keep_ids``), and ``chunk`` and ``local``: the task that made it and its rank among
    that task's pieces of the same length. A null text is empty: one piece with the end id.
    """
    fields = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, chunk long, local long"
    names = [x.split()[0] for x in fields.split(", ")] + ["ids"] * keep_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, seen, encoder = TaskContext.get().partitionId(), np.zeros(sequence + 1, np.int64), None
        for batch in steps(batches, "text"):
            encoder = encoder or Encoder(vocabulary, ranks)
            rows: list[tuple] = []
            ids_of: list[np.ndarray] = []
            doc_ids = batch.column("doc_id").to_pylist()
            for doc_id, value in zip(doc_ids, batch.column("text").to_pylist()):
                ids = encoder.ids(value or "")
                raw = ids.astype("<u4")
                for start in range(0, len(ids), sequence):
                    piece = raw[start : start + sequence]
                    n = len(piece)
                    rows.append((doc_id, start, n, zlib.crc32(piece.tobytes()), len(ids), chunk, int(seen[n])))
                    seen[n] += 1
                    if keep_ids:
                        ids_of.append(piece.astype(np.int32))
            columns = [pa.array(x, pa.int64()) for x in zip(*rows)]
            if keep_ids:
                ends = np.cumsum([0, *map(len, ids_of)], dtype=np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids_of))))
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, fields + ", ids array<int>" * keep_ids)


def packed_patterns(histogram: dict[int, int], sequence: int = SEQUENCE) -> list[tuple[int, int, int, int, int]]:
    """Shortest pack first: (length, first rank, count, first sequence, offset) for each run.

    Lengths go longest first into the pack with the most room; a pattern is one kind of
    pack with its count, so the work depends on the histogram and not on the documents.
    """
    room: dict[int, list[list]] = {}  # free space -> [count, last entry]; an entry knows the one before

    def put(free: int, count: int, entry: tuple) -> None:
        if count:
            room.setdefault(free, []).append([count, entry])

    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        left = histogram[length]
        fits = [free for free in sorted(room, reverse=True) if free >= length]
        while left and fits:
            free = fits[0]
            count, entry = room[free].pop()
            if not room[free]:
                del room[free]
            used = min(count, left)
            put(free, count - used, entry)
            put(free - length, used, (length, sequence - free, entry))
            left -= used
            fits = [free for free in sorted(room, reverse=True) if free >= length]
        if left:
            deep = sequence // length
            for times, count in ((deep, left // deep), (left % deep, 1)):
                entry = None
                for i in range(times):
                    entry = (length, i * length, entry)
                if times:
                    put(sequence - times * length, count, entry)
    out, ranks, first = [], dict.fromkeys(histogram, 0), 0
    for free in sorted(room):
        for count, entry in room[free]:
            while entry:
                length, offset, entry = entry
                out.append((length, ranks[length], count, first, offset))
                ranks[length] += count
            first += count
    return out


def pack(pieces: DataFrame, sequence: int = SEQUENCE) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to the staged rows of :func:`token_pieces`.

    Sequences are numbered gapless from 0. An empty table gives no row.
    """
    counts = stage(pieces.groupBy("chunk", "length").agg(F.count("*").alias("n")), "pack-counts")
    histogram = {row["length"]: row["n"] for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = sorted(packed_patterns(histogram, sequence))
    keys = np.array([(x[0] << 44) + x[1] for x in runs], np.int64)
    ranks, firsts, offsets = (np.array([x[i] for x in runs], np.int64) for i in (1, 3, 4))
    earlier = Window.partitionBy("length").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("chunk", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    bases = stage(bases, "pack-bases")  # a known size, so the planner can decide on a broadcast
    kept = [c for c in pieces.columns if c not in ("chunk", "local")]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(x).to_numpy(zero_copy_only=False) for x in ("length", "_rank"))
            at = np.searchsorted(keys, (length << 44) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array(firsts[at] + rank - ranks[at]), pa.array(offsets[at])],
                [*kept, "sequence_id", "offset"],
            )

    ranked = pieces.join(bases, ["chunk", "length"]).select(*kept, (F.col("base") + F.col("local")).alias("_rank"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.select(*kept).schema)
    return ranked.mapInArrow(place, schema + ", sequence_id long, offset long")


def pack_documents(
    docs: DataFrame, vocabulary: str | None = None, ranks: str | None = None, keep_ids: bool = True, sequence: int = SEQUENCE
) -> DataFrame:
    """Tokenize and pack ``docs`` (doc_id, text); see :func:`token_pieces` and :func:`pack`.

    Repeated rows are packed as often as they occur; other columns are ignored. Without a
    ``vocabulary`` the public byte-level one is taken, with its ranks.
    """
    if vocabulary is None:
        vocabulary, ranks = default_vocabulary()
    pieces = token_pieces(docs, vocabulary, ranks, keep_ids=keep_ids, sequence=sequence)
    return pack(stage(pieces, "pack-pieces"), sequence)


def default_vocabulary() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def op9_packing(docs: DataFrame) -> DataFrame:
    """The packing contract's columns; ids are digested, not returned."""
    return pack_documents(docs, keep_ids=False)

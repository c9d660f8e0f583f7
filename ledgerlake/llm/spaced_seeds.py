"""Benchmark decontamination with spaced seeds.

A mask picks some of the tokens of a short run and ignores the others, so a run with a
substituted token still meets its original under a mask that leaves this place out. The seeds
of the test items are joined with those of every place of every document. A hit fixes a
diagonal (a place in the document for each token of the item), on which the overlap is
verified token by token, substitutions allowed.

One rule holds for items of every length: SHARE of the item's tokens agree on the diagonal, or
some segment of it has LEAST_TOKENS agreeing tokens that outweigh its substitutions. An item of
fewer than 15 tokens has its own few seeds: they leave out, in turn, each part that its allowed
substitutions could hit, so one of them always holds.

The test side is taken in blocks of bounded size; each block goes to all tasks and the
documents are scanned once for it, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import flat, hashed_words, run_starts, seeded, stage, steps, words_of

#: Five tokens each; 0 is a place that is ignored.
MASKS = ("11111", "1101011", "1011101", "11100101")
#: For items below 15 tokens: masks and their places in the item, one of which avoids the
#: substitutions that SHARE allows (none up to 4 tokens, one up to 9, two up to 14).
SHORT_SEEDS = {
    1: (("1", 0),),
    2: (("11", 0),),
    3: (("111", 0),),
    4: (("1111", 0),),
    5: (("1111", 0), ("1111", 1), ("10111", 0), ("11011", 0), ("11101", 0)),
    6: (("1111", 0), ("1111", 2), ("110011", 0)),
    7: (("11111", 0), ("11111", 2), ("1100011", 0)),
    8: (("1111", 0), ("1111", 4)),
    9: (("1111", 0), ("11111", 4)),
    10: (("111", 0), ("111", 3), ("1111", 6)),
    11: (("111", 0), ("1111", 3), ("1111", 7)),
    12: (("1111", 0), ("1111", 4), ("1111", 8)),
    13: (("1111", 0), ("1111", 4), ("11111", 8)),
    14: (("1111", 0), ("11111", 4), ("11111", 9)),
}
BLOCK_BYTES = 2 << 20  # text of the test items searched for in one scan
#: Agreeing tokens that a segment must have, or the share of the whole item that must agree.
LEAST_TOKENS, SHARE = 12, 0.8
MISMATCH = 2.0  # agreeing tokens that one substitution costs
_STEP = 512 << 10
_CELLS = 1 << 20  # token pairs verified at once
_TOKEN_SEED, _SEED_SEED, _SIEVE_BITS = 51, 52, 21


def _separators() -> np.ndarray:
    """ASCII bytes other than letters and digits; bytes of other scripts belong to tokens."""
    table = np.ones(256, bool)
    table[128:] = False
    for low, high in ("09", "az", "AZ"):
        table[ord(low) : ord(high) + 1] = False
    return table


#: Code points of scripts written without spaces, with their punctuation and full-width forms:
#: Thai to Tibetan, Myanmar, Khmer, Tai, kana and Han, Yi, compatibility and full-width, rare Han.
UNSPACED = (
    (0x0E00, 0x0FFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x2E80, 0x312F), (0x31A0, 0xA4CF),
    (0xA9E0, 0xA9FF), (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFE30, 0xFE4F), (0xFF00, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x3FFFF),
)


def _unspaced_letters(data: np.ndarray) -> np.ndarray:
    """The first byte and the byte after each letter of a script without spaces, in UTF-8."""
    edges = [np.empty(0, np.int64)]
    lead = np.flatnonzero(data >= 0xE0)
    for size, at in ((3, lead[data[lead] < 0xF0]), (4, lead[data[lead] >= 0xF0])):
        code = data[at].astype(np.int32) & (0x0F if size == 3 else 0x07)
        for k in range(1, size):
            code = code << 6 | data[at + k] & 0x3F
        place = np.searchsorted(np.array(UNSPACED).ravel(), code, "right")
        inside = place % 2 == 1
        inside |= np.isin(code, [high for _, high in UNSPACED])
        edges += [at[inside], at[inside] + size]
    return np.concatenate(edges)


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the lower-cased tokens, and each text's first one.

    A letter of a script without spaces is a token of its own.
    """
    data, offsets = flat(pc.utf8_lower(column))
    starts, ends, _ = words_of(data, np.append(offsets, _unspaced_letters(data)), _separators())
    return hashed_words(data, starts, ends, _TOKEN_SEED), np.searchsorted(starts, offsets)


def _seeds(tokens: np.ndarray, mask: str) -> np.ndarray:
    """The seed of a mask at every place where the mask fits."""
    n = max(0, len(tokens) - len(mask) + 1)
    out = np.full(n, seeded(_SEED_SEED + int("1" + mask, 2), 1)[0])
    for p, bit in enumerate(mask):
        if bit == "1":
            out = (out ^ tokens[p : p + n]) * np.uint64(0x9FB21C651E98DF25)
            out ^= out >> np.uint64(29)
    return out


@dataclass
class TestItems:
    """Tokens of some test items, and their seeds sorted by mask."""

    __test__ = False

    ids: list
    tokens: np.ndarray
    first: np.ndarray
    seeds: dict[str, np.ndarray]
    places: dict[str, np.ndarray]  # token number of each seed
    sieve: dict[str, np.ndarray]

    @classmethod
    def of(cls, rows: list[tuple]) -> TestItems:
        tokens, first = _tokens(pa.array([text for _, text in rows], pa.string()))
        sizes = np.diff(first)
        item = np.repeat(np.arange(len(rows)), sizes)
        out = cls([i for i, _ in rows], tokens, first, {}, {}, {})
        wanted: dict[str, list[np.ndarray]] = {}
        for mask in MASKS:
            at = np.flatnonzero(sizes[item] > max(SHORT_SEEDS))
            wanted[mask] = [at[at + len(mask) <= first[item[at] + 1]]]
        for size, fitted in SHORT_SEEDS.items():
            mine = first[:-1][sizes == size]
            for mask, place in fitted:
                wanted.setdefault(mask, []).append(mine + place)
        for mask, places in wanted.items():
            at = np.unique(np.concatenate(places))
            if not len(at):
                continue
            seeds = _seeds(tokens, mask)
            order = at[np.argsort(seeds[at], kind="stable")]
            sieve = np.zeros(1 << _SIEVE_BITS, bool)
            sieve[seeds[order] & np.uint64((1 << _SIEVE_BITS) - 1)] = True
            out.seeds[mask], out.places[mask], out.sieve[mask] = seeds[order], order, sieve
        return out

    def _diagonals(self, tokens: np.ndarray, first: np.ndarray) -> np.ndarray:
        """(document, item, shift of the item's token numbers) of all hits, each once."""
        found = [np.empty((0, 3), np.int64)]
        owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
        for mask, sieve in self.sieve.items():
            seeds = _seeds(tokens, mask)
            at = np.flatnonzero(sieve[seeds & np.uint64((1 << _SIEVE_BITS) - 1)])
            at = at[at + len(mask) <= first[owner[at] + 1]] if len(at) else at
            lo = np.searchsorted(self.seeds[mask], seeds[at])
            hi = np.searchsorted(self.seeds[mask], seeds[at], "right")
            counts = hi - lo
            at = np.repeat(at, counts)
            step = np.arange(len(at)) - np.repeat(np.cumsum(counts) - counts, counts)
            theirs = self.places[mask][np.repeat(lo, counts) + step]
            found.append(np.stack([owner[at], np.searchsorted(self.first, theirs, "right") - 1, at - theirs], 1))
        rows = np.concatenate(found)
        rows = rows[np.lexsort(rows.T[::-1])]
        return rows[run_starts(*rows.T)]

    def overlaps(self, tokens: np.ndarray, first: np.ndarray) -> list[tuple]:
        """(document, item, document token, item token, length, agreeing) for every verified overlap."""
        diagonals = self._diagonals(tokens, first)
        sizes = np.diff(self.first)[diagonals[:, 1]]
        out = []
        for size in np.unique(sizes):  # the diagonals of one length, a bounded number at once
            mine = diagonals[sizes == size]
            step = max(1, _CELLS // int(size))
            for at in range(0, len(mine), step):
                out += self._verified(mine[at : at + step], int(size), tokens, first)
        return out

    def _verified(self, diagonals: np.ndarray, size: int, tokens: np.ndarray, first: np.ndarray) -> list[tuple]:
        """The overlaps on diagonals of items of ``size`` tokens."""
        doc, item, shift = diagonals.T
        own = self.first[item][:, None] + np.arange(size)
        there = own + shift[:, None]
        inside = (there >= first[doc][:, None]) & (there < first[doc + 1][:, None])
        same = inside & (self.tokens[own] == tokens[np.where(inside, there, 0)])
        agreeing = same.sum(1)
        lo, hi = same.argmax(1), size - same[:, ::-1].argmax(1)
        good = agreeing >= SHARE * size
        for i in np.flatnonzero(~good & (agreeing >= LEAST_TOKENS)).tolist():
            low, high = _best_segment(same[i])
            count = int(same[i, low:high].sum())
            if count >= LEAST_TOKENS:
                lo[i], hi[i], agreeing[i], good[i] = low, high, count, True
        start = self.first[item] + lo + shift - first[doc]
        return list(zip(*(x[good].tolist() for x in (doc, item, start, lo, hi - lo, agreeing))))


def _best_segment(same: np.ndarray) -> tuple[int, int]:
    """The segment where agreeing tokens outweigh the substitutions most."""
    total = np.append(0.0, np.cumsum(np.where(same, 1.0, -MISMATCH)))
    gain = total - np.minimum.accumulate(total)
    high = int(gain.argmax())
    low = int(total[: high + 1].argmin())
    return low, high


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[TestItems]:
    """The test items in blocks of about BLOCK_BYTES; one block reaches the driver at a time."""
    rows = benchmark.select(F.col(item).alias("item"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-total // BLOCK_BYTES))
    for block in range(count):
        mine = rows.filter(F.pmod(F.xxhash64("item", "text"), F.lit(count)) == block)
        yield TestItems.of([(r["item"], r["text"]) for r in mine.collect()])


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """Every verified overlap: doc_id, item_id, doc_start, item_start, length, agreeing (in tokens).

    On one diagonal, SHARE of the item's tokens agree (the overlap reaches from the first to the
    last of them), or else a segment has LEAST_TOKENS agreeing ones. Tokens are lower-cased runs of letters and digits, and
    the single letters of scripts without spaces. An item of one to four tokens must be there
    whole; items or documents without tokens overlap nothing. Repeated rows are judged one by one; other columns are ignored; empty tables give no row.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text"))
    names = ["doc_id", "item_id", "doc_start", "item_start", "length", "agreeing"]
    parts = []
    for items in _blocks(benchmark, item, item_text):

        def search(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches, step=_STEP):
                found = items.overlaps(*_tokens(batch.column("text")))
                if found:
                    columns = list(zip(*found))
                    ids = batch.column("doc_id").take(pa.array(columns[0]))
                    mine = pa.array([items.ids[x] for x in columns[1]], pa.int64())
                    yield pa.RecordBatch.from_arrays([ids, mine, *(pa.array(c, pa.int64()) for c in columns[2:])], names)

        parts.append(rows.mapInArrow(search, ", ".join(f"{n} long" for n in names)))
        if len(parts) > 1:  # several blocks: keep one at a time in the plan
            parts = [stage(parts[0].union(parts[1]), "seeds-overlaps")]
    return parts[0]


def without_overlap(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of ``docs`` that overlap no test item, all columns unchanged."""
    for number, items in enumerate(_blocks(benchmark, item, item_text)):

        def keep(batches: Iterator[pa.RecordBatch], items=items) -> Iterator[pa.RecordBatch]:
            for batch in steps(batches, text, _STEP):
                good = np.ones(batch.num_rows, bool)
                good[[x[0] for x in items.overlaps(*_tokens(batch.column(batch.schema.get_field_index(text))))]] = False
                yield batch.filter(pa.array(good))

        docs = (stage(docs, "seeds-clean") if number else docs).mapInArrow(keep, docs.schema)
    return docs


def op5_spaced_seeds(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each overlapping pair of document and test item, with its longest overlap."""
    best = F.max_by(F.struct("doc_start", "item_start", "length", "agreeing"), F.struct("agreeing", -F.col("doc_start"), -F.col("item_start")))
    return overlaps(docs, benchmark).groupBy("doc_id", "item_id").agg(best.alias("x")).select("doc_id", "item_id", "x.*")

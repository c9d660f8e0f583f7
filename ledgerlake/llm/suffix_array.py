"""Exact substring dedup over bytes with blockwise suffix sorting and a difference cover.

1. Documents are cut into content-defined pieces. A piece that, with the 49 bytes after it,
   equals one of a smaller document is wholly repeated and needs no sorting; of each kind only
   the first stays a reference. Groups of copies, however large, end here.
2. A window of 50 bytes is found again only if its minimizer (the smallest 24-byte fingerprint
   in it) is. Windows whose minimizer occurs in one document only are left out, exactly.
3. The suffixes that begin the other windows meet by minimizer in buckets of bounded size. Runs of
   windows whose bytes a smaller document has as they are need no sorting. For the others the ranks of a difference cover's suffixes are computed first (by doubling); then the
   suffixes are sorted one prefix block at a time. Long ties are resolved by the rank of the
   cover position that both suffixes share, without reading further into the texts.
4. A minimizer with very many places has its windows sent by their own bytes instead, and equal
   windows are merged before the shuffle, so a popular line does not meet in one task.
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
    give_back,
    keyed_rows,
    listed,
    mixed,
    odd_ids,
    pack,
    place_lists,
    rolling,
    run_starts,
    seeded,
    split_by,
    stage,
    steps,
    to_targets,
    unpack,
)

LENGTH = 50
GRAM = 24
PERIOD = 8
#: A difference cover modulo 8: every difference occurs between two of its members.
COVER = (0, 1, 2, 4)
#: Places of one minimizer beyond which its windows travel by themselves.
POPULAR = 20_000
_BLOCK = 1 << 18  # suffixes sorted at once
_FINER = 8  # a bucket of suffixes serves an eighth of the text that a bucket of minimizers does
_STEP = 256 << 10
_FLUSH = 4 << 20
_PIECES, _HITS, _POPULAR = 0, 1, 2
_FORTY_BITS = np.uint64((1 << 40) - 1)  # with the bucket enough to choose candidates by
_BYTE_SEED, _GRAM_SEED, _CUT_SEED, _WINDOW_SEED = 21, 22, 23, 24


class _Outbox:
    """Entries gathered over several steps, then packed for each kind and bucket."""

    def __init__(self, buckets: int):
        self.buckets, self.parts, self.bytes = buckets, {}, 0

    def add(self, kind: int, route: np.ndarray, *columns: np.ndarray) -> None:
        self.parts.setdefault(kind, []).append((route, *columns))

    def batch(self) -> pa.RecordBatch:
        kinds, keys, payloads = [], [], []
        for kind, parts in self.parts.items():
            route, *columns = (np.concatenate(x) for x in zip(*parts))
            for bucket, at in split_by(bucket_of(route, self.buckets)):
                kinds.append(kind)
                keys.append(bucket)
                payloads.append(pack(*(c[at] for c in columns)))
        self.parts, self.bytes = {}, 0
        return pa.RecordBatch.from_arrays([pa.array(kinds, pa.int32()), pa.array(keys, pa.int32()), binary(payloads)], ["kind", "bucket", "payload"])


# --- pieces and minimizers of one step ---


class _Texts:
    """Fingerprints of the concatenated bytes of some documents."""

    def __init__(self, column: pa.Array, length: int):
        self.data, self.offsets = flat(column)
        self.length = length
        n = len(self.data)
        self.doc = np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.offsets))
        self.end = self.offsets[1:][self.doc] if n else np.empty(0, np.int64)
        self.values = seeded(_BYTE_SEED, 256)[self.data]
        self.grams = rolling(self.values, GRAM, _GRAM_SEED)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """Start of every window inside a document, and its minimizer's place."""
        n, width = len(self.data), self.length - GRAM + 1
        if n < self.length:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        bits = max(22, n.bit_length())
        low = np.uint64((1 << bits) - 1)
        best = (self.grams & ~low) | np.arange(len(self.grams), dtype=np.uint64)  # the leftmost of equals
        size = 1
        while size * 2 <= width:
            best = np.minimum(best[: len(best) - size], best[size:])
            size *= 2
        count = n - self.length + 1
        best = np.minimum(best[:count], best[width - size : width - size + count])
        starts = np.flatnonzero(np.arange(count) + self.length <= self.end[:count])
        return starts, (best[starts] & low).astype(np.int64)

    def pieces(self) -> tuple[np.ndarray, ...]:
        """Two fingerprints, start and number of windows of every piece, the bytes after it included."""
        n, more = len(self.data), self.length - 1
        if n < self.length:
            return (np.empty(0, np.uint64),) * 2 + (np.empty(0, np.int64),) * 2
        cut = (mixed(self.grams + np.uint64(_CUT_SEED)) & np.uint64(255)) == 0
        cut[1:] &= ~cut[:-1].copy()
        heads = np.zeros(n, bool)
        heads[: len(cut)] = cut
        heads[self.offsets[:-1][np.diff(self.offsets) > 0]] = True
        starts = np.flatnonzero(heads)
        limit = self.end[starts]
        stops = np.minimum(np.append(starts[1:], n), limit - more)  # windows begin before here
        good = stops > starts
        starts, stops = starts[good], stops[good]
        ends = stops + more
        base = int(seeded(_CUT_SEED, 1)[0]) | 1
        up, down = _powers(base, n), _powers(pow(base, -1, 1 << 64), n)
        running = np.append(np.uint64(0), np.cumsum(self.values * up))
        first = (running[ends] - running[starts]) * down[starts]
        running = np.append(np.uint64(0), np.cumsum(mixed(self.grams)))
        second = running[ends - GRAM + 1] - running[starts]
        return mixed(first + (ends - starts).astype(np.uint64)), mixed(second), starts, stops - starts


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[:1] = 1
    filled = 1
    while filled < n:
        more = min(filled, n - filled)
        out[filled : filled + more] = out[:more] * np.uint64(pow(base, filled, 1 << 64))
        filled += more
    return out


def _route(grams: np.ndarray) -> np.ndarray:
    return mixed(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5))  # minimizers are small numbers: spread them anew


def _numbers(batch: pa.RecordBatch, shared: bool) -> tuple[np.ndarray, ...]:
    """The number each row is compared by, and its own if rows share the first."""
    return tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in (("owner", "row") if shared else ("row",)))


def _anchors(buckets: int, length: int, shared: bool):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = _Outbox(buckets)
        for batch in steps(batches, step=_STEP):
            texts = _Texts(batch.column("text"), length)
            who = _numbers(batch, shared)
            first, second, starts, counts = texts.pieces()
            doc = texts.doc[starts]
            box.add(_PIECES, first, first, second, *(x[doc] for x in who), (starts - texts.offsets[doc]).astype(np.int32), counts.astype(np.int32))
            _, at = texts.windows()
            at = at[run_starts(at)]
            doc, route = texts.doc[at], _route(texts.grams[at])
            box.add(_HITS, route, route & _FORTY_BITS, *(x[doc] for x in who), (at - texts.offsets[doc]).astype(np.int32))
            box.bytes += len(texts.data)
            if box.bytes > _FLUSH:
                yield box.batch()
        yield box.batch()
        give_back()

    return work


def _repeats_by_kind(targets: int, popular: int, shared: bool):
    """Pieces seen in a smaller document, and minimizers seen in several documents."""
    who = (np.int64,) * (1 + shared)

    def work(table: pa.Table) -> pa.Table:
        payloads = table.column("payload").to_pylist()
        if table.column("kind")[0].as_py() == _PIECES:
            first, second, *docs, starts, counts = unpack(payloads, (np.uint64, np.uint64, *who, np.int32, np.int32))
            owners, docs = docs[0], docs[-1]
            order = np.lexsort((owners, second, first))
            heads = run_starts(first[order], second[order])
            least = np.repeat(owners[order[heads]], np.diff(np.append(heads, len(order))))
            later = order[owners[order] > least]
            return pa.Table.from_batches([to_targets(_PIECES, targets, docs[later], starts[later], counts[later])])
        keys, *docs, places = unpack(payloads, (np.uint64, *who, np.int32))
        owners, docs = docs[0], docs[-1]
        order = np.lexsort((owners, keys))
        heads = run_starts(keys[order])
        sizes = np.diff(np.append(heads, len(order)))
        last = np.append(heads[1:], len(order)) - 1
        several = owners[order[heads]] != owners[order[last]] if len(order) else np.empty(0, bool)
        few = order[np.repeat(several & (sizes <= popular), sizes)]
        many = order[np.repeat(several & (sizes > popular), sizes)]
        return pa.Table.from_batches([to_targets(_HITS, targets, docs[few], places[few]), to_targets(_POPULAR, targets, docs[many], places[many])])

    return work


# --- contexts: the bytes around the minimizers that are found again ---


def _ragged(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All positions of the given ranges, one range after the other."""
    first = np.cumsum(sizes) - sizes
    return np.repeat(starts - first, sizes) + np.arange(int(sizes.sum()))


class _ContextBox:
    """Contexts of several steps, then packed for each bucket.

    A popular window's context has twins: other places of its owner that hold the same window.
    """

    def __init__(self, buckets: int, length: int):
        self.buckets, self.more, self.parts, self.bytes = buckets, length - 1, [], 0

    def add(self, route: np.ndarray, who: tuple, lows: np.ndarray, counts: np.ndarray, marks: np.ndarray, text: np.ndarray, twins: tuple) -> None:
        numbers = lows.astype(np.int32), counts.astype(np.int32), marks.astype(np.uint8)
        sizes, rows, places = twins
        self.parts.append((text, rows, places.astype(np.int32), route, *numbers, sizes.astype(np.int32), *who))
        self.bytes += len(text) + 12 * len(places)

    def batch(self) -> pa.RecordBatch:
        keys, payloads = [], []
        if self.parts:
            text, rows, places, route, lows, counts, marks, twins, *who = (np.concatenate(x) for x in zip(*self.parts))
            sizes = counts.astype(np.int64) + self.more
            first, first_twin = np.cumsum(sizes) - sizes, np.cumsum(twins, dtype=np.int64) - twins
            for bucket, at in split_by(bucket_of(route, self.buckets)):
                keys.append(bucket)
                also = _ragged(first_twin[at], twins[at].astype(np.int64))
                mine = (x[at] for x in (lows, counts, marks, twins, *who))
                payloads.append(pack(text[_ragged(first[at], sizes[at])], rows[also], places[also], *mine))
        self.parts, self.bytes = [], 0
        nothing = pa.nulls(len(keys), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), nothing, nothing, binary(payloads)], _CONTEXT_NAMES)


_CONTEXT_NAMES = ["bucket", "kind", "target", "payload"]


def _contexts(buckets: int, targets: int, length: int, shared: bool):
    """Runs of windows with one minimizer, with their bytes; equal windows of a popular one merged.

    Merged windows of larger documents are repeated; those of the least one share its fate as twins.

    Rows with a bucket are contexts; rows with a target are places already known to be repeated.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        box = _ContextBox(buckets, length)
        for batch in steps(batches, step=_STEP):
            texts = _Texts(batch.column("text"), length)
            who = _numbers(batch, shared)
            owners, ids = who[0], who[-1]
            known = np.zeros(len(texts.data) + 1, np.int8)  # 1 hit, 2 popular
            done = np.zeros(len(texts.data) + 1, np.int64)
            for i, (pieces, hits, popular) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("pieces", "hits", "popular")))):
                at = texts.offsets[i]
                known[at + listed(hits)] = 1
                known[at + listed(popular)] = 2
                span = listed(pieces, 2)
                np.add.at(done, at + span[:, 0], 1)
                np.add.at(done, at + span.sum(1), -1)
            starts, anchor = texts.windows()
            open_ = np.cumsum(done)[starts] == 0
            for mark in (1, 2):
                mine = np.flatnonzero((known[anchor] == mark) & open_)
                x, a = starts[mine], anchor[mine]
                if not len(x):
                    continue
                doc = texts.doc[x]
                if mark == 1:
                    cut = np.ones(len(x), bool)
                    cut[1:] = (x[1:] != x[:-1] + 1) | (a[1:] != a[:-1])
                    heads = np.flatnonzero(cut)
                    counts = np.diff(np.append(heads, len(x)))
                    route, marks = _route(texts.grams[a[heads]]), a[heads] - x[heads]
                    twins = np.zeros(len(heads), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
                else:
                    whole = rolling(texts.values, length, _WINDOW_SEED)[x]
                    order = np.lexsort((owners[doc], whole))
                    tops = run_starts(whole[order])
                    sizes = np.diff(np.append(tops, len(order)))
                    least = np.repeat(owners[doc[order[tops]]], sizes)
                    place = x - texts.offsets[doc]
                    later = order[owners[doc[order]] > least]
                    repeated = to_targets(0, targets, ids[doc[later]], place[later])
                    yield pa.RecordBatch.from_arrays([pa.nulls(repeated.num_rows, pa.int32()), *repeated.columns], _CONTEXT_NAMES)
                    heads = order[tops]
                    counts = np.ones(len(heads), np.int64)
                    route, marks = mixed(whole[heads]), np.zeros(len(heads), np.int64)
                    same = owners[doc[order]] == least
                    alike = np.add.reduceat(same.astype(np.int64), tops) - 1
                    same[tops] = False
                    also = order[same]
                    twins = alike, ids[doc[also]], place[also]
                lows = x[heads]
                doc = texts.doc[lows]
                sent = texts.data[_ragged(lows, counts + length - 1)]
                box.add(route, tuple(n[doc] for n in who), lows - texts.offsets[doc], counts, marks, sent, twins)
            if box.bytes > _FLUSH:
                yield box.batch()
        yield box.batch()
        give_back()

    return work


# --- suffix sorting of one bucket ---


def _dense(*keys: np.ndarray) -> np.ndarray:
    """Rank of each row by the given keys (the first weighs most); equal rows share a rank."""
    ranks = None
    for key in keys:
        if ranks is not None:
            key = (ranks.astype(np.uint64) << np.uint64(32)) | (key if key.dtype == np.int32 else _dense(key)).astype(np.uint64)
        order = np.argsort(key)
        new = np.zeros(len(key), np.int32)
        heads = run_starts(key[order])
        new[heads[1:]] = 1
        ranks = np.empty(len(key), np.int32)
        ranks[order] = np.cumsum(new)
    return ranks


def cover_ranks(words: np.ndarray, span: int, wanted: np.ndarray | None = None) -> np.ndarray:
    """Rank, among the cover positions, of the ``span`` bytes that begin at each of them.

    With ``wanted``, only of the positions it marks; a rank holds if all its bytes are marked.
    ``words`` holds the 8 bytes at every position, first byte uppermost. Doubling stays on
    cover positions because the period is 8: ranks of 8, 16, 32 bytes, then what is left.
    """
    n = len(words)
    cover = np.isin(np.arange(PERIOD), COVER)[np.arange(n) % PERIOD]
    at = np.flatnonzero(cover if wanted is None else cover & wanted)
    place = np.full(n + span + PERIOD, len(at), np.int64)  # beyond the text: one rank below all
    place[at] = np.arange(len(at))

    def following(known: np.ndarray, distance: int) -> np.ndarray:
        return np.append(known, np.int32(-1))[place[at + distance]] + np.int32(1)

    size, by_size = PERIOD, {PERIOD: _dense(words[at])}
    while size * 2 <= span:
        by_size[size * 2] = _dense(by_size[size], following(by_size[size], size))
        size *= 2
    keys, covered = [by_size[size]], size
    while size >= PERIOD:
        if covered + size <= span:
            keys.append(following(by_size[size], covered))
            covered += size
        size //= 2
    if covered < span:
        keys.append(np.append(words, np.zeros(span, np.uint64))[at + span - PERIOD])
    ranks = _dense(*keys) if len(keys) > 1 else keys[0]
    out = np.full(n + PERIOD, -1, np.int32)
    out[at] = ranks
    return out


def smallest_owner(text: np.ndarray, starts: np.ndarray, owners: np.ndarray, length: int = LENGTH, aligned: bool = False) -> np.ndarray:
    """For the suffix at each start, the smallest owner of a suffix with the same first ``length`` bytes.

    ``aligned`` promises that such suffixes start at places of the same residue, so that only
    ties within a residue need resolving.
    """
    padded = np.append(text, np.zeros(length + PERIOD, np.uint8))
    words = np.zeros(len(text) + length, np.uint64)
    for k in range(PERIOD):
        words = (words << np.uint64(8)) | padded[k : k + len(words)]
    out = owners.copy()
    # Suffixes whose first and last 8 bytes no other owner has are settled.
    both = mixed(words[starts]) + words[starts + length - PERIOD]
    order = np.lexsort((owners, both))
    heads = run_starts(both[order])
    sizes = np.diff(np.append(heads, len(order)))
    several = owners[order[heads]] != owners[order[heads + sizes - 1]] if len(order) else np.empty(0, bool)
    left = order[np.repeat(several, sizes)]
    span = length - PERIOD  # 8 bytes before the shared cover position, ``span`` from it, 8 at the end
    reach = np.zeros(len(words) + 1, np.int32)
    np.add.at(reach, starts[left], 1)
    np.add.at(reach, starts[left] + length, -1)
    ranks = cover_ranks(words, span, np.cumsum(reach[:-1]) > 0)
    shared = [[next(d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER) for b in range(PERIOD)] for a in range(PERIOD)]
    order = left[np.argsort(words[starts[left]], kind="stable")]
    heads = run_starts(words[starts[order]])
    at = 0
    while at < len(order):  # one block of whole prefixes at a time
        stop = np.searchsorted(heads, at + _BLOCK)
        stop = int(heads[stop]) if stop < len(heads) else len(order)
        mine = order[at:stop]
        at = stop
        ends = _dense(words[starts[mine]], words[starts[mine] + length - PERIOD])
        tied = np.bincount(ends)[ends] > 1
        mine, ends = mine[tied], ends[tied]
        residue = starts[mine] % PERIOD
        by = [np.flatnonzero(residue == r) for r in range(PERIOD)]
        for a in range(PERIOD):
            for b in range(a, a + 1 if aligned else PERIOD):
                both = by[a] if a == b else np.concatenate([by[a], by[b]])
                if not len(both):
                    continue
                cover = ranks[starts[mine[both]] + shared[a][b]]
                key = (ends[both].astype(np.uint64) << np.uint64(32)) | cover.astype(np.uint64)
                place = np.argsort(key)
                tops = run_starts(key[place])
                sizes = np.diff(np.append(tops, len(place)))
                least = np.repeat(np.minimum.reduceat(owners[mine[both[place]]], tops), sizes)
                who = mine[both[place]]
                out[who] = np.minimum(out[who], least)
    return out


def _equal_contexts(docs: np.ndarray, sizes: np.ndarray, sent: np.ndarray) -> np.ndarray:
    """Marks contexts whose bytes a smaller document has as well; bytes are compared, not hashes.

    All their windows are repeated, and the smallest document's context stands for them.
    """
    raw, ends, first = sent.tobytes(), np.cumsum(sizes), {}
    starts, ends, owners = (ends - sizes).tolist(), ends.tolist(), docs.tolist()
    copies = np.zeros(len(docs), bool)
    for i in np.argsort(docs, kind="stable").tolist():
        copies[i] = first.setdefault(raw[starts[i] : ends[i]], owners[i]) < owners[i]
    return copies


def _sorted_bucket(targets: int, length: int, shared: bool):
    kinds = (np.uint8, np.int64, np.int32, np.int32, np.int32, np.uint8, np.int32) + (np.int64,) * (1 + shared)

    def work(table: pa.Table) -> pa.Table:
        sent, twin_docs, twin_places, lows, counts, marks, twins, *who = unpack(table.column("payload").to_pylist(), kinds)
        owners, docs = who[0], who[-1]
        counts, twins = counts.astype(np.int64), twins.astype(np.int64)
        sizes = counts + length - 1
        copies = _equal_contexts(owners, sizes, sent)
        known = np.repeat(docs[copies], counts[copies]), _ragged(lows[copies].astype(np.int64), counts[copies])
        sent = sent[np.repeat(~copies, sizes)]
        owners, docs, lows, counts, marks, sizes = (x[~copies] for x in (owners, docs, lows, counts, marks, sizes))
        # Laid out so that minimizers lie at multiples of the period: equal windows share a residue.
        lead = (-marks.astype(np.int64)) % PERIOD
        room = -(-(lead + sizes) // PERIOD) * PERIOD + PERIOD
        first = np.cumsum(room) - room + lead
        text = np.zeros(int(room.sum()), np.uint8)
        text[_ragged(first, sizes)] = sent
        heads = np.cumsum(counts) - counts
        step = np.arange(int(counts.sum())) - np.repeat(heads, counts)
        owner = np.repeat(owners, counts)
        least = smallest_owner(text, np.repeat(first, counts) + step, owner, length, aligned=True)
        later = np.flatnonzero(least < owner)
        gone = copies.copy()
        gone[~copies] = (least < owner)[heads]  # a context with twins has one window
        also = _ragged((np.cumsum(twins) - twins)[gone], twins[gone])
        places = np.concatenate([(np.repeat(lows, counts) + step)[later], known[1], twin_places[also]])
        found = to_targets(0, targets, np.concatenate([np.repeat(docs, counts)[later], known[0], twin_docs[also]]), places)
        del text, owner, least, sent, step
        give_back()
        return pa.Table.from_batches([found])

    return work


# --- the operator ---


def _merged(spans: np.ndarray, places: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Maximal [start, end) covered by repeated windows: runs of them, and single ones."""
    lows = np.concatenate([spans[:, 0], places])
    highs = np.concatenate([spans.sum(1) + length - 1, places + length])
    if not len(lows):
        return []
    order = np.argsort(lows, kind="stable")
    lows, highs = lows[order], np.maximum.accumulate(highs[order])
    cuts = np.flatnonzero(lows[1:] > highs[:-1])
    return list(zip(lows[np.append(0, cuts + 1)].tolist(), highs[np.append(cuts, len(lows) - 1)].tolist()))


def _whole_letters(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The runs without the letters of which they hold a part only."""
    out = []
    for lo, hi in runs:
        while lo < hi and text[lo] & 0xC0 == 0x80:
            lo += 1
        while lo < hi < len(text) and text[hi] & 0xC0 == 0x80:
            hi -= 1
        if lo < hi:
            out.append((lo, hi))
    return out


def _without(length: int, as_text: bool, carried: bool):
    names = ["doc_id", "kept", "n_bytes", "n_removed", "spans"] + ["rest"] * carried

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches):
            kept, spans, sizes, removed = [], [], [], []
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for text, pieces, places in zip(texts, batch.column("pieces").to_pylist(), batch.column("places").to_pylist()):
                text = text or b""
                runs = _merged(listed(pieces, 2), listed(places), length)
                sizes.append(len(text))
                removed.append(sum(hi - lo for lo, hi in runs))
                spans.append([{"start": lo, "end": hi} for lo, hi in runs])
                out, at = [], 0
                for lo, hi in _whole_letters(text, runs) if as_text else runs:
                    out.append(text[at:lo])
                    at = hi
                out.append(text[at:])
                kept.append(b"".join(out))
            span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            rest = [batch.column("rest")] if carried else []
            left = binary(kept).cast(pa.string()) if as_text else binary(kept)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), left, pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(span)), *rest], names
            )

    return work


def drop_repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    popular: int = POPULAR,
    as_text: bool = False,
    carried: tuple[str, ...] = (),
    by_id: bool = False,
) -> DataFrame:
    """Remove every byte covered by a ``length``-byte string that also starts in a smaller document.

    Returns doc_id, kept (the other bytes), n_bytes, n_removed and spans (the maximal removed
    runs, as byte offsets). With ``as_text``, kept is a text that also has the letters of which
    a run holds only a part. ``carried`` columns are returned in a column ``rest``. Strings are
    judged on the input and never cross documents. A null or empty text has no bytes. Rows that
    share an id count as different documents, ordered by their place in a written copy; so do
    rows without an id, after all others. With ``by_id`` the id alone decides: rows that share one
    are no smaller than each other, and a row without one has no smaller document and is none.
    Other columns are ignored; an empty table gives no row.
    """
    if not GRAM + PERIOD <= length:
        raise ValueError(f"length must be at least {GRAM + PERIOD}")
    odd = odd_ids(docs, id_col)
    shared = by_id and odd
    rows = keyed_rows(docs, id_col, text, "suffix-rows", carried, odd)
    buckets, small = buckets_for(rows, finer=_FINER)
    texts = rows.where("id is not null").select("row", "text", F.col("id").alias("owner")) if shared else rows.select("row", "text")
    anchors = texts.mapInArrow(_anchors(buckets, length, shared), "kind int, bucket int, payload binary")
    found = stage(anchors.groupBy("kind", "bucket").applyInArrow(_repeats_by_kind(buckets, popular, shared), LISTS), "suffix-anchors")
    per_doc = place_lists(found, pieces=2, hits=1, popular=1).filter("length(hits) + length(popular) > 0")
    near = texts.join(per_doc.hint("shuffle_hash"), "row")
    contexts = stage(near.mapInArrow(_contexts(small, buckets, length, shared), f"bucket int, {LISTS}"), "suffix-contexts")
    by_bucket = contexts.filter("bucket is not null").select("bucket", "payload").groupBy("bucket")
    windows = by_bucket.applyInArrow(_sorted_bucket(buckets, length, shared), LISTS)
    windows = stage(windows.union(contexts.filter("bucket is null").select("kind", "target", "payload")), "suffix-windows")
    pieces = found.filter(F.col("kind") == _PIECES)
    removed = place_lists(pieces.union(windows.withColumn("kind", F.lit(_PIECES + 1))), pieces=2, places=1)
    joined = rows.join(removed.hint("shuffle_hash"), "row", "left")
    kind = "string" if as_text else "binary"
    rest = f", rest {rows.schema['rest'].dataType.simpleString()}" if carried else ""
    span = "spans array<struct<start:bigint,end:bigint>>"
    return joined.mapInArrow(_without(length, as_text, bool(carried)), f"doc_id long, kept {kind}, n_bytes long, n_removed long, {span}{rest}")


def op2_suffix_array(docs: DataFrame, by_id: bool = False) -> DataFrame:
    out = drop_repeated_bytes(docs, by_id=by_id)
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from ledgerlake.llm.packing import Encoder, default_vocabulary, op9_packing, pack_documents, packed_patterns


def tokenizer():
    return Tokenizer.from_file(default_vocabulary()[0])


def check(rows, docs, ids=False):
    """Every document's ids once, sequences gapless and not too long."""
    encoder, pieces, sequences = tokenizer(), defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == {i for i, _ in docs}
    for doc_id, text in docs:
        want = np.array([*encoder.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for r in sorted(pieces[doc_id], key=lambda r: r["start"]):
            assert (r["start"], r["doc_tokens"]) == (at, len(want))
            part = want[at : at + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(part.tobytes())
            assert not ids or r["ids"] == part.tolist()
            at += r["length"]
        assert at == len(want)
    assert set(sequences) == set(range(len(sequences)))
    for placed in sequences.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 2048
    return sum(r["length"] for r in rows) / 2048 / max(1, len(sequences))


def test_whole_table_round_trip_and_little_padding(documents):
    docs = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    assert check(op9_packing(documents).collect(), docs) > 0.98


ODD = ["", None, "a", " ", "  two  spaces \n\n\t x", "it's we'll THEY'VE", "<|endoftext|> inside", "日本語 текст ñandú É", "x\x1cy\x85z\u2028w\u00a0v", "12345 67.8", "\U0001f600 emoji", "word " * 5000, "a" * 9000]


def test_both_encoders_agree():
    vocabulary, ranks = default_vocabulary()
    both, rng = Encoder(vocabulary, ranks), random.Random(1)
    texts = [x for x in ODD if x] + ["".join(rng.choice("ab Z'.,\n\té ß12-$&") for _ in range(60)) for _ in range(3000)]
    for text in texts:
        assert both.ids(text).tolist() == [*both.tokenizer.encode(text, add_special_tokens=False).ids, 1]


def test_odd_texts_with_ids(frame):
    docs = list(enumerate(ODD))
    check(pack_documents(frame(docs)).collect(), docs, ids=True)


def test_repeated_rows_empty_table_and_clashing_columns(frame):
    rows = pack_documents(frame([(1, "x y"), (1, "x y")])).collect()
    assert len(rows) == 2 and {(r["sequence_id"], r["offset"]) for r in rows} == {(0, 0), (0, rows[0]["length"])}
    assert op9_packing(frame([])).collect() == []
    clash = frame([(1, "x y")]).selectExpr("*", "1 AS chunk", "2 AS length", "3 AS base", "4 AS ids")
    check(op9_packing(clash).collect(), [(1, "x y")])


def test_patterns_place_every_rank_once():
    rng = random.Random(2)
    for histogram in ({1: 100_000}, {2048: 7, 1025: 5, 1024: 9, 3: 1}, {rng.randint(1, 2048): rng.randint(1, 10**6) for _ in range(600)}):
        runs, space = packed_patterns(histogram), defaultdict(int)
        for length, n in histogram.items():
            ranks = sorted((first, count) for size, first, count, _, _ in runs if size == length)
            at = 0
            for first, count in ranks:
                assert first == at
                at += count
            assert at == n
        ends = defaultdict(int)
        for length, _, count, first, offset in runs:
            space[first, count] += length
            ends[first, count] = max(ends[first, count], offset + length)
        assert all(space[k] == ends[k] <= 2048 for k in space)
        assert sorted(first for first, _ in space)[0] == 0

"""Plain single-process versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def digest(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def repeated_words(docs: list[tuple], window: int = 35) -> list[tuple]:
    """(doc_id, n_words, n_removed, kept_sha256) for (doc_id, text) rows."""
    texts = [(i, WORD.findall((t or "").encode())) for i, t in docs]
    seen = Counter(tuple(w[x : x + window]) for _, w in texts for x in range(len(w) - window + 1))
    out = []
    for i, w in texts:
        gone = [False] * len(w)
        for x in range(len(w) - window + 1):
            if seen[tuple(w[x : x + window])] > 1:
                gone[x : x + window] = [True] * window
        kept = [a for a, b in zip(w, gone) if not b]
        out.append((i, len(w), len(w) - len(kept), digest(b" ".join(kept))))
    return sorted(out, key=repr)


def repeated_bytes(docs: list[tuple], length: int = 50) -> list[tuple]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for (doc_id, text) rows."""
    texts = [(i, (t or "").encode()) for i, t in docs]
    first: dict[bytes, int] = {}
    for i, t in texts:
        for x in range(len(t) - length + 1):
            key = t[x : x + length]
            first[key] = min(first.get(key, i), i)
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for x in range(len(t) - length + 1):
            if first[t[x : x + length]] < i:
                gone[x : x + length] = b"\1" * length
        kept = bytes(a for a, b in zip(t, gone) if not b)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out.append((i, len(t), len(t) - len(kept), spans, digest(kept)))
    return sorted(out, key=repr)


def shingles(text: str | None, width: int = 5) -> frozenset:
    words = (text or "").split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def similar(docs: list[tuple], least: float = 0.8) -> dict:
    """doc_id -> (class_id, n_links) for (doc_id, text) rows with distinct ids."""
    sets = {i: shingles(t) for i, t in docs}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    links, parent = Counter(), {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, s in sets.items():
        shared = Counter(j for x in s for j in holders[x] if j > i)
        for j, n in shared.items():
            if n / (len(s) + len(sets[j]) - n) >= least:
                links[i] += 1
                links[j] += 1
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (root(i), links[i]) for i in sets}


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)

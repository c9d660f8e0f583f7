"""URL filter by the ratio of two character language models.

Rules decide the URLs they fit. The others are judged by two smoothed variable-order Markov
models of bytes, one trained on accepted URLs and one on rejected URLs: the difference of
their log-likelihoods, divided by the length, is held against a threshold that is calibrated
on labelled URLs kept out of the training.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.common import flat

ORDER = 5  # the longest context; a context and its byte then fit into 48 bits
#: Labelled URLs the models are fitted on, for each of the two verdicts (chosen by hash).
SAMPLE = 20_000
#: Fixed values of the contract.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null if none does."""
    name = verdict = None
    for rule, says in sorted(rules, key=lambda r: -len(r[0])):
        domain, slash, rest = rule.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest)
        name = F.when(fits, rule) if name is None else name.when(fits, rule)
        verdict = F.when(fits, says) if verdict is None else verdict.when(fits, says)
    return name, verdict


def _grams(data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """For each order k the code of every byte with its k predecessors.

    A row starts after ORDER zero bytes, so codes never cross rows.
    """
    lengths = np.diff(offsets)
    at = np.arange(len(data)) + np.repeat(np.arange(1, len(lengths) + 1) * ORDER, lengths)
    padded = np.zeros(len(data) + (len(lengths) + 1) * ORDER, np.int64)
    padded[at] = data
    codes, out = padded[at], []
    out.append(codes)
    for k in range(1, ORDER + 1):
        codes = codes + (padded[at - k] << (8 * k))
        out.append(codes)
    return out


@dataclass
class MarkovModel:
    """Counts of contexts with their next byte, for all orders up to ORDER."""

    grams: list[np.ndarray]  # sorted codes for each order
    counts: list[np.ndarray]
    contexts: list[np.ndarray]
    totals: list[np.ndarray]  # bytes seen after each context
    kinds: list[np.ndarray]  # distinct bytes seen after each context

    @classmethod
    def fit(cls, urls: list[str]) -> MarkovModel:
        data, offsets = flat(pa.array(urls, pa.string()))
        parts = ([], [], [], [], [])
        for k, codes in enumerate(_grams(data, offsets)):
            grams, counts = np.unique(codes, return_counts=True)
            contexts, first = np.unique(_context(grams), return_inverse=True)
            totals = np.bincount(first, counts, len(contexts))
            for part, value in zip(parts, (grams, counts, contexts, totals, np.bincount(first, minlength=len(contexts)))):
                part.append(value)
        return cls(*parts)

    def log_likelihood(self, codes: list[np.ndarray]) -> np.ndarray:
        """Of every byte: orders from 0 up, each mixed with the shorter one (Witten-Bell)."""
        p = np.full(len(codes[0]), 1 / 256)
        for k, own in enumerate(codes):
            n = _looked_up(self.grams[k], self.counts[k], own)
            context = _context(own)
            total = _looked_up(self.contexts[k], self.totals[k], context)
            kinds = _looked_up(self.contexts[k], self.kinds[k], context)
            p = np.where(total > 0, (n + kinds * p) / np.maximum(total + kinds, 1), p)
        return np.log(p)


def _context(codes: np.ndarray) -> np.ndarray:
    """The code without its last byte."""
    return codes >> 8


def _looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted))
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0).astype(np.float64)


@dataclass
class UrlFilter:
    accepted: MarkovModel
    rejected: MarkovModel
    threshold: float

    def scores(self, urls: pa.Array) -> np.ndarray:
        """Log-likelihood difference for each byte of a URL; 0 for an empty or null one."""
        data, offsets = flat(urls)
        if not len(data):
            return np.zeros(len(offsets) - 1)
        codes = _grams(data, offsets)
        gain = self.accepted.log_likelihood(codes) - self.rejected.log_likelihood(codes)
        running = np.append(0.0, np.cumsum(gain))
        return (running[offsets[1:]] - running[offsets[:-1]]) / np.maximum(np.diff(offsets), 1)


def fit_filter(accepted: list[str], rejected: list[str]) -> UrlFilter:
    """Models from four fifths of the labelled URLs, the threshold from the rest.

    The threshold makes the larger of the two error rates smallest on the rest; ties take
    the middle. With a verdict that has no URL there is nothing to tell apart: 0.
    """
    cut = [x[: max(1, len(x) * 4 // 5)] for x in (accepted, rejected)]
    rest = [x[len(c) :] or c for x, c in zip((accepted, rejected), cut)]
    fitted = UrlFilter(MarkovModel.fit(cut[0]), MarkovModel.fit(cut[1]), 0.0)
    if accepted and rejected:
        good, bad = (np.sort(fitted.scores(pa.array(x, pa.string()))) for x in rest)
        tried = np.unique(np.concatenate([good, bad]))
        tried = (tried[1:] + tried[:-1]) / 2 if len(tried) > 1 else tried
        error = np.maximum(np.searchsorted(good, tried) / len(good), 1 - np.searchsorted(bad, tried) / len(bad))
        best = np.flatnonzero(error == error.min())
        fitted.threshold = float((tried[best[0]] + tried[best[-1]]) / 2)
    return fitted


def judge_urls(pages: DataFrame, url: str = "url", rules=RULES, sample: int = SAMPLE) -> DataFrame:
    """``pages`` with host, path, rule, verdict and score.

    The URLs that a rule decides are the labelled ones; at most ``sample`` distinct URLs of
    each verdict, smallest hash first, are fitted on. ``score`` is the length-normalised
    log-likelihood difference of every URL; where no rule fits, a score of at least the
    threshold is allowed. A null, empty or odd URL has empty host and path and score 0.
    Repeated rows stay; columns of the five names are replaced, others pass through.
    """
    made = ["host", "path", "rule", "verdict", "score"]
    kept = [c for c in pages.columns if c not in made]
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule, verdict = rule_for(host, path, rules)
    ruled = pages.select(*kept, host.alias("host"), path.alias("path"), rule.alias("rule"), verdict.alias("_ruled"))
    labelled = {}
    for says in ("allow", "block"):
        own = ruled.filter((F.col("_ruled") == says) & F.col(url).isNotNull()).select(F.col(url).alias("u")).distinct()
        labelled[says] = [r["u"] for r in own.orderBy(F.xxhash64("u"), "u").limit(sample).collect()]
    fitted = fit_filter(labelled["allow"], labelled["block"])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = fitted.scores(batch.column(url))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values)], [*batch.schema.names, "score"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ruled.schema)
    scored = ruled.mapInArrow(score, fields + ", score double")
    own = F.when(F.col("score") >= fitted.threshold, "allow").otherwise("block")
    return scored.select(*kept, "host", "path", "rule", F.coalesce("_ruled", own).alias("verdict"), "score")


def op3_url_markov(pages: DataFrame) -> DataFrame:
    return judge_urls(pages.select("page_id", "url")).drop("url")

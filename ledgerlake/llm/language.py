"""Language identification with hyperdimensional profiles.

Every letter has a fixed random vector of +1 and -1. A trigram binds its three letter
vectors, permuted by their place, into one; a text bundles (sums) its trigram vectors,
each weighted by the square root of its count; a language's prototype bundles the unit
vectors of its training texts. A text gets the language of the largest cosine.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from ledgerlake.llm.common import give_back, seeded, steps

DIMENSIONS = 1024
TELLING = 20  # letters from which on a text unlike every language can be told from a rare word
_STEP = 1 << 20  # text bundled at once: several tables of trigrams and vectors belong to it
_SPACE = 0
_CACHE: dict = {}


def _letter_table() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if "letters" not in _CACHE:
        _CACHE["letters"] = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _CACHE["letters"]


def _letter_vector(code: int) -> np.ndarray:
    vectors = _CACHE.setdefault("vectors", {})
    if code not in vectors:
        bits = np.unpackbits(seeded(1_000_003 * code + 17, DIMENSIONS // 64).view(np.uint8))
        vectors[code] = bits.astype(np.float32) * 2 - 1
    return vectors[code]


def _dense(values: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values below ``bound``, sorted, and each value's place among them."""
    if bound > 1 << 22:
        return np.unique(values, return_inverse=True)
    seen = np.zeros(bound, bool)
    seen[values] = True
    return np.flatnonzero(seen), (np.cumsum(seen, dtype=np.int32) - 1)[values]


def _bundles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """A unit vector for each text (zero if it has no letter), and whether it has one."""
    # A space on both sides: a text's trigrams do not depend on the texts beside it.
    joined = "\x00".join(f" {x.lower()} " for x in texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    breaks = codes == 0
    row = np.cumsum(breaks)
    if row[-1] + 1 != len(texts) if len(row) else len(texts) != 1:  # a text holds U+0000 itself
        return _bundles([x.replace("\x00", " ") for x in texts])
    letters = _letter_table()[codes]
    # Runs of other characters count as one space, so a trigram sees where words begin and end.
    keep = (letters | np.append(False, letters[:-1]) | np.append(True, breaks[:-1])) & ~breaks
    codes, row, letters = np.where(letters, codes, _SPACE)[keep], row[keep], letters[keep]
    alphabet, symbols = _dense(codes, 0x110000)
    size = len(alphabet)
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    has_letter = np.bincount(row[letters], minlength=len(texts)) > 0
    if len(symbols) < 3:
        symbols, row, letters = np.append(symbols, [0, 0]), np.append(row, [-1, -1]), np.append(letters, [False, False])
    grams = (symbols[:-2] * size + symbols[1:-1]) * size + symbols[2:]
    # The middle symbol is a letter: every word of n letters gives n trigrams.
    good = letters[1:-1] & (row[:-2] == row[2:])
    grams, owner = grams[good], row[1:-1][good]
    kinds, gram = _dense(grams, size**3)
    if not len(kinds):
        return out, has_letter
    profiles = np.stack([_letter_vector(int(c)) for c in alphabet])
    bound = np.roll(profiles, 2, 1)[kinds // size // size]
    bound *= np.roll(profiles, 1, 1)[kinds // size % size]
    bound *= profiles[kinds % size]
    for at in range(0, len(texts), 128):  # bounded tables of counts
        lo, hi = np.searchsorted(owner, (at, at + 128))
        n = min(128, len(texts) - at)
        own, inverse = _dense(gram[lo:hi], len(kinds))
        counts = np.bincount((owner[lo:hi] - at) * len(own) + inverse, minlength=n * len(own))
        out[at : at + n] = np.sqrt(counts.reshape(n, len(own))).astype(np.float32) @ bound[own]
    out /= np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)
    return out, has_letter


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict[str, np.ndarray]:
    """Prototypes of all non-null languages of ``docs``.

    Each task sums its own texts, so a task sends one vector for each language and the
    result has one vector for each language, however many documents there are.
    """

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in steps(batches, "text", _STEP):
            langs = np.array(batch.column("lang").to_pylist(), object)
            vectors, _ = _bundles(batch.column("text").to_pylist())
            for name in set(langs):
                found[name] = found.get(name, 0) + vectors[langs == name].sum(0, dtype=np.float64)
        give_back()
        values = [x.tolist() for x in found.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(values, pa.list_(pa.float64()))], ["lang", "v"])

    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("lang is not null and text is not null")
    partial = rows.mapInArrow(sums, "lang string, v array<double>")
    total = partial.select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
    prototypes: dict[str, np.ndarray] = {}
    for row in total.collect():
        prototypes.setdefault(row["lang"], np.zeros(DIMENSIONS))[row["i"]] = row["x"]
    return {k: v / np.linalg.norm(v) for k, v in sorted(prototypes.items()) if np.linalg.norm(v) > 0}


def predict(docs: DataFrame, prototypes: dict[str, np.ndarray], text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the cosine from 0 to 1.

    A text that is null or has no letter gets ``und`` and 0, as does every text when no
    language was learned. Equal cosines go to the first language by name. Repeated rows
    stay; columns named lang_pred or score are replaced, others are passed through.
    """
    names = list(prototypes) or ["und"]
    matrix = np.stack(list(prototypes.values())) if prototypes else np.zeros((1, DIMENSIONS))
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]
    place = kept.index(text)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, text, _STEP):
            vectors, has_letter = _bundles([x or "" for x in batch.column(place).to_pylist()])
            cosines = np.clip(vectors.astype(np.float64) @ matrix.T, 0.0, 1.0)
            best = cosines.argmax(1)
            found = has_letter & bool(prototypes)
            lang = [names[b] if ok else "und" for b, ok in zip(best, found)]
            score = np.where(found, cosines[np.arange(len(best)), best], 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lang, pa.string()), pa.array(score)], [*kept, "lang_pred", "score"])
        give_back()

    out = docs.select(*kept)
    fields = [*out.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]
    return out.mapInArrow(judge, StructType(fields))


def held_out() -> Column:
    """Whether a document is kept from learning; one without an id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op6_language(docs: DataFrame) -> DataFrame:
    """Predictions for all documents, learned from those that are not held out.

    A row without an id is not held out. Texts of any length are bundled whole, one of a single
    letter too; an empty table gives no row.
    """
    prototypes = train(docs.filter(~held_out()))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), prototypes).drop("text")


def least_cosine(languages: int, error: float = 1e-4) -> float:
    """The cosine that a text unlike every language reaches for any of them with probability ``error``.

    Cosines of unrelated directions are normal with standard deviation 1 / sqrt(DIMENSIONS).
    """
    return NormalDist().inv_cdf(1 - error / max(1, languages)) / DIMENSIONS**0.5


def accepted_languages(docs: DataFrame, least: float | None = None, telling: int = TELLING) -> DataFrame:
    """``docs`` without texts of no recognisable language.

    Rejects a text that is null or has no letter, and one of at least ``telling`` letters whose
    cosine with every language is below ``least``, by default :func:`least_cosine` of the languages
    learned. A shorter text stays: the few trigrams of a rare word may be unlike its own language.
    Repeated rows and rows without an id are judged like others; an empty table stays empty.
    """
    prototypes = train(docs.filter(~held_out()))
    judged = predict(docs, prototypes)
    bound = least_cosine(len(prototypes)) if least is None else least
    letters = F.length(F.regexp_replace("text", r"\P{L}+", ""))
    return judged.filter((F.col("lang_pred") != "und") & ((F.col("score") >= bound) | (letters < telling))).select(*docs.columns)

from __future__ import annotations

import zlib

from collections import Counter, defaultdict

import numpy as np

from ledgerlake.llm.language import DIMENSIONS, _bundles, _letter_vector, accepted_languages, least_cosine, op6_language, predict, train


def test_held_out_accuracy_on_the_whole_table(documents):
    truth = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    rows = op6_language(documents).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(truth)
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1
    judged = [r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["held_out"]]
    assert sum(judged) >= 0.97 * len(judged)


def test_labels_of_held_out_documents_change_nothing(documents):
    from pyspark.sql import functions as F

    other = documents.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit(None).cast("string"))
    key = lambda df: sorted((r["doc_id"], r["lang_pred"], round(r["score"], 6)) for r in op6_language(df).collect())
    assert key(other) == key(documents)


TEXTS = {"a": "the cat and the dog and the house over there ", "b": "ñoño año señor mañana español ", "c": "привет как дела друзья "}


def test_small_cases(spark):
    rows = [(i, TEXTS[l] * 3, l) for i, l in enumerate("abc" * 8)] + [(100, None, "a"), (101, "", "a"), (102, "12 !? \x00 34", "b"), (103, TEXTS["c"] * 9000, None), (104, TEXTS["b"].upper() + "\x00" + TEXTS["b"], None), (None, TEXTS["a"], None), (0, TEXTS["a"], "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 AS score", "'q' AS lang_pred", "'k' AS extra")
    got = {}
    for r in op6_language(df).collect():
        got.setdefault(r["doc_id"], []).append((r["lang_pred"], r["score"]))
    assert [got[i][0] for i in (100, 101, 102)] == [("und", 0.0)] * 3
    assert [got[i][0][0] for i in (0, 1, 2, 103, 104, None)] == ["a", "b", "c", "c", "b", "a"]
    assert len(got[0]) == 2
    kept = accepted_languages(df).collect()
    assert {r["doc_id"] for r in kept} == set(got) - {100, 101, 102} and kept[0]["extra"] == "k"


def test_nothing_to_learn_from_and_empty_table(spark):
    df = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert train(df) == {}
    assert [(r["lang_pred"], r["score"]) for r in predict(df, {}).collect()] == [("und", 0.0)]
    assert op6_language(df.limit(0)).collect() == []


def plain_vector(text):
    """The bundle of one text, trigram by trigram."""
    kept = "".join(c if c.isalpha() else " " for c in f" {text.lower()} ")
    while "  " in kept:
        kept = kept.replace("  ", " ")
    code = lambda c: _letter_vector(0 if c == " " else ord(c))
    grams = Counter(kept[i : i + 3] for i in range(len(kept) - 2) if kept[i + 1] != " ")
    out = np.zeros(DIMENSIONS)
    for gram, n in grams.items():
        a, b, c = (code(x) for x in gram)
        out += np.sqrt(n) * np.roll(a, 2) * np.roll(b, 1) * c
    return out / max(np.linalg.norm(out), 1e-9)


def test_bundles_against_a_plain_version():
    texts = ["a", "ab", "Zwei  Wörter!", "", "12", "ends in a letter", " 7x7 ", "ñ", "a\x00b", "the the the"]
    vectors, letters = _bundles(texts)
    for text, vector, has in zip(texts, vectors, letters):
        assert has == any(c.isalpha() for c in text)
        assert np.allclose(vector, plain_vector(text.replace("\x00", " ")), atol=1e-5)
    alone = np.concatenate([_bundles([t])[0] for t in texts])
    assert np.allclose(alone, vectors, atol=1e-6)


def test_predictions_do_not_depend_on_the_partitioning(spark, documents):
    rows = [(i, t, l) for i, (t, l) in enumerate((r["text"], r["lang"]) for r in documents.limit(300).collect())]
    rows += [(1000 + i, t, None) for i, t in enumerate(["a", "é", "on", "zu", "x y", "", "7"])] + [(None, "the end", "en")]
    seen = []
    for parts in (1, 7, 40):
        frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(parts)
        out = op6_language(frame).collect()
        assert all(isinstance(r["held_out"], bool) for r in out) and not next(r for r in out if r["doc_id"] is None)["held_out"]
        seen.append(sorted((repr(r["doc_id"]), r["lang_pred"], r["score"]) for r in out))
    for other in seen[1:]:
        assert [r[:2] for r in other] == [r[:2] for r in seen[0]]
        assert max(abs(a[2] - b[2]) for a, b in zip(other, seen[0])) < 5e-6  # single precision sums


def test_predictions_against_plain_prototypes(spark):
    rows = [(i, TEXTS[l] * (1 + i % 3) + f"{l}{i}", l) for i, l in enumerate("abc" * 8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sums = defaultdict(lambda: np.zeros(DIMENSIONS))
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2:
            sums[lang] += plain_vector(text)
    for r in op6_language(frame).collect():
        cosines = {k: float(plain_vector(rows[r["doc_id"]][1]) @ v / np.linalg.norm(v)) for k, v in sums.items()}
        best = max(cosines, key=cosines.get)
        assert r["lang_pred"] == best and abs(r["score"] - cosines[best]) < 1e-5


def test_unlearned_script_is_rejected(spark):
    rows = [(i, TEXTS[l] * 3, l) for i, l in enumerate("ab" * 20)]
    rows += [(100 + i, "".join(chr(0x4E00 + (i * 131 + j * 17) % 4000) for j in range(60)), None) for i in range(300)]
    rows += [(500, "xq", None), (501, "\u4e2d\u6587 12", None), (502, "12 34", None)]  # too short to tell, and no letter
    kept = {r["doc_id"] for r in accepted_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert kept == {*range(40), 500, 501}
    assert least_cosine(200) > least_cosine(2) > 3.5 / DIMENSIONS**0.5

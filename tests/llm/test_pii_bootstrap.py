from __future__ import annotations

import hashlib
import re
from collections import defaultdict

import pytest

from ledgerlake.llm.pii_bootstrap import LONGEST, ROUNDS, SUPPORT, TRUST, bootstrap, op12_pii_bootstrap

KINDS = ("email", "ip", "card", "phone")
FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SPACE = r"[ \t\n\x0b\f\r]"


def valid(kind, value):
    digits = re.sub(r"[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return True


def forms(text):
    return [(no, m.start(), m.end()) for no, k in enumerate(KINDS) for m in re.finditer(FORMS[k], text) if valid(k, m[0])]


def candidates(text):
    """(start, value, kind, patterns) of the runs of words with a digit or an at-sign."""
    words = [(m.start(), m.end()) for m in re.finditer(rf"(?:(?!{SPACE}).)+", text, re.S)]
    runs = []
    for s, e in words:
        if re.search("[0-9@]", text[s:e]):
            if runs and s - runs[-1][1] == 1:
                runs[-1][1] = e
            else:
                runs.append([s, e])
    out, before = [], 0
    for i, (s, e) in enumerate(runs):
        after = text[e : runs[i + 1][0]] if i + 1 < len(runs) else text[e:]
        left = re.split(rf"{SPACE}+", text[before:s].strip(" \t\n\x0b\f\r").lower())
        right = re.split(rf"{SPACE}+", after.strip(" \t\n\x0b\f\r").lower())
        before = e
        tail = re.sub(r"^[^0-9A-Za-z+(@]+", "", text[s:e])
        value = re.sub(r"[^0-9A-Za-z)]+$", "", tail)
        if not 1 <= len(value) <= LONGEST:
            continue
        kind = next((k for k in KINDS if re.fullmatch(FORMS[k], value) and valid(k, value)), None)
        if kind is None and forms(value):
            kind = ""
        l2, l1, r1 = left[-2] if len(left) > 1 else "", left[-1] or "^", right[0] or "$"
        at = s + (e - s) - len(tail)
        out.append((at, at + len(value), re.sub(SPACE, " ", value).lower(), kind, (f"{l1} _", f"{l2} {l1} _", f"{l1} _ {r1}")))
    return out


def discover(edges):
    """value -> kind for (pattern, value, kind) edges."""
    seeds = {v: k for _, v, k in edges if k}
    known = {v: (k, 1.0) for v, k in seeds.items()}
    values = defaultdict(set)
    for p, v, _ in edges:
        values[p].add(v)
    for _ in range(ROUNDS):
        best = {}
        for p, held in values.items():
            for kind in KINDS:
                total = sum(known[v][1] for v in held if v in known and known[v][0] == kind)
                trust = total / (len(held) + 1)
                if trust >= TRUST and total >= SUPPORT - 1e-9:
                    for v in held - seeds.keys():
                        best[v] = max(best.get(v, (0, "")), (trust, kind))
        found = {v: (k, t) for v, (t, k) in best.items()}
        if found.keys() == known.keys() - seeds.keys():
            break
        known = {v: (k, 1.0) for v, k in seeds.items()} | found
    return {v: k for v, (k, _) in known.items() if v not in seeds}


def brute(docs):
    texts = [(i, t or "") for i, t in docs]
    runs = [candidates(t) for _, t in texts]
    edges = {(p, v, k) for r in runs for _, _, v, k, ps in r if k != "" for p in ps}
    found = discover(edges)
    out = []
    for (i, t), r in zip(texts, runs):
        base = sorted(forms(t))
        more = [(KINDS.index(found[v]), s, e) for s, e, v, k, _ in r if k is None and v in found and not any(s < y and x < e for _, x, y in base)]
        text = lambda spans: ",".join(f"{KINDS[n]}:{s}:{e}" for n, s, e in sorted(spans))
        counts = [sum(b[0] == n for b in base) for n in range(4)]
        out.append((i, *counts, hashlib.sha256(text(base).encode()).hexdigest(), text(base + more), len(more)))
    return sorted(out, key=repr)


def found(frame):
    result = op12_pii_bootstrap(frame)
    assert result.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_context"]
    return sorted((tuple(r) for r in result.collect()), key=repr)


SEEDS = [(i, f"Please call me at +1 (5{i:02}) 555-01{i:02}, thanks {i}x.") for i in range(30)]
CASES = {
    "forms": [
        (1, "a@b.com_x@y.org a@b.c@d.e x@foo@bar.com a.b%c+d-e@x-y.z. @x.y a@b a@b. é@é.fr ä1@mail.de"),
        (2, "1.2.3.4.5.6.7.8 256.1.1.1 0255.01.1.255 1.2.3 1..2.3.4 10.0.0.1.\n999.1.1.1"),
        (3, "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 4876179267539117 5 55 378282246310005-"),
        (4, "+1 (517) 555-5141 +49 30 1234567. +12 +1234567890123456 ++33 1 23 45 67 89 +1 (836) 555-9331 4913187196670932"),
        (5, None), (6, ""), (6, "é😀 a@b.co 😀 10.1.2.3"), (6, "é😀 a@b.co 😀 10.1.2.3"), (None, "x@y.zz\t\x0bq@r.ss\x1cu@v.ww"), (7, "@ @@ 0 +"),
    ],
    "contexts": SEEDS + [(100, "Please call me at 555-0199 x7, thanks. Hm."), (101, "We saw 555-0199 x7 there, and «a1b2» (z9)."), (102, "Please call me at 10.0.0.1, thanks 3.")],
    "second hop": SEEDS + [(100 + i, f"Please call me at 66-77-{i:02}, thanks {i}x.") for i in range(5)] + [(200 + i, f"reach us on 66-77-{i:02} now") for i in range(5)] + [(300, "reach us on 88-99 now")],
    "a third are copies, patterns are common": [(i, "mail to me@here.org or 123-456 now" if i % 3 else f"mail to u{i}@here.org or {i}-9 now") for i in range(300)],
}


@pytest.mark.parametrize("name", CASES)
def test_small_cases(spark, name):
    frame = spark.createDataFrame(CASES[name], "doc_id long, text string").selectExpr("*", "1 AS row", "2 AS no", "'k' AS kind", "3 AS runs", "4 AS n_email")
    assert found(frame) == brute(CASES[name])


def test_contexts_discover_unseen_identifiers(spark):
    got = {r[0]: r for r in found(spark.createDataFrame(CASES["contexts"], "doc_id long, text string"))}
    assert got[100][6] == "phone:18:29" and got[101][6] == "phone:7:18"
    assert got[102][6] == "ip:18:26"


def test_empty_table(spark):
    assert found(spark.createDataFrame([], "doc_id long, text string")) == []


def test_very_long_texts(spark):
    texts = ["a" * 400_000 + "@", "1." * 200_000, "1 " * 200_000, "+" + "1 " * 200_000, "-" * 300_000 + "5" + "." * 300_000, "x@y" + ".z" * 200_000, "(" * 300_000]
    rows = found(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert [r[6] for r in rows] == ["", f"ip:{0}:7," + ",".join(f"ip:{s}:{s + 7}" for s in range(8, 400_000, 8)), "", "", "", f"email:0:{len(texts[5])}", ""]


def test_whole_table(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    assert found(documents) == brute(rows)


def test_scores_follow_the_graph(spark):
    edges = [(f"p{i % 4}", f"s{i}", "email") for i in range(48)] + [("p1", "new", None), ("q", "new", None), ("q", "other", None)]
    got = {r["value"]: (r["kind"], r["score"]) for r in bootstrap(spark.createDataFrame(edges, "pattern string, value string, kind string")).collect()}
    assert got == {"new": ("email", (12 + 12 / 14) / 14)}  # the second round counts the discovery itself

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ledgerlake.llm.multiprobe_lsh import nearest_neighbours, op4_multiprobe_lsh

SCHEMA = "vec_id long, embedding array<float>, label int"


def exact(rows, nearest=5):
    usable = [(i, np.array(v, np.float64)) for i, v in rows if v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    out = {}
    for q, v in usable:
        if q % 50 == 0:
            score = [(-float((v * w).sum() / np.sqrt((v * v).sum()) / np.sqrt((w * w).sum())), i) for i, w in usable if i != q]
            out[q] = [(i, -s) for s, i in sorted(score)[:nearest]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    return out


def test_recall_and_scores_on_the_whole_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    want, got = exact(rows), found(op4_multiprobe_lsh(table))
    assert set(got) == set(want)
    hits = sum(len({i for i, _ in want[q]} & {i for i, _, _ in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    vectors = {i: np.array(v, np.float64) for i, v in rows}
    for q, found_here in got.items():
        assert [r for _, _, r in found_here] == list(range(1, len(found_here) + 1))
        for i, score, _ in found_here:
            a, b = vectors[q], vectors[i]
            assert abs(score - (a * b).sum() / np.sqrt((a * a).sum() * (b * b).sum())) < 1e-12


def test_copies_ties_and_vectors_that_take_no_part(spark):
    rng = np.random.default_rng(3)
    base = [float(x) for x in rng.normal(size=8).astype(np.float32)]
    near = [base[0] + 0.01, *base[1:]]
    rows = [(i, base) for i in range(400)] + [(500 + i, near) for i in range(3)]
    rows += [(1000, None), (1050, [0.0] * 8), (1100, [float("nan")] * 8), (1150, [float("inf")] + base[1:]), (1200, [1.0, 2.0]), (None, base)]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA).repartition(5)
    got = found(op4_multiprobe_lsh(df))
    assert set(got) == {0, 50, 100, 150, 200, 250, 300, 350, 500}
    assert [i for i, _, _ in got[0]] == [1, 2, 3, 4, 5]
    assert [i for i, _, _ in got[50]] == [0, 1, 2, 3, 4]
    assert [i for i, _, _ in got[500]] == [501, 502, 0, 1, 2]


def test_few_candidates_empty_table_and_clashing_columns(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1)], SCHEMA)
    assert [(i, r) for i, _, r in found(op4_multiprobe_lsh(df))[0]] == [(1, 1)]
    assert op4_multiprobe_lsh(df.limit(0)).collect() == []
    clash = df.selectExpr("*", "1 AS id", "2 AS v", "3 AS part", "4 AS rank", "5 AS query_id")
    assert [(i, r) for i, _, r in found(op4_multiprobe_lsh(clash))[0]] == [(1, 1)]


def test_cut_parts_give_the_same(spark):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    whole = found(nearest_neighbours(table, F.col("id") % 50 == 0))
    assert found(nearest_neighbours(table, F.col("id") % 50 == 0, group_rows=20)) == whole


def test_far_candidates_are_found_where_there_are_few(spark):
    rng = np.random.default_rng(8)
    q, other = rng.normal(size=(2, 64)).astype(np.float32).tolist()
    spread = [(50 * i, v) for i, v in enumerate(rng.normal(size=(4, 64)).astype(np.float32).tolist())]
    spread += [(i + 1, [-x for x in v]) for i, v in spread[:2]]
    opposite = [(0, q), (1, [-x for x in q])]
    copies = [(0, q), (50, other)] + [(100 + i, [-x for x in q]) for i in range(300)]
    again = [(0, q)] + [(1, [x + i / 100 for x in q]) for i in range(40)] + [(2 + i, [-x for x in q]) for i in range(5)]
    for rows in (opposite, spread[:3], spread, copies):  # at most five candidates, or copies
        df = spark.createDataFrame([(i, v, 1) for i, v in rows], SCHEMA)
        want = {i: [x for x, _ in best] for i, best in exact(rows).items()}
        assert {i: [x for x, _, _ in best] for i, best in found(op4_multiprobe_lsh(df)).items()} == want
    got = found(nearest_neighbours(spark.createDataFrame([(i, v, 1) for i, v in again], SCHEMA), F.col("id") == 0, group_rows=3))
    assert [x for x, _, _ in got[0]] == [1, 2, 3, 4, 5]

"""Orphans of all relationships with one scan of each many side."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlake.operators import recon


def views(spark, tmp_path):
    """Every view of the model with a few rows, written, so that scans can be counted."""
    columns: dict[str, set] = {}
    for one, one_key, many, many_key in recon.RELATIONSHIPS:
        columns.setdefault(one, set()).add(one_key)
        columns.setdefault(many, set()).add(many_key)
    out = {}
    for name, keys in columns.items():
        rows = 3 if name.startswith(("dim_", "etl_batch")) else 8  # keys 3 to 7 have no partner
        frame = spark.range(rows).select(*[F.when(F.col("id") == 7, None).otherwise(F.col("id")).alias(k) for k in sorted(keys)])
        frame.union(frame).write.parquet(str(tmp_path / name))
        out[name] = spark.read.parquet(str(tmp_path / name))
    return out


def test_orphans_and_scans(spark, tmp_path):
    model = views(spark, tmp_path)
    found = recon.orphans(model, list(range(len(recon.RELATIONSHIPS))))
    assert sorted(map(tuple, found.collect())) == [(place, 10) for place in range(len(recon.RELATIONSHIPS))]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    for many in {r[2] for r in recon.RELATIONSHIPS}:
        keys = sorted({r[3] for r in recon.RELATIONSHIPS if r[2] == many})
        assert model[many].columns == keys
    assert plan.count("Relation") == len({r[2] for r in recon.RELATIONSHIPS}) + len(recon.RELATIONSHIPS)
    checks = {r["check_name"]: r["error_count"] for r in recon.orphan_checks(model).collect()}
    assert checks == dict.fromkeys(recon.ORPHAN_CHECKS, 10)
    assert recon.reference_orphans(model).count() == len(recon.RELATIONSHIPS)


def test_empty_sides(spark, tmp_path):
    model = views(spark, tmp_path)
    nothing = {name: frame.limit(0) for name, frame in model.items()}
    assert {r["orphans"] for r in recon.reference_orphans(nothing).collect()} == {0}
    no_partner = {name: frame.limit(0) if name.startswith("dim_") else frame for name, frame in model.items()}
    assert {r["error_count"] for r in recon.orphan_checks(no_partner).collect()} == {16}

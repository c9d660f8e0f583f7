"""The order-aware digest of a source file."""

from __future__ import annotations

import hashlib

from ledgerlake.sources import files


def plain(lines):
    """The digest tree by hand."""
    level = [hashlib.sha256(x.encode()).hexdigest() for x in lines]
    for _ in range(2):
        level = [hashlib.sha256("".join(level[i : i + files.DIGEST_FAN]).encode()).hexdigest() for i in range(0, len(level), files.DIGEST_FAN)]
    return hashlib.sha256("".join(level).encode()).hexdigest()


def test_digest_of_files_follows_lines_and_order_not_splits(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "DIGEST_FAN", 16)
    lines = [f"line {i % 7} {i}" for i in range(1000)] + ["", "last"]
    swapped = [lines[1], lines[0], *lines[2:]]
    for name, content in (("a", lines), ("b", swapped), ("none", [])):
        (tmp_path / name).write_text("".join(f"{x}\n" for x in content))
    size = (tmp_path / "a").stat().st_size
    expected = {
        "same": (str(tmp_path / "a"), size, plain(lines)),
        "swapped": (str(tmp_path / "b"), size, plain(lines)),
        "unknown": (str(tmp_path / "b"), size),
        "short": (str(tmp_path / "a"), size + 1, plain(lines)),
        "empty": (str(tmp_path / "none"), 0, plain([])),
        "missing": (str(tmp_path / "nowhere"), 1, "x"),
    }
    seen = []
    for split in ("128m", "1k"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        seen.append({r["source_name"]: (r["line_count"], r["digest"], r["status"]) for r in files.manifest(spark, expected).collect()})
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1]
    assert {k: v[2] for k, v in seen[0].items()} == {
        "same": "OK", "swapped": "DIGEST_MISMATCH", "unknown": "OK", "short": "SIZE_MISMATCH", "empty": "OK", "missing": "MISSING",
    }
    assert seen[0]["same"][:2] == (1002, plain(lines)) and seen[0]["swapped"][1] == plain(swapped)

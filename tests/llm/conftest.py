from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture
def frame(spark):
    """Documents from (doc_id, text) rows."""

    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA)

    return make


"""Small tables."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture
def documents(spark):
    def make(texts, ids=None, sources=None):
        ids = list(range(len(texts))) if ids is None else ids
        sources = ["s"] * len(texts) if sources is None else sources
        rows = list(zip(ids, texts, ["en"] * len(texts), sources, [len(t or "") for t in texts]))
        schema = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(rows, schema)

    return make

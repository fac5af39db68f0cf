from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from texts, numbered from 1, or from (id, text)."""
    def make(*texts, **extra):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts, 1)]
        frame = spark.createDataFrame(
            [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
        for name, value in extra.items():
            frame = frame.selectExpr("*", f"{value} AS `{name}`")
        return frame
    return make



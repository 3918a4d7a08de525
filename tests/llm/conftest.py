from __future__ import annotations

import pytest


@pytest.fixture
def docs(spark):
    """Makes a documents table with clashing extra columns from texts."""

    def make(texts, ids=None):
        rows = [(i if ids is None else ids[i], t, "x", "s") for i, t in enumerate(texts)]
        return spark.createDataFrame(rows, "doc_id long, text string, key string, source string")

    return make

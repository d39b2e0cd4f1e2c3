import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """Texts -> documents; every other column is null, and a clashing extra column is there."""
    def make(texts, ids=None, extra="kept"):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, None, None, None if t is None else len(t), "x") for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, f"{DOCS}, {extra} string")
    return make

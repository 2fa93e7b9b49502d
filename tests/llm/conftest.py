import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of texts (ids from 0) or of (id, text) rows."""

    def make(rows, extra=""):
        rows = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        rows = [(i, t, "en", "a", len(t or "")) for i, t in rows]
        return spark.createDataFrame(rows, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang, source) rows."""
    def make(rows):
        full = [(r[0], r[1], *(r[2:] or ("en", "s")), len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCUMENTS)

    return make


@pytest.fixture(scope="session")
def corpus(spark):
    """The driver's smallest tables."""
    folder = "/root/testdata/sf0.001"
    if not os.path.isdir(folder):
        pytest.skip("driver tables not present")
    return folder

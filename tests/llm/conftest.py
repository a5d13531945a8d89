import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture
def docs(spark):
    """(doc_id, text) pairs -> documents with extra columns whose names clash with those used inside."""
    def make(rows):
        return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], "doc_id long, text string, fp string, component long, key string")

    return make

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def sf_dir():
    return SF


def documents(spark, rows):
    """A documents table of (doc_id, text) with the other columns filled."""
    return spark.createDataFrame(
        [(i, t, "en", "src0", None if t is None else len(t)) for i, t in rows],
        "doc_id long, text string, lang string, source string, n_chars long",
    )

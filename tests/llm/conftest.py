import os

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
FOLDER = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(autouse=True)
def importable(spark):
    """Python workers find the package from any working directory."""
    spark.sparkContext.environment["PYTHONPATH"] = ROOT


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text, source) rows, with extra columns whose names clash with results."""

    def make(rows):
        rows = [(r + (None,) * 3)[:3] for r in rows]
        rows = [(i, t, "en", s, len(t or ""), "x", "y", 1.5) for i, t, s in rows]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, key string, grp string, score double"
        )

    return make

import sys
from pathlib import Path

import pytest

sys.path.append(str(Path(__file__).parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """The rows of the smallest documents table: (doc_id, text, lang, source)."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source")
    return [tuple(r) for r in rows.collect()]


@pytest.fixture(scope="session")
def table(spark):
    """documents-like rows from (doc_id, text[, lang[, source]]), with an extra column."""

    def make(rows, **more):
        full = [(*r, *(None,) * (4 - len(r)), 7) for r in rows]
        kinds = "doc_id long, text string, lang string, source string, n_chars long"
        return spark.createDataFrame(full, kinds).repartition(3)

    return make

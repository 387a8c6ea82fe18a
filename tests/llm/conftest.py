import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang, source]) tuples."""
    def run(rows, schema=DOC):
        if schema is not DOC:
            return spark.createDataFrame(rows, schema)
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOC)
    return run


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")

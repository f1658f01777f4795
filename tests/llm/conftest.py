import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) pairs, with extra columns that clash with result names."""
    def make(rows):
        return spark.createDataFrame([(i, t, "x", 1) for i, t in rows],
                                     "doc_id long, text string, kept string, n_tokens int")
    return make


@pytest.fixture(scope="session")
def check_docs():
    import pyarrow.parquet as pq
    return {r["doc_id"]: r for r in pq.read_table(f"{SF_CHECK}/documents.parquet").to_pylist()}

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs_rows():
    import pyarrow.parquet as pq

    return pq.read_table(f"{SF_SMALL}/documents.parquet").to_pylist()


@pytest.fixture
def docs_of(spark):
    """A documents table with the given texts; ids 0, 1, 2, ... unless given."""

    def make(texts, ids=None, sources=None):
        n = len(texts)
        ids = list(range(n)) if ids is None else ids
        sources = ["s"] * n if sources is None else sources
        rows = [(i, t, "en", s, len(t or ""), "x") for i, t, s in zip(ids, texts, sources, strict=True)]
        return spark.createDataFrame(
            rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"
        )

    return make

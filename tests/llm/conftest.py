import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names the operators use inside.
CLASHES = ("key", "id", "row", "digest", "cls", "kind", "part", "token", "tokens", "ids", "spans", "score", "n", "h", "unit", "term")


@pytest.fixture
def docs(spark):
    """A frame like ``documents`` of (doc_id, text) pairs, with further columns of clashing names."""

    def make(rows, lang="en"):
        full = [(i, t, lang, "src", len(t or "")) for i, t in rows]
        return spark.createDataFrame(full, DOCS).withColumns({c: F.lit("x") for c in CLASHES})

    return make


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")

import pytest
from odd_rows import ODD
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) rows."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "src0", len(r[1]) if r[1] else 0) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """The odd rows, with columns whose names clash with working ones."""
    from pyspark.sql import functions as F

    docs = make_docs([(*r, None if i % 4 == 0 else f"src{i % 3}") for i, r in enumerate(ODD)])
    return docs.withColumns({c: F.lit("clash") for c in ("size", "words", "token", "sig", "d", "r", "target", "shard", "row", "n", "kept", "key", "base")})


@pytest.fixture(scope="session")
def no_docs(make_docs):
    return make_docs([])

from __future__ import annotations

import pytest
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
    def make(rows):
        """Rows are (doc_id, text) or whole rows."""
        full = [tuple(r) + ("en", "s", len(r[1] or ""))[len(r) - 2 :] if len(r) < 5 else tuple(r) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def small_docs(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def difference_of(key, spark, sf="sf0.001"):
    """The registered query against its SQL, whole result against whole result."""
    from tests.oracle_check import connect, difference
    from wardlens.llm.queries import ORACLE, QUERIES

    path = f"/root/testdata/{sf}"
    assert difference(QUERIES[key](spark, path), connect(path), ORACLE[key]) is None

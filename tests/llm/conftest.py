from __future__ import annotations

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture()
def docs_of(spark):
    """Documents from (doc_id, text) pairs, in several partitions, with a clashing extra column."""
    def make(pairs):
        rows = [(i, t, "en", "s", len(t or "")) for i, t in pairs]
        df = spark.createDataFrame(rows, DOCS)
        return df.selectExpr("*", "'x' AS kept", "1 AS words", "'y' AS token").repartition(3)
    return make

"""A fixture that the tests of this folder share."""

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from texts (or (id, text) pairs), over three partitions."""
    def make(texts, lang="en", source=None):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        return spark.createDataFrame(
            [(i, t, lang if isinstance(lang, str) or lang is None else lang[k],
              (source[k] if source else f"s{k % 3}"), None if t is None else len(t)) for k, (i, t) in enumerate(rows)],
            DOCS).repartition(3)
    return make

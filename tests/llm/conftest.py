import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import types as T  # noqa: E402

from weft.llm.common import stored  # noqa: E402

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    # names that operators could have wanted for themselves
    T.StructField("shard", T.StringType()), T.StructField("rank", T.StringType()), T.StructField("kept", T.StringType()), T.StructField("digest", T.StringType()),
])


@pytest.fixture
def make_docs(spark):
    """A stored documents table with extra columns from (doc_id, text) or (doc_id, text, lang, source, n_chars)."""

    def make(rows):
        full = [(r[0], r[1], *(r[2:] if len(r) > 2 else ("en", "s", len(r[1] or "")))) + ("x", "y", "z", "w") for r in rows]
        return stored(spark.createDataFrame(full, SCHEMA).repartition(2), "test-docs")

    return make

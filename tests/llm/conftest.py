import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parent))

from conftest_llm import edge_texts  # noqa: E402

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that operators use inside.
        *[T.StructField(c, T.StringType()) for c in ("node", "row_key", "found", "words", "n", "hits", "row", "redacted", "kept_id")],
    ]
)


@pytest.fixture(scope="session")
def edge(spark):
    rows = [(i, t, None if t is None else len(t), *["x"] * 9) for i, t in edge_texts()]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCS)

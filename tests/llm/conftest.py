import pytest
from pyspark.sql import functions as F

from caudal.llm.common import importable

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    importable(spark)


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text) pairs, in several partitions, with columns whose names clash with results."""

    def documents(rows, parts=3):
        full = [(i, t, "en", "s1", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(parts) if full else spark.createDataFrame([], SCHEMA)
        clashing = ["size", "key", "kept", "part", "bucket", "row", "node", "p_quality", "text_sha256", "shard"]
        return df.withColumns({c: F.lit("x") for c in clashing})

    return documents

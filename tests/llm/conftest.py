import pytest
from pyspark.sql import types as T

DOCUMENTS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def docs(spark):
    """Documents from texts; a clashing column comes along, and `None` may stand for an id."""

    def make(texts, ids=None, schema=DOCUMENTS):
        ids = range(len(texts)) if ids is None else ids
        rows = [(i, t, "en", "src", len(t or "")) for i, t in zip(ids, texts)]
        return spark.createDataFrame(rows, schema)

    return make


@pytest.fixture
def clashing(spark):
    """The documents with extra columns whose names the operators use themselves."""
    names = (
        "digest", "bucket", "kept", "n_words", "slot", "shard", "size", "kinds", "found", "key",
        "node", "component", "row", "raw", "is_target", "ids", "start", "length", "bad", "rows",
        "kept_id", "kept_digest", "known_id", "known_digest", "values", "_found", "_values",
        "_first", "_digest", "_row", "a", "b", "first_doc", "component_id", "part", "place", "spans",
    )

    def add(frame):
        for name in names:
            frame = frame.withColumn(name, frame["n_chars"].cast(T.StringType()))
        return frame

    add.names = names
    return add

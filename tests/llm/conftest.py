import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """A documents table from (doc_id, text[, source]) rows in a few partitions."""
    def make(rows, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(parts)
    return make


@pytest.fixture(scope="session")
def odd_docs(make_docs):
    """Nulls, empty and long texts, repeated rows, ties and clashing column names."""
    rows = [(1, "a b c"), (1, "a b c"), (2, None), (3, ""), (None, "x y"), (None, None), (4, "lorem ipsum " * 20000),
            (5, "a b c"), (6, "été \U0001f600 z", None), (6, "other text", None), (7, " \t\n ", "t")]
    df = make_docs(rows)
    for name in ("_pid", "size", "shard", "slot", "_uid", "_hash", "last", "fingerprint", "copies", "_row", "anchor"):
        df = df.selectExpr("*", f"'clash' as {name}")
    return df

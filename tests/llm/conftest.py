import pytest
from pyspark.sql import types as T

DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with columns whose names the operators use themselves."""
    def make(rows):
        full = [(r[0], r[1], *(r[2:] if len(r) > 2 else ("en", "web")), len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        clashing = ("id", "ids", "size", "copies", "spans", "score", "lang_pred", "kept", "start", "labels", "target", "group", "n", "_id", "_text", "bytes")
        for name in clashing:
            df = df.selectExpr("*", f"'clash' AS {name}")
        return df
    return make

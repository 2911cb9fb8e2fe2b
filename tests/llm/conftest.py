import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
    T.StructField("n_chars", T.LongType())])
#: Columns that operators use for themselves too.
CLASHING = ("hash", "size", "node", "label", "score", "kept", "doc", "key", "gone_id", "text_key", "copies")


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) rows; ``extra`` adds columns
    whose names the operators use inside."""
    def make(rows, extra=False, parts=3):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(parts)
        if extra:
            from pyspark.sql import functions as F
            for c in CLASHING:
                df = df.withColumn(c, F.lit(f"x-{c}"))
        return df
    return make


@pytest.fixture(scope="session")
def fixture_rows(spark, small_dir):
    """All rows of the small documents table."""
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{small_dir}/documents.parquet").collect()]

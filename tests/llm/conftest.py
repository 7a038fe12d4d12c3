import pytest

DOCS = "doc_id long, text string"


@pytest.fixture(scope="session")
def llm(spark):
    """A frame of documents with extra columns whose names clash with what operators use inside."""
    from pyspark.sql import functions as F

    def make(rows, schema=DOCS):
        df = spark.createDataFrame(rows, schema)
        for name in ("_bytes", "leaks", "score", "kept", "removed", "key", "row", "n", "shard", "size", "id", "a", "b"):
            df = df.withColumn(name, F.lit(name))
        return df

    return make

import pytest
from pyspark.sql import functions as F


@pytest.fixture
def documents(spark):
    """A documents table from texts, with columns whose names clash with the operators' own."""

    def make(texts, ids=None, lang="en", source="s"):
        ids = range(len(texts)) if ids is None else ids
        rows = [
            (i, t, lang, source, None if t is None else len(t))
            for i, t in zip(ids, texts, strict=True)
        ]
        table = spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long"
        )
        return table.select("*", F.lit(1).alias("spans"), F.lit("x").alias("row"), F.lit(2).alias("n_words"))

    return make

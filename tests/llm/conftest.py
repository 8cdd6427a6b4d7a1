import pytest
from pyspark.sql import types as T

from featurelake.llm import common

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture()
def docs(spark):
    """docs(rows): a documents table of (doc_id, text[, lang[, source]]) rows."""
    common.ship_package(spark)

    def make(rows, **extra):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        from pyspark.sql import functions as F

        for name, value in extra.items():
            df = df.withColumn(name, F.lit(value))
        return df
    return make

"""Vocabularies as tables: dense order, encodings equal to Spark ML's, many categories."""

import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from featurelake.operators import trips as tp
from featurelake.operators.vocabulary import OneHotTables, numbered
from featurelake.session import scratch_dir


def test_indexes_are_dense_and_alphabetical(spark):
    values = ["b", "a", None, "", "a", "é", "z", "Z", "10", "9", "漢"]
    table, size, _ = numbered(spark.createDataFrame([(v,) for v in values], "`x.y` string"), "x.y")
    got = {r["value"]: r["index"] for r in table.collect()}
    assert got == {v: i for i, v in enumerate(sorted({v for v in values if v is not None}, key=str.encode))}
    assert size == len(got)
    assert numbered(spark.createDataFrame([], "v string"), "v")[0].count() == 0


def test_many_categories_stay_in_executors(spark):
    """200,000 values in 60 ranges: numbered without a gap, and no task holds more than a few ranges' share."""
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        table, _, path = numbered(spark.range(200_000).select(F.concat(F.lit("v"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("v")), "v")
        wrong = table.filter(F.col("index") != F.substring("value", 2, 7).cast("bigint")).count()
        parts = [r["count"] for r in spark.read.parquet(path).groupBy(F.shiftright("place", 33)).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert wrong == 0 and sum(parts) == 200_000 and max(parts) < 0.05 * 200_000


def test_vectors_equal_those_of_spark_ml(spark):
    rows = [("a", "x", 1.0), ("b", "y", 2.0), ("a", "y", 3.0), ("c", "x", 4.0)]
    train = spark.createDataFrame(rows, "p string, q string, n double")
    new = spark.createDataFrame([*rows, ("zz", "x", 5.0), ("b", "new", 6.0)], "p string, q string, n double")
    model = OneHotTables.fit(train, ["p", "q"], root := scratch_dir(spark, "one-hot"))
    assert OneHotTables.load(spark, root) == model and model.sizes == (3, 2)
    out = model.transform(new, ["n"])
    assert out.columns == ["p", "q", "n", "p__idx", "q__idx", "features"]
    got = {r["n"]: r["v"] for r in out.select("n", vector_to_array("features").alias("v")).collect()}
    plain = tp.fit_one_hot(train, ["p", "q"], ["n"]).transform(new).select("n", vector_to_array("features").alias("v"))
    assert got == {r["n"]: r["v"] for r in plain.collect()}
    nulls = model.transform(spark.createDataFrame([(None, "x", 1.0)], "p string, q string, n double"), ["n"])
    assert nulls.select(vector_to_array("features")).first()[0] == pytest.approx([0, 0, 0, 1, 0, 1])
    assert nulls.first()["p__idx"] is None

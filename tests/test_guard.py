"""Schemas kept with models and datasets: refusals, persistence, history."""

import datetime as dt
import json

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from featurelake.operators import guard
from featurelake.session import scratch_dir

AT = dt.datetime(2024, 1, 1)


@pytest.fixture()
def train(spark):
    return spark.createDataFrame([(float(i), i, 2.0 * i + 1, "x") for i in range(20)], "a double, b int, label double, note string")


def _stages():
    return [VectorAssembler(inputCols=["a", "b"], outputCol="features"), LinearRegression(solver="normal", regParam=0.1)]


def test_a_reloaded_model_refuses_a_drifted_frame(spark, train):
    path = scratch_dir(spark, "guarded")
    guard.guarded(_stages(), ["a", "b"]).fit(train).write().save(path)
    model = PipelineModel.load(path)
    assert model.stages[0].schema.simpleString() == "struct<a:double,b:int>"
    assert model.transform(train.withColumn("more", F.lit(1))).count() == 20
    for frame, problem in ((train.drop("a"), "missing column a"), (train.withColumn("b", F.col("b").cast("string")), "type of b: string != int"),
                           (train.withColumn("b", F.col("b").cast("bigint")), "type of b: bigint != int"),
                           (train.withColumn("a", F.col("a").cast("float")), "type of a: float != double")):
        with pytest.raises(guard.SchemaDrift, match=problem):
            model.transform(frame)
    with pytest.raises(guard.SchemaDrift) as all_of_them:
        model.transform(train.select("label"))
    assert all_of_them.value.problems == ["missing column a", "missing column b"]


def test_widening_is_a_choice_and_never_loses(train):
    model = guard.guarded(_stages(), ["a", "b"], allow_widening=True).fit(train)
    narrow = train.withColumn("a", F.col("a").cast("int")).withColumn("b", F.col("b").cast("smallint"))
    out = model.transform(narrow)
    assert out.schema["a"].dataType.simpleString() == "double" and out.schema["b"].dataType.simpleString() == "int"
    want = {r["label"]: r["prediction"] for r in model.transform(train).collect()}
    assert {r["label"]: r["prediction"] for r in out.collect()} == want
    with pytest.raises(guard.SchemaDrift, match="bigint != double"):  # 2^53 + 1 would be lost
        model.transform(train.withColumn("a", F.col("a").cast("bigint")))


def test_the_guard_adds_nothing_to_the_plan(train):
    model = guard.SchemaGuard(inputCols=["a"]).fit(train)
    assert model.transform(train) is train
    with pytest.raises(guard.SchemaDrift, match="missing column z"):
        guard.SchemaGuard(inputCols=["z"]).fit(train)


def test_guards_are_saved_unfitted_too(spark, train):
    path = scratch_dir(spark, "unfitted")
    guard.SchemaGuard(inputCols=["a", "b"], allowWidening=True).write().save(path)
    again = guard.SchemaGuard.load(path)
    assert again.getInputCols() == ["a", "b"] and again.fit(train).getOrDefault("allowWidening")


def test_history_compares_each_run_with_the_one_before(spark):
    kept = guard.SchemaHistory(spark, scratch_dir(spark, "schemas"))
    frames = ["SELECT 1 AS a, 'x' AS b, CAST(NULL AS INT) AS c, 1.0D AS `d.e`", "SELECT 1 AS a, 'x' AS b, 5 AS c, 1.0D AS `d.e`",
              "SELECT 1L AS a, CAST(NULL AS STRING) AS b, 1.0D AS `d.e`, map('k', 1) AS f", "SELECT 1L AS a, 1.0D AS `d.e`, map('k', 1) AS f, 'x' AS b"]
    got = [sorted((r["run"], r["column_name"], r["change"], r["type_before"], r["type_after"], r["filled_before"], r["filled_after"])
                  for r in kept.record(spark.sql(q), "t", AT + dt.timedelta(days=i)).collect()) for i, q in enumerate(frames)]
    assert got == [[], [(1, "c", "filled", "int", "int", 0, 1)],
                   [(2, "a", "retyped", "int", "bigint", 1, 1), (2, "b", "emptied", "string", "string", 1, 0), (2, "c", "removed", "int", None, 1, None),
                    (2, "f", "added", None, "map<string,int>", None, 1)],
                   [(3, "b", "filled", "string", "string", 0, 1)]]
    whole = guard.changes(kept.history("t").unionByName(kept.history("t").withColumn("dataset", F.lit("other"))))
    assert sorted(json.dumps(list(r)[1:]) for r in whole.filter("dataset = 'other'").collect()) == sorted(json.dumps(r) for run in got for r in map(list, run))


def test_a_frame_is_held_against_the_last_run(spark):
    kept = guard.SchemaHistory(spark, scratch_dir(spark, "schemas"))
    assert kept.history("t").count() == 0 and guard.changes(kept.history("t")).count() == 0
    kept.record(spark.sql("SELECT 1 AS a, 'x' AS b"), "t", AT)
    kept.record(spark.sql("SELECT 1 AS a, 2 AS b"), "t", AT)
    good = spark.sql("SELECT 3 AS b, 1 AS a, 'more' AS c")
    assert kept.check(good, "t") is good
    with pytest.raises(guard.SchemaDrift, match="type of b: string != int"):
        kept.check(spark.sql("SELECT 1 AS a, 'x' AS b"), "t")
    empty = spark.sql("SELECT 1 AS a, 2 AS b").limit(0)
    assert {r["change"] for r in kept.record(empty, "t", AT).collect()} == {"emptied"}

"""Queries for Spark ML: scaling, PCA, models, search, batch scoring."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featurelake.functions.columns import hash_bucket, quantize, rounded
from featurelake.operators import guard
from featurelake.operators import metrics as mt
from featurelake.operators import models as ml
from featurelake.operators import store as st
from featurelake.operators import transform as tr
from featurelake.operators import trips as tp
from featurelake.plans.catalog import query
from featurelake.plans.q_trips import TEST_FROM, VAL_FROM, prepared
from featurelake.session import scratch_dir, written
from featurelake.sources import fixtures as fx

#: All engineered features; the assembler takes no NULLs, so an undefined ratio counts as 0.
ENGINEERED = ["sepal_length", "sepal_width", "petal_length", "petal_width", "sepal_area", "petal_area",
              "sepal_length_to_width_ratio", "petal_length_to_width_ratio", "log_sepal_length", "log_petal_length", "sepal_length_squared", "petal_length_squared",
              "feature_sum", "feature_mean"]


@query("standard_scale")
def standard_scale(spark, sf_dir):
    df = fx.flowers(spark, sf_dir, balance=True)
    model = ml.feature_pipeline(fx.FLOWER_FEATURES, with_pca=False).fit(df)
    return rounded(ml.scaled_columns(model.transform(df), fx.FLOWER_FEATURES), 6)


@query("pca")
def pca(spark, sf_dir):
    eng = tr.engineer_features(fx.flowers(spark, sf_dir, balance=True)).fillna(0.0, ENGINEERED)
    model = ml.feature_pipeline(ENGINEERED).fit(eng)
    arr = F.col("pca")
    out = model.transform(eng).select(tr.vector_to_array_col("pca_features").alias("pca"))
    return out.select(*[arr[i].alias(f"pc{i + 1}") for i in range(10)])


def learnable_rows(spark, sf_dir):
    """X10 with one row per order line: order key and line number repeat in the given table, so the largest values stand for a line."""
    key = F.concat_ws("-", "l_orderkey", "l_linenumber").alias("row_key")
    rows = fx.learnable(spark, sf_dir).groupBy(key).agg(*[F.max(c).alias(c) for c in ("quantity", "tax", "discount")])
    q, t = F.col("quantity"), F.col("tax")
    return rows.select("*", F.when(q < 17, 0).when(q < 34, 1).otherwise(2).cast("double").alias("label"), (3 * q - 2 * t + 5).alias("y"))


def _learnable_split(spark, sf_dir):
    """The rows are grouped and written once: every fit and metric reads them again."""
    df, _ = written(tp.hash_split(learnable_rows(spark, sf_dir), "row_key", 80), "learnable")
    va = VectorAssembler(inputCols=["quantity", "tax", "discount"], outputCol="features")
    return va.transform(df)


@query("logreg")
def logreg(spark, sf_dir):
    df = _learnable_split(spark, sf_dir)
    model = ml.logistic_regression(df.filter(F.col("split") == "train"), label="label")
    pred = model.transform(df.filter(F.col("split") == "test"))
    return mt.class_metrics(pred.select(F.col("label").alias("actual"), F.col("prediction").alias("predicted")))


@query("linreg")
def linreg(spark, sf_dir):
    data = tp.temporal_split(prepared(spark, sf_dir), "pickup_datetime", VAL_FROM, TEST_FROM)
    train, _ = written(data.filter(F.col("split") == "train").select("PU_DO", "duration"), "trips")  # the joins run once
    enc = tp.fit_one_hot(train, ["PU_DO"], [])
    x = enc.transform(train).select("features", F.col("duration").alias("label"))
    model = ml.linear_regression(x)
    pred = model.transform(x)
    err = F.col("prediction") - F.col("label")
    return pred.agg(quantize(F.sqrt(F.avg(err * err)), 4).alias("train_rmse"), F.count(F.lit(1)).alias("n_train"))


@query("linreg_ids")
def linreg_ids(spark, sf_dir):
    """M9 on the two one-hot ids with intercept; the target is a sum of both ids' effects, so the fit is exact."""
    trips = tp.trip_prep(fx.minute_trips(spark, sf_dir), "lpep_pickup_datetime", "lpep_dropoff_datetime", pair=False)
    label = 2 * F.col("PULocationID").cast("double") + 3 * F.col("DOLocationID").cast("double") + 5
    enc = tp.fit_one_hot(trips, ["PULocationID", "DOLocationID"], [])
    x = enc.transform(trips).select("features", label.alias("label"))
    pred = ml.linear_regression(x).transform(x)
    err = F.col("prediction") - F.col("label")
    return pred.agg(F.abs(F.round(F.sqrt(F.avg(err * err)), 2)).alias("train_rmse"), F.count(F.lit(1)).alias("n_train"))


@query("pca_variance")
def pca_variance(spark, sf_dir):
    """M3 against the correlation matrix: all components' variances sum to the number of features, their squares to
    the sum of squared correlations."""
    eng = tr.engineer_features(fx.flowers(spark, sf_dir, balance=True)).fillna(0.0, ENGINEERED)
    k = len(ENGINEERED)
    model = ml.feature_pipeline(ENGINEERED, k=k).fit(eng)
    pcs = model.transform(eng).select(tr.vector_to_array_col("pca_features").alias("pca"))
    var = pcs.agg(*[F.var_samp(F.col("pca")[i]).alias(f"v{i}") for i in range(k)])
    return var.select(F.lit(k).cast("bigint").alias("n_components"), quantize(sum((F.col(f"v{i}") for i in range(k)), F.lit(0.0)), 4).alias("total"),
                      quantize(sum((F.col(f"v{i}") * F.col(f"v{i}") for i in range(k)), F.lit(0.0)), 4).alias("squares"))


@query("batch_score_linear")
def batch_score_linear(spark, sf_dir):
    """M8-M11 with a known answer: a saved and reloaded linear model predicts y = 3 quantity - 2 tax + 5 of the test rows."""
    df = _learnable_split(spark, sf_dir)
    model = ml.linear_regression(df.filter(F.col("split") == "train").select("features", F.col("y").alias("label")))
    path = ml.save(model, scratch_dir(spark, "model"))
    scored = ml.load(path).transform(df.filter(F.col("split") == "test"))
    out = scored.select("row_key", quantize(F.col("prediction"), 4).alias("predicted_target"))
    return st.melt(out, key="row_key", values=["predicted_target"], prefix="test_sample_", event_ts="2024-01-31 00:00:00")


@query("guarded_score")
def guarded_score(spark, sf_dir):
    """A model behind its schema guard, saved and reloaded. Rows whose numbers widen without loss are scored; a frame whose columns
    have drifted is refused, and the refusal is counted beside the rows that it covers."""
    df = learnable_rows(spark, sf_dir)
    cols = ["quantity", "tax"]
    train = df.filter(hash_bucket("row_key", 100) < 80)
    stages = [VectorAssembler(inputCols=cols, outputCol="x"), LinearRegression(featuresCol="x", labelCol="y", solver="normal")]
    model = ml.load(ml.save(guard.guarded(stages, cols, allow_widening=True).fit(train), scratch_dir(spark, "guarded")))
    test = df.filter(hash_bucket("row_key", 100) >= 80)
    whole = test.withColumn("quantity", F.col("quantity").cast("int"))
    drifted = {"tax as text": test.withColumn("tax", F.col("tax").cast("string")), "no quantity": test.drop("quantity")}
    out = [model.transform(f).agg(F.lit(name).alias("frame"), F.lit(None).cast("string").alias("refused"), F.count(F.lit(1)).alias("n_rows"),
                                  quantize(F.avg("prediction"), 4).alias("mean_prediction")) for name, f in (("as trained", test), ("whole numbers", whole))]
    for name, frame in drifted.items():
        try:
            model.transform(frame)
        except guard.SchemaDrift as e:
            out.append(frame.agg(F.lit(name).alias("frame"), F.lit("; ".join(e.problems)).alias("refused"), F.count(F.lit(1)).alias("n_rows"),
                                 F.lit(None).cast("double").alias("mean_prediction")))
    return reduce(DataFrame.unionByName, out)


@query("model_floors")
def model_floors(spark, sf_dir):
    """M8 and M10 against the floors that tests hold them to, on the repeatable split: rows of each part, and whether each passes."""
    df = _learnable_split(spark, sf_dir)
    train, test = df.filter(F.col("split") == "train"), df.filter(F.col("split") == "test")
    pred = ml.logistic_regression(train, label="label").transform(test)
    logistic = mt.class_metrics(pred.select(F.col("label").alias("actual"), F.col("prediction").alias("predicted")))
    forest = ml.random_forest(train, label="y", num_trees=20, max_depth=10).transform(test)
    forest = mt.regression_metrics(forest, actual="y", predicted="prediction")
    rows = df.agg(F.count_if(F.col("split") == "train").alias("n_train"), F.count_if(F.col("split") == "test").alias("n_test"))
    passes = (logistic.select(F.lit("logistic_regression").alias("model"), (F.col("accuracy") >= 0.9).alias("passes"))
              .unionByName(forest.select(F.lit("random_forest").alias("model"), (F.col("r2") >= 0.9).alias("passes"))))
    return passes.crossJoin(F.broadcast(rows))  # two rows and one


@query("random_forest")
def random_forest(spark, sf_dir):
    df = _learnable_split(spark, sf_dir).withColumnRenamed("y", "target_y")
    model = ml.random_forest(df.filter(F.col("split") == "train"), label="target_y", num_trees=20, max_depth=10)
    pred = model.transform(df.filter(F.col("split") == "test"))
    return mt.regression_metrics(pred, actual="target_y", predicted="prediction")


@query("hyper_search")
def hyper_search(spark, sf_dir):
    """The trials of the first budget, the rows that fit and validate them, and whether each beats the mean."""
    df = _learnable_split(spark, sf_dir)
    found = ml.hyper_search(df.filter(F.col("split") == "train"), label="y", key="row_key")
    return found.select("trial", "max_depth", "num_trees", "min_instances", "n_fit", "n_val", (F.col("val_rmse") < F.col("mean_rmse")).alias("beats_mean"))


@query("batch_score")
def batch_score(spark, sf_dir):
    df = _learnable_split(spark, sf_dir)
    model = ml.logistic_regression(df.filter(F.col("split") == "train"), label="label")
    path = ml.save(model, scratch_dir(spark, "model"))
    scored = ml.load(path).transform(df.filter(F.col("split") == "test"))
    out = scored.select("row_key", F.col("prediction").alias("predicted_target"))
    return st.melt(out, key="row_key", values=["predicted_target"], prefix="test_sample_", event_ts="2024-01-31 00:00:00")


@query("model_selection")
def model_selection(spark, sf_dir):
    """The five best trials, fitted anew: rows of each part, whether both errors are under half those of the mean, and the order."""
    df = _learnable_split(spark, sf_dir).withColumn("part", tp.hash_bucket_col("row_key"))
    train = df.filter(F.col("split") == "train")
    val, test = train.filter(F.col("part") < 10), df.filter(F.col("split") == "test")
    fit = train.filter(F.col("part") >= 10)
    trials = ml.hyper_search(fit, label="y", key="row_key")
    found = ml.retrain_and_select(trials, fit, val, test, top=5, label="y")
    place = F.row_number().over(Window.orderBy("val_rmse", "trial"))  # five rows
    return found.select(place.alias("place"), "val_n", "test_n", *[(F.col(f"{p}_rmse") < 0.5 * F.col(f"{p}_rmse_of_mean")).alias(f"{p}_passes") for p in ("val", "test")])


@query("batch_flow")
def batch_flow(spark, sf_dir):
    from featurelake.api import run_batch_flow

    return run_batch_flow(spark, learnable_rows(spark, sf_dir), "row_key", ["quantity", "tax", "discount"], "label",
                          scratch_dir(spark, "batch-flow"))

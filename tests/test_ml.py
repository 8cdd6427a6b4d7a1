"""Model quality by tolerance (never raw coefficients), on the learnable stand-in X10."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as se
from featurelake import api
from featurelake.operators import bins as bn
from featurelake.operators import models as ml
from featurelake.operators import search
from featurelake.operators import trips as tp
from featurelake.plans import q_ml
from featurelake.session import scratch_dir, written
from featurelake.sources import fixtures as fx
from tests.conftest import SF_MID, SF_SMALL


def test_logreg_learns_the_band_classes(spark):
    r = se.queries()["logreg"](spark, SF_MID).first()
    assert r["accuracy"] > 0.9 and r["f1"] > 0.9


def test_forest_beats_the_mean_predictor(spark):
    r = se.queries()["random_forest"](spark, SF_SMALL).first()
    y = fx.learnable(spark, SF_SMALL).agg(F.stddev_pop("y")).first()[0]
    assert r["rmse"] < 0.5 * y and r["r2"] > 0.75


def test_linear_model_recovers_known_coefficients(spark):
    df = VectorAssembler(inputCols=["quantity", "tax"], outputCol="features").transform(fx.learnable(spark, SF_SMALL))
    lr = ml.linear_regression(df, label="y").stages[-1]
    assert list(lr.coefficients) == pytest.approx([3.0, -2.0], abs=1e-6)
    assert lr.intercept == pytest.approx(5.0, abs=1e-6)


def test_scaler_and_pca(spark):
    scaled = se.queries()["standard_scale"](spark, SF_SMALL)
    s = scaled.agg(F.avg("sepal_length_scaled").alias("m"), F.stddev_samp("sepal_length_scaled").alias("s")).first()
    assert abs(s["m"]) < 1e-6 and s["s"] == pytest.approx(1.0, abs=1e-4)
    pcs = se.queries()["pca"](spark, SF_SMALL)
    var = pcs.agg(*[F.var_samp(f"pc{i}").alias(f"v{i}") for i in range(1, 11)]).first()
    vs = [var[f"v{i}"] for i in range(1, 11)]
    assert all(a >= b - 1e-9 for a, b in zip(vs, vs[1:]))


def test_saved_model_scores_the_same_after_reload(spark):
    rows = se.queries()["batch_score"](spark, SF_SMALL)
    assert rows.count() > 0
    assert set(r["feature_name"] for r in rows.select("feature_name").distinct().collect()) == {"predicted_target"}


def parts(spark, sf_dir=SF_SMALL):
    df = q_ml._learnable_split(spark, sf_dir).coalesce(2)
    return df.filter("split = 'train'").persist(), df.filter("split = 'test'").persist()


def test_trials_are_prefixes_and_cuts_of_one_forest(spark):
    """Errors read off the deep forest equal those of Spark's own forest of the same trees, and with all features looked at, of its shallow ones."""
    train, test = parts(spark)
    trials = [search.Trial(0, 12, 20, 1, "all"), search.Trial(1, 4, 20, 1, "all"), search.Trial(2, 12, 7, 1, "all"), search.Trial(3, 1, 1, 1, "all")]
    forests = search.fit_forests(train, trials, label="y", seed=3)
    assert len(forests) == 1 and len(forests[0].trees) == 20
    got = {r["trial"]: r["rmse"] for r in search.score(test, forests, label="y").collect()}
    for trial, depth in ((0, 12), (1, 4)):
        own = ml.random_forest(train, label="y", num_trees=20, max_depth=depth, subset="all", seed=3)
        assert got[trial] == pytest.approx(ml.rmse(own.transform(test), "y"), rel=1e-9)
    x = np.array([r["features"].toArray() for r in test.select("features").collect()])
    whole = RandomForestRegressor(featuresCol="features", labelCol="y", numTrees=20, maxDepth=12, featureSubsetStrategy="all", seed=3).fit(train)
    mean = sum(np.array([r["prediction"] for r in t.transform(test.select("features")).collect()]) for t in whole.trees[:7]) / 7
    by_trial = {t.trial: p for t, p in search.predictions(forests[0], x)}
    assert by_trial[2] == pytest.approx(mean, rel=1e-9)


def test_two_valued_features_split_as_in_the_model(spark):
    raw = spark.range(400).select((F.col("id") % 7).cast("string").alias("c"), (F.col("id") % 11).cast("double").alias("v"))
    x = tp.fit_one_hot(raw, ["c"], ["v"]).transform(raw).select("features", (F.col("c").cast("int") * 3 + F.col("v")).cast("double").alias("y")).coalesce(1).persist()
    trial = search.Trial(0, 8, 10, 1, "all")
    got = search.score(x, search.fit_forests(x, [trial], label="y"), label="y").first()
    own = ml.random_forest(x, label="y", num_trees=10, max_depth=8, subset="all", seed=42)
    assert got["rmse"] == pytest.approx(ml.rmse(own.transform(x), "y"), rel=1e-9) and got["n"] == 400


def test_search_fits_one_forest_a_group_and_reports_each_trial(spark):
    train, test = parts(spark)
    t = ml.hyper_search(train, label="y", key="row_key").collect()
    assert len(t) == 15 and sorted(r["trial"] for r in t) == list(range(15))
    assert all(a["val_rmse"] <= b["val_rmse"] for a, b in zip(t, t[1:])) and t[0]["val_rmse"] < 0.2 * t[0]["mean_rmse"]
    drawn = search.sample_trials(15)
    assert len({(d.min_instances, d.subset) for d in drawn}) <= 4


def many_rows(spark, n=20_000):
    """Rows of no common value, whose target has noise of its own."""
    u = [F.pmod(F.xxhash64("id", F.lit(i)), F.lit(10**9)) / 1e9 for i in range(4)]
    rows = spark.range(n, numPartitions=3).select("id", u[0].alias("a"), (u[1] * u[1] * 100).alias("b"), (10 * u[0] + F.sqrt(u[1]) + u[3]).alias("y"))
    return VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(rows)


def test_many_rows_are_fitted_as_weighted_shares(spark):
    """A forest of shares counts every row, errs as one of rows does, keeps its leaves' least rows, and can be saved."""
    x = many_rows(spark)
    bins, shares, n = bn.condensed(x, "features", "y", rows=4000)
    whole = shares.agg(F.sum("weight").alias("n"), F.count(F.lit(1)).alias("shares"), F.sum(F.col("weight") * F.col("y")).alias("y")).first()
    assert n == whole["n"] == 20_000 and 2500 < whole["shares"] < 5000
    assert whole["y"] == pytest.approx(x.agg(F.sum("y")).first()[0], rel=1e-9)
    assert bn.condensed(x, "features", "y", rows=20_000) is None
    fresh = many_rows(spark, 25_000).filter("id >= 20000")
    few, own = ml.random_forest(x, label="y", rows=4000), ml.random_forest(x, label="y")
    assert ml.rmse(few.transform(fresh), "y") < 1.1 * ml.rmse(own.transform(fresh), "y") < 0.2 * 3
    path = ml.save(few, scratch_dir(spark, "model"))
    assert ml.rmse(ml.load(path).transform(fresh), "y") == pytest.approx(ml.rmse(few.transform(fresh), "y"), rel=1e-12)
    tree = ml.random_forest(x, label="y", num_trees=1, max_depth=12, min_instances=700, rows=4000)
    sizes = [r["count"] for r in tree.transform(x).groupBy("prediction").count().collect()]
    assert min(sizes) > 300 and len(sizes) > 5  # the bootstrap's 700 rows


def test_errors_of_cells_are_those_of_their_rows(spark):
    x = many_rows(spark, 9000)
    trials = [search.Trial(0, 9, 5, 1, "all"), search.Trial(1, 3, 3, 1, "all")]
    forests = search.fit_forests(x, trials, label="y", rows=2000)
    got = {r["trial"]: (r["n"], r["rmse"], r["rmse_of_mean"]) for r in search.score(x, forests, label="y").collect()}
    rows = forests[0].bins.transform(x).select(forests[0].bins.getOutputCol(), "y").collect()
    v, y = np.array([r[0].toArray() for r in rows]), np.array([r[1] for r in rows])
    for t, p in search.predictions(forests[0], v):
        assert got[t.trial] == (9000, pytest.approx(float(np.sqrt(np.mean((p - y) ** 2))), rel=1e-9), pytest.approx(float(np.std(y)), rel=1e-9))


def test_second_budget_of_thirty_trials_runs(spark):
    train, _ = parts(spark)
    t = ml.hyper_search(train, label="y", trials=30, depth=(2, 30), trees=(50, 300), leaf=(1, 1), subsets=("0.3", "0.6", "1.0"), key="row_key").collect()
    assert len(t) == 30 and max(r["num_trees"] for r in t) > 250 and all(r["val_rmse"] < r["mean_rmse"] for r in t)


def test_rows_that_several_steps_read_are_written_once(spark, monkeypatch):
    kept = []

    def spy(frame, name):
        kept.append(name)
        return written(frame, name)

    monkeypatch.setattr(q_ml, "written", spy)
    monkeypatch.setattr(api, "written", spy)
    assert se.queries()["linreg"](spark, SF_SMALL).inputFiles() and kept == ["trips"]
    plan = se.queries()["linreg"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan  # the joins are not run for the predictions
    rows = spark.range(400).select(F.col("id").alias("k"), (F.col("id") % 2).cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("label"))
    assert api.run_batch_flow(spark, rows, "k", ["a"], "label", scratch_dir(spark, "flow")).first()["status"] == "SUCCESS"
    assert kept == ["trips", "trips", "rows"]


def test_fits_and_metrics_read_grouped_rows(spark):
    """The grouping of the order lines lies behind a written table: no fit, count or metric of model_floors repeats it."""
    rows = q_ml._learnable_split(spark, SF_SMALL)
    assert rows.inputFiles() and not any("lineitem" in f for f in rows.inputFiles())
    assert "Aggregate" not in rows._jdf.queryExecution().optimizedPlan().toString()


def test_two_classes_are_scored_after_a_frame_was_observed(spark):
    seen = Observation("rows")
    spark.range(5).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    x = VectorAssembler(inputCols=["a"], outputCol="features").transform(spark.range(40).select((F.col("id") % 2).cast("double").alias("a"), (F.col("id") % 2).cast("double").alias("label")))
    assert seen.get["n"] == 5 and ml.logistic_regression(x).transform(x).filter("prediction = label").count() == 40


def test_batch_flow_passes_the_gate_on_learnable_data(spark):
    r = se.queries()["batch_flow"](spark, SF_MID).first()
    assert r["status"] == "SUCCESS" and r["accuracy"] >= 0.9 and r["f1"] >= 0.9

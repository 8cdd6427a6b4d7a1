"""Queries for model metrics, gates, rule scores and candidate ranking."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurelake.functions.columns import quantize, rounded, safe_div
from featurelake.operators import metrics as mt
from featurelake.operators import transform as tr
from featurelake.plans.catalog import query
from featurelake.sources import fixtures as fx
from featurelake.sources.tables import table


@query("class_metrics")
def class_metrics(spark, sf_dir):
    return rounded(mt.class_metrics(fx.class_predictions(spark, sf_dir)), 9)


@query("regression_metrics")
def regression_metrics(spark, sf_dir):
    m = mt.regression_metrics(fx.regression_predictions(spark, sf_dir))
    return m.select(quantize("r2", 9).alias("r2"), quantize("mse", 4).alias("mse"), quantize("rmse", 6).alias("rmse"))


@query("residuals")
def residuals(spark, sf_dir):
    preds, actual = fx.order_predictions(spark, sf_dir)
    return rounded(tr.residuals(preds, actual), 6, ["predicted", "difference"])


@query("metric_gate")
def metric_gate(spark, sf_dir):
    g = mt.gate(mt.class_metrics(fx.class_predictions(spark, sf_dir)))
    return rounded(g, 9, ["accuracy", "precision", "recall", "f1"])


@query("rule_score")
def rule_score(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "value", mt.rule_score(F.col("value")).alias("score"))


def candidates(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem").select("l_partkey", "l_extendedprice", "l_quantity")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = li.join(part, li.l_partkey == part.p_partkey)
    return mt.unit_price_candidates(lines, "p_brand", safe_div("l_extendedprice", "l_quantity"))


@query("topn_candidates")
def topn_candidates(spark, sf_dir):
    return rounded(mt.top_n(candidates(spark, sf_dir), "rmse", 5), 6)


@query("best_candidate")
def best_candidate(spark, sf_dir):
    return rounded(mt.best(candidates(spark, sf_dir), "rmse"), 6)

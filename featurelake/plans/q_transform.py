"""Queries for row-level feature engineering."""

from __future__ import annotations

from featurelake.functions.columns import rounded
from featurelake.operators import transform as tr
from featurelake.plans.catalog import query
from featurelake.sources import fixtures as fx

RAW_NAMES = ["sepal length (cm)", "sepal width (cm)", "petal length (cm)", "petal width (cm)", "target"]


@query("engineer_features")
def engineer_features(spark, sf_dir):
    return rounded(tr.engineer_features(fx.flowers(spark, sf_dir)), cols=["log_sepal_length", "log_petal_length"])


@query("row_stats")
def row_stats(spark, sf_dir):
    return tr.row_stats(fx.flowers(spark, sf_dir))


@query("clean_columns")
def clean_columns(spark, sf_dir):
    raw = fx.flowers(spark, sf_dir).toDF(*RAW_NAMES)
    return tr.clean_columns(raw)


ALIGN_TO = ["petal_width", "sepal_length", "sepal_area", "petal_length_to_width_ratio", "unseen_feature"]


@query("align_schema")
def align_schema(spark, sf_dir):
    eng = tr.engineer_features(fx.flowers(spark, sf_dir))
    return tr.align_schema(eng, ALIGN_TO)

"""Queries for the long feature log and catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from featurelake.operators import store as st
from featurelake.operators import transform as tr
from featurelake.plans.catalog import query
from featurelake.sources import fixtures as fx
from featurelake.sources.tables import table

MELT_TS = "2024-01-31 00:00:00"
PIVOT_FEATURES = ["click", "error", "purchase", "signup", "view", "unknown_feature"]
AS_OF = "2024-01-15 00:00:00"


@query("feature_melt")
def feature_melt(spark, sf_dir):
    c = st.melt(table(spark, sf_dir, "customer"), key="c_custkey", prefix="customer_", event_ts=MELT_TS)
    s = st.melt(table(spark, sf_dir, "supplier"), key="s_suppkey", prefix="supplier_", event_ts=MELT_TS)
    return c.unionByName(s)


@query("feature_latest_pivot")
def feature_latest_pivot(spark, sf_dir):
    entities = table(spark, sf_dir, "customer").select("c_custkey")
    return st.latest_pivot(fx.feature_log(spark, sf_dir), PIVOT_FEATURES, entities=entities)


@query("feature_as_of_pivot")
def feature_as_of_pivot(spark, sf_dir):
    return st.latest_pivot(fx.feature_log(spark, sf_dir), PIVOT_FEATURES[:5], as_of=AS_OF)


@query("list_features")
def list_features(spark, sf_dir):
    return st.list_features(fx.feature_log(spark, sf_dir))


@query("feature_search")
def feature_search(spark, sf_dir):
    """Features whose name or description holds a text, any case."""
    log = fx.feature_log(spark, sf_dir)
    catalog = st.metadata_upsert(None, st.describe_stream_features(log, F.col("event_ts"), keep=("seq",)), tie_col="seq")
    return st.list_features(log, catalog, contains="PurCH")


@query("metadata_upsert")
def metadata_upsert(spark, sf_dir):
    log = fx.feature_log(spark, sf_dir)
    updates = st.describe_stream_features(log, F.col("event_ts"), keep=("seq",))
    return st.metadata_upsert(None, updates, tie_col="seq")


@query("feature_counts")
def feature_counts(spark, sf_dir):
    eng = tr.engineer_features(fx.flowers(spark, sf_dir, with_key=True))
    log = st.melt(eng, key="row_key", values=tr.numeric_columns(eng, exclude=("target",)), event_ts=MELT_TS)
    return st.feature_counts(log, fx.FLOWER_FEATURES)

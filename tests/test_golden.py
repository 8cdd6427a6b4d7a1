"""Hand-made edge cases (FIXTURES.md part C) and invariants."""

import datetime as dt
import os
import random
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from featurelake.operators import graph as gr
from featurelake.operators import metrics as mt
from featurelake.operators import quality as qa
from featurelake.operators import store as st
from featurelake.operators import transform as tr
from featurelake.operators import trips as tp
from featurelake.operators import views as vw
from tests import member_views as repo
from featurelake.streaming.envelopes import decode_updates, split_bad
from featurelake.streaming.store_sink import FeatureStoreSink

T0 = dt.datetime(2024, 1, 10, 12, 0, 0)
DAY = dt.timedelta(days=1)
US = dt.timedelta(microseconds=1)


def _stats(spark, rows):
    return spark.createDataFrame(rows, "member_id long, event_timestamp timestamp_ntz, created timestamp_ntz, "
                                       "purchase_share double, ok_share double, n_events long")


def _entities(spark, rows):
    return spark.createDataFrame(rows, "request_id long, member_id long, event_timestamp timestamp_ntz")


def _pit(spark, stats, ents, **kw):
    out = vw.point_in_time_join(ents, stats, repo.STATS, **kw)
    return {r["request_id"]: r for r in out.collect()}


# ---------------------------------------------------------------- point-in-time join

def test_pit_ttl_edges_ties_and_same_instant(spark):
    stats = _stats(spark, [
        (1, T0 - DAY, T0 - DAY, 0.1, 1.0, 1),            # exactly one TTL old: kept
        (2, T0 - DAY - US, T0 - DAY - US, 0.2, 1.0, 1),  # 1 us older than TTL: dropped
        (3, T0, T0, 0.3, 1.0, 1),                        # same instant as the entity: visible
        (4, T0, T0, 0.4, 1.0, 1),                        # tie on event time:
        (4, T0, T0 + US, 0.5, 1.0, 1),                   # later created wins
        (5, T0 + US, T0 + US, 0.6, 1.0, 1),              # future row: never visible
    ])
    ents = _entities(spark, [(i, i, T0) for i in range(1, 7)])
    got = _pit(spark, stats, ents)
    assert got[1]["purchase_share"] == 0.1
    assert got[2]["purchase_share"] is None
    assert got[3]["purchase_share"] == 0.3
    assert got[4]["purchase_share"] == 0.5
    assert got[5]["purchase_share"] is None
    assert got[6]["purchase_share"] is None  # unknown key
    assert len(got) == 6


def test_pit_bucket_split_matches_single_bucket(spark):
    rnd = random.Random(7)
    rows, ents = [], []
    for k in range(300):
        key = 1 if k < 200 else rnd.randint(2, 5)  # one hot key with two thirds of the rows
        t = T0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 5))
        rows.append((key, t, t, rnd.random(), rnd.random(), k))
    for k in range(200):
        t = T0 + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 6))
        ents.append((k, rnd.randint(1, 6), t))
    stats, e = _stats(spark, rows), _entities(spark, ents)
    a = _pit(spark, stats, e, buckets_per_ttl=1)
    b = _pit(spark, stats, e.repartition(5), buckets_per_ttl=4)
    c = _pit(spark, stats.repartition(3), e, buckets_per_ttl=8)
    d = _pit(spark, stats, e, buckets_per_ttl=2, hot_rows=10)  # hot keys split into finer buckets
    f = _pit(spark, stats, e, buckets_per_ttl=4, hot_rows=1)   # every key hot: very fine buckets
    assert a == b == c == d == f and len(a) == 200
    # brute force
    for rid, key, t in ents:
        cands = [r for r in rows if r[0] == key and t - DAY <= r[1] <= t]
        best = max(cands, key=lambda r: (r[1], r[2]))[3] if cands else None
        assert a[rid]["purchase_share"] == best


def test_batch_scoring_equals_pit_at_as_of(spark):
    stats = _stats(spark, [(1, T0 - dt.timedelta(hours=2), T0, 0.1, 1.0, 1), (1, T0 + DAY, T0, 0.9, 1.0, 1),
                           (2, T0 - 2 * DAY, T0, 0.2, 1.0, 1)])
    ents = _entities(spark, [(1, 1, T0 - DAY), (2, 2, T0)])
    got = {r["request_id"]: r for r in vw.batch_scoring_features(ents, stats, repo.STATS, T0).collect()}
    assert got[1]["purchase_share"] == 0.1 and got[1]["event_timestamp"] == T0
    assert got[2]["purchase_share"] is None


def test_batch_scoring_query_serves_what_is_a_day_old(spark):
    at = dt.datetime(2024, 1, 30, 12)
    events = [(1, 7, at - dt.timedelta(hours=20, minutes=30), "purchase", 1.0), (2, 8, at - dt.timedelta(hours=30), "purchase", 2.0),
              (3, 9, at - dt.timedelta(hours=2), "purchase", 3.0), (4, 9, at - dt.timedelta(hours=20), "error", 4.0)]
    root = tempfile.mkdtemp(prefix="fl-scoring-")
    spark.createDataFrame(events, "event_id long, user_id long, ts timestamp_ntz, event_type string, value double").write.parquet(f"{root}/events.parquet")
    got = {r["request_id"]: (r["purchase_share"], r["n_events"]) for r in se.queries()["batch_scoring_features"](spark, root).collect()}
    assert got == {1: (1.0, 1), 2: (None, None), 3: (1.0, 1)}


def test_feature_name_clash_is_rejected(spark):
    ents = _entities(spark, [(1, 1, T0)])
    with pytest.raises(ValueError):
        vw.historical_features(ents, {repo.STATS.name: _stats(spark, [])},
                               (repo.STATS.select("purchase_share"), repo.STATS_FRESH.select("purchase_share")))


# ---------------------------------------------------------------- long store

def _log(spark, rows):
    return spark.createDataFrame(rows, "entity_id string, feature_name string, feature_value double, "
                                       "event_ts timestamp_ntz, ingest_ts timestamp_ntz, seq long")


def test_latest_pivot_null_newest_null_only_unknown(spark):
    log = _log(spark, [("a", "f", 1.0, T0, T0, 1), ("a", "f", None, T0 + US, T0 + US, 2),
                       ("b", "f", None, T0, T0, 3), ("c", "f", 2.0, T0, T0, 4), ("c", "f", 3.0, T0, T0, 5)])
    got = {r["entity_id"]: r for r in st.latest_pivot(log, ["f", "missing"]).collect()}
    assert got["a"]["f"] == 1.0 and got["a"]["missing"] is None
    assert "b" not in got  # all-NULL entity dropped by default
    assert got["c"]["f"] == 3.0  # tie on time broken by seq
    ents = spark.createDataFrame([("a",), ("b",), ("z",)], "id string")
    kept = {r["entity_id"]: r for r in st.latest_pivot(log, ["f"], entities=ents, keep_missing=True).collect()}
    assert set(kept) == {"a", "b", "z"} and kept["b"]["f"] is None


def test_melt_skips_non_numeric_and_keeps_business_key(spark):
    df = spark.createDataFrame([(10, 1.5, "x")], "k long, v double, s string")
    rows = st.melt(df, key="k", prefix="sample_", event_ts=T0).collect()
    assert [(r["entity_id"], r["feature_name"], r["feature_value"]) for r in rows] == [("sample_10", "v", 1.5)]


# ---------------------------------------------------------------- quality

def test_zero_divisor_and_log_domain(spark):
    df = spark.createDataFrame([(1.0, 0.0, -1.0, 0.0, 0)], "sepal_length double, sepal_width double, "
                               "petal_length double, petal_width double, target int")
    r = tr.engineer_features(df).first()
    assert r["sepal_length_to_width_ratio"] is None and r["petal_length_to_width_ratio"] is None
    assert r["log_petal_length"] is None


def test_drift_zero_reference_and_exact_threshold(spark):
    df = spark.createDataFrame([("reference", 0.0, 100.0), ("current", 5.0, 110.0)], "period string, a double, b double")
    got = {r["column_name"]: r for r in qa.mean_drift(df, "period").collect()}
    assert got["a"]["drift_percentage"] == 0.0 and not got["a"]["drift_detected"]
    assert abs(got["b"]["drift_percentage"] - 10.0) < 1e-9 and not got["b"]["drift_detected"]


def test_exact_quantiles_match_numpy_over_several_rounds(spark):
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=3000), np.full(1500, 0.25), rng.integers(0, 5, 500).astype(float)])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = qa.exact_quantiles(df, ["x"], [0.1, 0.25, 0.5, 0.75, 0.9], window=100, splits=8)["x"]
    for p, v in got.items():
        assert v == pytest.approx(float(np.quantile(x, p)), abs=1e-12)


# ---------------------------------------------------------------- graph

def test_constant_column_gives_no_edge(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 6.3, 5.0)], "a double, b double, c double")
    corr = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in gr.correlation_matrix(df).collect()}
    assert corr[("a", "c")] is None and corr[("a", "b")] > 0.99
    edges = gr.correlation_edges(gr.correlation_matrix(df), 0.5).collect()
    assert [(e["src"], e["dst"]) for e in edges] == [("a", "b")]


def test_empty_graph(spark):
    e = spark.createDataFrame([], "src long, dst long")
    r = gr.summary(e).first()
    assert r["node_count"] == 0 and r["density"] is None


def test_clustering_and_components_brute_force(spark):
    edges = [(1, 2), (2, 3), (1, 3), (3, 4), (5, 6), (6, 7), (4, 8), (2, 4)]
    e = spark.createDataFrame(edges, "src long, dst long")
    adj = {}
    for a, b in edges:
        adj.setdefault(a, set()).add(b)
        adj.setdefault(b, set()).add(a)
    local = []
    for v, ns in adj.items():
        d = len(ns)
        t = sum(1 for x in ns for y in ns if x < y and y in adj[x])
        local.append(0.0 if d < 2 else 2 * t / (d * (d - 1)))
    r = gr.average_clustering(e).first()
    assert r["average_clustering"] == pytest.approx(sum(local) / len(local))
    comps = {row["component"]: row["size"] for row in gr.component_sizes(e).collect()}
    assert comps == {1: 5, 5: 3}


# ---------------------------------------------------------------- trips, metrics

def test_unseen_category_encodes_to_zeros(spark):
    train = spark.createDataFrame([("1_2", 1.0), ("3_4", 2.0)], "PU_DO string, trip_distance double")
    test = spark.createDataFrame([("9_9", 5.0), ("3_4", 1.0)], "PU_DO string, trip_distance double")
    enc = tp.fit_one_hot(train, ["PU_DO"], ["trip_distance"]).transform(test)
    got = {r["PU_DO"]: r for r in enc.select("PU_DO", tp.active_category(enc, "PU_DO").alias("i"), "features").collect()}
    assert got["9_9"]["i"] is None and got["3_4"]["i"] == 1
    assert got["9_9"]["features"].toArray().tolist() == [0.0, 0.0, 5.0]


def test_class_never_predicted_has_zero_precision(spark):
    df = spark.createDataFrame([(0, 0), (1, 0), (2, 2), (2, 2)], "actual int, predicted int")
    r = mt.class_metrics(df).first()
    # class 1 never predicted: precision 0; weighted precision = (1*0.5 + 1*0 + 2*1) / 4
    assert r["precision"] == pytest.approx(0.625)
    assert r["accuracy"] == pytest.approx(0.75)


def test_gate_messages(spark):
    df = spark.createDataFrame([(0.95, 0.91), (0.95, 0.5)], "accuracy double, f1 double")
    rows = mt.gate(df).collect()
    assert rows[0]["status"] == "SUCCESS" and rows[0]["message"].endswith("Accuracy: 0.9500, F1: 0.9100")
    assert rows[1]["status"] == "WARNING"


# ---------------------------------------------------------------- streaming sink

def _msg(entity, value, ts):
    return ('{"entity_id": "%s", "feature_data": {"t": %s}, "timestamp": "%s", "event_type": "feature_update"}'
            % (entity, value, ts.isoformat()))


def test_bad_json_goes_to_dead_letter(spark):
    df = spark.createDataFrame([("{bad",), (_msg("a", 1.0, T0),)], "value string")
    good, bad = split_bad(decode_updates(df))
    assert good.count() == 1 and [r["reason"] for r in bad.collect()] == ["unparseable"]


def test_sink_replay_is_idempotent_and_late_rows_do_not_win(spark):
    root = tempfile.mkdtemp(prefix="fl-sink-")
    sink = FeatureStoreSink(os.path.join(root, "store"), compact_every=2)
    b0 = spark.createDataFrame([(_msg("a", 2.0, T0),)], "value string")
    b1 = spark.createDataFrame([(_msg("a", 1.0, T0 - DAY),)], "value string")  # late, older event time
    sink(b0, 0)
    sink(b1, 1)
    sink(b1, 1)  # replayed batch
    latest = sink.latest(spark).collect()
    assert [(r["entity_id"], r["feature_value"]) for r in latest] == [("a", 2.0)]
    assert sink.log(spark).count() == 2  # both logged once, replay changed nothing
    cat = sink.catalog(spark).collect()
    assert [(r["feature_name"], r["description"]) for r in cat] == [("t", "Real-time updated feature: t")]


# ---------------------------------------------------------------- declarative API pieces

def test_request_source_and_schema_metadata(spark):
    from pyspark.sql import types as T
    rs = vw.RequestSource("call", T.StructType([T.StructField("bonus", T.LongType()),
                                                       T.StructField("extra", T.LongType())]))
    df = spark.createDataFrame([(1, 2.0, 3.0)], "member_id long, bonus double, extra double")
    assert rs.check(df).schema["bonus"].dataType == T.LongType()
    with pytest.raises(ValueError):
        rs.check(df.drop("bonus"))
    sch = repo.STATS.schema({"n_events": T.LongType()})
    assert sch["n_events"].metadata["description"] == "Events of the hour"
    assert sch["purchase_share"].metadata["tags"] == {"team": "growth"}


def test_pandas_on_demand_matches_column_version(spark):
    from pyspark.sql import types as T
    df = spark.createDataFrame([(1, 0.5, 1, 10), (2, None, 2, 20)],
                               "member_id long, purchase_share double, bonus long, extra long")

    def plus(pdf):
        import pandas as pd
        out = pd.DataFrame()
        out["share_with_bonus"] = pdf["purchase_share"] * 100 + pdf["bonus"]
        out["share_with_extra"] = pdf["purchase_share"] * 100 - pdf["extra"]
        return out

    outs = T.StructType([T.StructField("share_with_bonus", T.DoubleType()),
                         T.StructField("share_with_extra", T.DoubleType())])
    a = {r["member_id"]: r for r in vw.apply_on_demand_pandas(df, plus, outs).collect()}
    b = {r["member_id"]: r for r in vw.apply_on_demand(df, repo.TRANSFORMED).collect()}
    assert a[1]["share_with_bonus"] == b[1]["share_with_bonus"] == 51.0
    assert b[2]["share_with_extra"] is None


def test_schema_check_detects_drift(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "a double, b double")
    assert tr.check_schema(df, df.schema.json()) is df
    with pytest.raises(ValueError):
        tr.check_schema(df.drop("b"), df.schema)
    assert tr.schema_diff(df.withColumn("b", F.col("b").cast("int")), df.schema) == ["type of b: int != double"]


def test_pit_without_ttl_looks_back_without_limit(spark):
    from dataclasses import replace
    view = replace(repo.STATS, ttl=None)
    stats = _stats(spark, [(1, T0 - 30 * DAY, T0, 0.1, 1.0, 1), (2, T0 + US, T0, 0.2, 1.0, 1),
                           (3, T0 - 2 * DAY, T0, 0.3, 1.0, 1), (3, T0 - DAY, T0, 0.4, 1.0, 1)])
    ents = _entities(spark, [(1, 1, T0), (2, 2, T0), (3, 3, T0 + 5 * DAY)])
    for kw in ({}, {"bucket_width": dt.timedelta(hours=1)}, {"hot_rows": 1}):
        got = {r["request_id"]: r for r in vw.point_in_time_join(ents, stats, view, **kw).collect()}
        assert got[1]["purchase_share"] == 0.1 and got[2]["purchase_share"] is None and got[3]["purchase_share"] == 0.4


def test_full_names_allow_views_with_shared_fields(spark):
    stats = _stats(spark, [(1, T0 - dt.timedelta(hours=1), T0, 0.5, 1.0, 1)])
    ents = spark.createDataFrame([(1, 1, T0, 2, 20)], "request_id long, member_id long, event_timestamp timestamp_ntz, "
                                                      "bonus long, extra long")
    items = (repo.STATS.select("purchase_share"), repo.STATS_FRESH.select("purchase_share"), repo.TRANSFORMED)
    out = vw.historical_features(ents, {repo.STATS.name: stats, repo.STATS_FRESH.name: stats}, items, full_names=True)
    r = out.first()
    assert r["user_activity__purchase_share"] == 0.5 and r["user_activity_pushed__purchase_share"] == 0.5
    assert r["share_with_bonus"] == 52.0 and "purchase_share" not in out.columns

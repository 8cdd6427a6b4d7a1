"""The user-level workflow end to end: store, views (historical, materialise, online, push), quality, network."""

import dataclasses
import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from featurelake.api import FeatureRepo, FeatureStore, NetworkAnalyzer, QualityValidator
from featurelake.operators import transform as tr
from tests import member_views as repo
from featurelake.sources import fixtures as fx
from tests.conftest import SF_SMALL

T0 = dt.datetime(2024, 1, 10)


def test_store_round_trip(spark):
    root = tempfile.mkdtemp(prefix="fl-api-")
    fs = FeatureStore(spark, root)
    df = spark.createDataFrame([("test_entity_1", 5.1, 3.5), ("test_entity_2", 6.2, 2.9)],
                               "id string, sepal_length double, sepal_width double")
    fs.store_features(df, key="id", descriptions={"sepal_length": "first"}, event_ts=T0)
    fs.store_features(df.withColumn("sepal_length", F.col("sepal_length") + 1), key="id",
                      descriptions={"sepal_length": "second"}, event_ts=T0 + dt.timedelta(hours=1))
    got = {r["entity_id"]: r for r in fs.get_features(["sepal_length", "sepal_width"]).collect()}
    assert len(got) == 2 and got["test_entity_1"]["sepal_length"] == 6.1
    old = {r["entity_id"]: r for r in fs.get_features(["sepal_length"], as_of=T0).collect()}
    assert old["test_entity_1"]["sepal_length"] == 5.1
    meta = fs.get_feature_metadata().collect()
    assert [(m["feature_name"], m["description"]) for m in meta] == [("sepal_length", "second")]
    assert sorted(r["feature_name"] for r in fs.list_features().collect()) == ["sepal_length", "sepal_width"]


def test_feature_repo_workflow(spark):
    root = tempfile.mkdtemp(prefix="fl-repo-")
    stats = fx.user_activity(spark, SF_SMALL)
    r = FeatureRepo(spark, root, repo.VIEWS, {repo.STATS.name: stats, repo.STATS_FRESH.name: stats})
    ents = fx.training_entities(spark, SF_SMALL)
    train = r.get_historical_features(ents, ["user_activity:purchase_share", "user_activity_pushed:n_events"])
    assert train.count() == ents.count()
    r.materialize_incremental("2024-01-15")
    r.materialize_incremental("2024-02-01")
    rows = spark.createDataFrame([(1, 1000, 2000), (2, 1001, 2002), (999999, 1, 2)],
                                 "member_id long, bonus long, extra long")
    online = {x["member_id"]: x for x in r.get_online_features(rows, ["user_activity:ok_share", "boosted_share:share_with_bonus"]).collect()}
    assert online[999999]["ok_share"] is None and online[1]["ok_share"] is not None
    pushed = spark.createDataFrame([(1, dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 1), 1.0, 1.0, 1000)],
                                   stats.schema)
    r.push(repo.STATS_FRESH.name, pushed)
    after = {x["member_id"]: x for x in r.get_online_features(rows, repo.PUSHED).collect()}
    assert after[1]["purchase_share"] == 1.0 and after[1]["n_events"] == 1000


def test_state_survives_a_restart(spark):
    root = tempfile.mkdtemp(prefix="fl-repo-")
    stats = fx.user_activity(spark, SF_SMALL)

    def repo_again():
        return FeatureRepo(spark, root, repo.VIEWS, {repo.STATS.name: stats, repo.STATS_FRESH.name: stats})

    r = repo_again()
    r.materialize_incremental("2024-01-15")
    pushed = spark.createDataFrame([(1, dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 1), 1.0, 1.0, 1000)], stats.schema)
    r.push(repo.STATS_FRESH.name, pushed)
    r.push(repo.STATS_FRESH.name, pushed)
    r = repo_again()
    assert r.mark(repo.STATS.name) == dt.datetime(2024, 1, 15)
    assert r.sources[repo.STATS_FRESH.name].count() == stats.count() + 2
    assert r.sources[repo.STATS.name].count() == stats.count()
    r.materialize_incremental("2024-03-01")
    assert r.mark(repo.STATS.name) == dt.datetime(2024, 3, 1)


def test_requests_are_checked_and_served_rows_logged(spark):
    root = tempfile.mkdtemp(prefix="fl-repo-")
    stats = fx.user_activity(spark, SF_SMALL)
    r = FeatureRepo(spark, root, repo.VIEWS, {repo.STATS.name: stats, repo.STATS_FRESH.name: stats})
    r.materialize_incremental("2024-02-01")
    rows = spark.createDataFrame([(1, 1000, 2000)], "member_id long, bonus long, extra long")
    with pytest.raises(ValueError, match="misses request columns"):
        r.get_online_features(rows.drop("extra"), repo.SERVED)
    with pytest.raises(ValueError, match="clash"):
        r.get_online_features(rows, (repo.STATS.select("ok_share"), repo.STATS_FRESH.select("ok_share")))
    service = dataclasses.replace(repo.SERVED, log_path=os.path.join(root, "served"))
    assert r.get_online_features(rows, service).count() == 1
    assert spark.read.parquet(service.log_path).select("feature_service").first()[0] == service.name


def test_quality_and_network(spark):
    d = tempfile.mkdtemp(prefix="fl-q-")
    v = QualityValidator(spark, report_path=os.path.join(d, "reports"))
    df = fx.flowers(spark, SF_SMALL)
    rep = v.validate_dataset(df, "flowers", exact=False)
    assert rep["profile"].filter("stat = 'row_count'").first()["value"] == df.count()
    assert {r["part"] for r in spark.read.option("basePath", os.path.join(d, "reports")).option("mergeSchema", True).parquet(
        os.path.join(d, "reports", "*", "*")).select("part").distinct().collect()} == {"profile", "schema", "summary"}
    drift = v.check_data_drift(df.filter("target = 0"), df.filter("target = 1"))
    assert drift.count() == 5
    net = NetworkAnalyzer()
    edges = net.build_feature_correlation_network(tr.engineer_features(df), 0.3)
    m = net.get_network_metrics(edges)
    assert m["summary"].first()["edge_count"] == edges.count()

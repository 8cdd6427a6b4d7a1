"""Queries for feature views: point-in-time training sets, scoring, online reads, pushes."""

from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

from pyspark.sql import functions as F

from featurelake.api import FeatureRepo
from featurelake.operators import views as vw
from featurelake.operators.online import OnlineTable
from featurelake.plans import activity_repo as repo
from featurelake.plans.catalog import query
from featurelake.session import scratch_dir
from featurelake.sources import fixtures as fx
from featurelake.sources.tables import table

SCORING_AS_OF = "2024-01-30 12:00:00"
SCORING_TTL = timedelta(days=1)
CUT_1, CUT_2 = "2024-01-15 00:00:00", "2024-01-25 00:00:00"
ONLINE_END = "2024-01-31 00:00:00"


#: Kinds of events in the signals' history, and the kind that is pushed.
HISTORY, PUSHED = ("click", "error"), ("signup",)


def _sources(spark, sf_dir):
    return {repo.PACE.name: fx.user_activity(spark, sf_dir), repo.SPEND.name: fx.daily_spend(spark, sf_dir),
            repo.SIGNALS.name: fx.member_signals(spark, sf_dir, HISTORY)}


def _historical(spark, sf_dir, items):
    return vw.historical_features(fx.training_entities(spark, sf_dir), _sources(spark, sf_dir), items)


@query("pit_training_set")
def pit_training_set(spark, sf_dir):
    return _historical(spark, sf_dir, vw.parse_refs(["pace:purchase_share", "pace:ok_share", "pace:n_events"], repo.VIEWS))


@query("on_demand")
def on_demand(spark, sf_dir):
    """A view, an on-demand view that reads it, and the typed request values."""
    return _historical(spark, sf_dir, vw.parse_refs(["spend:n_purchases", "outlook:expected_value", "spend:best_value"], repo.VIEWS))


@query("pit_many_views")
def pit_many_views(spark, sf_dir):
    """Three views of one key, with a TTL of hours, of days and none, in one pass."""
    return _historical(spark, sf_dir, (repo.PACE, repo.SPEND, repo.SIGNALS))


@query("feature_service_v1")
def feature_service_v1(spark, sf_dir):
    return _historical(spark, sf_dir, repo.SERVICES["ranking"].items)


@query("batch_scoring_features")
def batch_scoring_features(spark, sf_dir):
    """Scoring takes what is up to a day old."""
    return vw.batch_scoring_features(fx.training_entities(spark, sf_dir), fx.user_activity(spark, sf_dir),
                                     replace(repo.PACE, ttl=SCORING_TTL), SCORING_AS_OF)


@query("materialize_incremental")
def materialize_incremental(spark, sf_dir):
    src = fx.user_activity(spark, sf_dir)
    online = vw.materialize_incremental(None, src, repo.PACE, None, CUT_1)
    return vw.materialize_incremental(online, src, repo.PACE, CUT_1, CUT_2)


def _request_rows(spark, sf_dir):
    """Request rows for every customer key; keys without activity stay unknown."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("member_id"), F.col("c_nationkey").alias("horizon_days"),
                    (F.col("c_nationkey") * 10).cast("string").alias("target_events"))


def _online(spark, sf_dir, view):
    return vw.materialize_incremental(None, _sources(spark, sf_dir)[view.name], view, None, ONLINE_END)


@query("online_lookup")
def online_lookup(spark, sf_dir):
    """Request values arrive as text and whole numbers; the declared request source casts them."""
    refs = vw.parse_refs(["pace:ok_share", "gap:events_missing", "gap:pace_ratio"], repo.VIEWS)
    return vw.online_features(_request_rows(spark, sf_dir), {repo.PACE.name: _online(spark, sf_dir, repo.PACE)}, refs)


@query("online_point_reads")
def online_point_reads(spark, sf_dir):
    """J3 from a bucketed, written table: materialised in two steps, then read by a new instance; the same rows as ``online_lookup``."""
    root, history = scratch_dir(spark, "online"), _sources(spark, sf_dir)[repo.PACE.name]
    for start, end in ((None, CUT_1), (CUT_1, ONLINE_END)):
        OnlineTable(spark, root, repo.PACE, buckets=16).upsert(vw.latest_per_key(history, repo.PACE, start=start, end=end))
    requests = _request_rows(spark, sf_dir)
    refs = vw.parse_refs(["pace:ok_share", "gap:events_missing", "gap:pace_ratio"], repo.VIEWS)
    return vw.online_features(requests, {repo.PACE.name: OnlineTable(spark, root, repo.PACE).for_requests(requests)}, refs)


@query("push_upsert")
def push_upsert(spark, sf_dir):
    history, pushed = (fx.member_signals(spark, sf_dir, kinds) for kinds in (HISTORY, PUSHED))
    _, online = vw.push(history, _online(spark, sf_dir, repo.SIGNALS), pushed, repo.SIGNALS)
    return online


@query("push_offline")
def push_offline(spark, sf_dir):
    """The offline half of a push, read back from the repository's own storage by a new instance."""
    history, root = fx.member_signals(spark, sf_dir, HISTORY), scratch_dir(spark, "repo")
    pushed = fx.member_signals(spark, sf_dir, PUSHED)
    FeatureRepo(spark, root, repo.VIEWS, {repo.SIGNALS.name: history}).push(repo.SIGNALS.name, pushed, to_online=False)
    return FeatureRepo(spark, root, repo.VIEWS, {repo.SIGNALS.name: history}).sources[repo.SIGNALS.name]


@query("materialize_restart")
def materialize_restart(spark, sf_dir):
    """T8 across two instances: the second goes on from the stored mark."""
    sources, root = {repo.PACE.name: fx.user_activity(spark, sf_dir)}, scratch_dir(spark, "repo")
    FeatureRepo(spark, root, repo.VIEWS, sources).materialize_incremental(CUT_1)
    again = FeatureRepo(spark, root, repo.VIEWS, sources)
    again.materialize_incremental(CUT_2)
    return again.online_table(repo.PACE.name)


@query("feature_service_v2")
def feature_service_v2(spark, sf_dir):
    return _historical(spark, sf_dir, repo.SERVICES["account_review"].items)


@query("online_service_v3")
def online_service_v3(spark, sf_dir):
    """Push signals, then serve the pushed view and another one online through one service."""
    online = {repo.SIGNALS.name: push_upsert(spark, sf_dir), repo.PACE.name: _online(spark, sf_dir, repo.PACE)}
    return vw.online_features(_request_rows(spark, sf_dir), online, repo.SERVICES["live_call"].items)

"""Example declarations over ``events``: what a member did in the last hour, spent in a day, and last signalled.

The frames come from ``featurelake.sources.fixtures`` (``user_activity``, ``daily_spend``, ``member_signals``).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import types as T

from featurelake.operators.views import Entity, FeatureService, FeatureView, OnDemandView, RequestSource

MEMBER = Entity("member", ("member_id",))

#: Hourly shares, stale after half a day.
PACE = FeatureView("pace", MEMBER, ("purchase_share", "ok_share", "n_events"), ttl=timedelta(hours=12),
                   descriptions={"n_events": "events in the hour", "ok_share": "share of events without an error"})

#: Daily purchases, good for a week; made by another team under other names.
SPEND = FeatureView("spend", MEMBER, ("best_value", "n_purchases"), ttl=timedelta(days=7),
                    tags={"owner": "billing", "grain": "day"})

#: Single signals as they are pushed; the last one holds until the next.
SIGNALS = FeatureView("signals", MEMBER, ("kind", "strength"), ttl=None, tags={"owner": "growth"})

CALL = RequestSource("call", T.StructType([T.StructField("horizon_days", T.DoubleType()), T.StructField("target_events", T.LongType())]))


def _outlook(c):
    return {"expected_value": c("best_value") * c("n_purchases") * c("horizon_days")}


def _gap(c):
    return {"events_missing": c("target_events") - c("n_events"), "pace_ratio": c("n_events") / (c("target_events") + 1)}


OUTLOOK = OnDemandView("outlook", (SPEND, CALL), ("expected_value",), _outlook)
GAP = OnDemandView("gap", (PACE, CALL), ("events_missing", "pace_ratio"), _gap)

SERVICES = {s.name: s for s in (
    FeatureService("ranking", (PACE.select("n_events"), GAP)),
    FeatureService("account_review", (SPEND, PACE.select("ok_share", "purchase_share"), OUTLOOK, GAP.select("events_missing"))),
    FeatureService("live_call", (SIGNALS.select("kind"), PACE.select("ok_share"), GAP.select("pace_ratio"))),
)}
VIEWS = {v.name: v for v in (PACE, SPEND, SIGNALS, OUTLOOK, GAP)}

"""Views that the tests of retrieval share: an hourly view, the same fields pushed, and a transform of plain request columns."""

from dataclasses import replace
from datetime import timedelta

from featurelake.operators.views import FeatureService, OnDemandView
from featurelake.plans.activity_repo import PACE

STATS = replace(PACE, name="user_activity", ttl=timedelta(days=1), tags={"team": "growth"}, descriptions={"n_events": "Events of the hour"})
STATS_FRESH = replace(STATS, name="user_activity_pushed")
TRANSFORMED = OnDemandView("boosted_share", (STATS, "bonus", "extra"), ("share_with_bonus", "share_with_extra"),
                           lambda c: {"share_with_bonus": c("purchase_share") * 100 + c("bonus"),
                                      "share_with_extra": c("purchase_share") * 100 - c("extra")})
SERVED = FeatureService("served", (STATS.select("purchase_share"), TRANSFORMED))
PUSHED = FeatureService("pushed", (STATS_FRESH,))
VIEWS = {v.name: v for v in (STATS, STATS_FRESH, TRANSFORMED)}

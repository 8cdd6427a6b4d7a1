"""Retrieval of several views in one pass, and the prefix scan below it: brute force, hot keys, plans."""

import dataclasses
import datetime as dt
import re

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelake.operators import views as vw
from tests.member_views import STATS, TRANSFORMED

T0 = dt.datetime(2024, 1, 10)
HOUR = dt.timedelta(hours=1)
FIELDS = "member_id long, event_timestamp timestamp_ntz, created timestamp_ntz, "
SLOW = vw.FeatureView("slow", STATS.entity, ("level",), ttl=dt.timedelta(days=20))
EVER = vw.FeatureView("ever", STATS.entity, ("kind", "n_events"), ttl=None, created_field=None)


@pytest.mark.parametrize("fan_out,levels", [(2, 1), (2, 2), (3, 3), (2, 6), (512, 2)])
def test_carried_in_equals_a_plain_scan(spark, fan_out, levels):
    rng = np.random.default_rng(levels)
    rows, want = [], set()
    for key in (1, 2, None):
        a = b = None
        for pos in sorted(rng.choice(np.arange(-60, 60), 40, replace=False).tolist()):
            asked, x, y = bool(rng.random() < 0.4), *((int(rng.integers(100)) if rng.random() < 0.3 else None) for _ in range(2))
            rows.append((key, pos, asked, x, y))
            if asked and (a is not None or b is not None):
                want.add((key, pos, a, b))
            a, b = x if x is not None else a, y if y is not None else b
    df = spark.createDataFrame(rows, "k int, __pos long, __asked boolean, a int, b int")
    got = vw.carried_in(df, ["k"], ["a", "b"], fan_out, levels).select("k", "__pos", "a", "b").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_a_key_in_200000_buckets_is_in_no_task(spark):
    """One key, one feature row and one entity row in each of 200,000 buckets: the scan's largest task holds under 5 % of the rows."""
    n = 200_000
    rows = spark.range(n).select(F.lit(1).alias("k"), F.col("id").alias("__pos"), F.lit(True).alias("__asked"), F.col("id").alias("a"))
    old = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = vw.carried_in(rows, ["k"], ["a"])
        tasks = [r["count"] for r in got.groupBy(F.spark_partition_id()).count().collect()]
        wrong = got.filter(F.col("a") != F.col("__pos") - 1).count()
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert sum(tasks) == n - 1 and max(tasks) < 0.05 * n and wrong == 0


def _frames(spark):
    rng = np.random.default_rng(7)
    at = lambda: T0 + dt.timedelta(minutes=int(rng.integers(0, 60 * 24 * 40)))
    key = lambda: None if rng.random() < 0.05 else int(rng.choice([1, 1, 1, 2, 3]))
    quick = [(key(), None if rng.random() < 0.03 else at(), at(), float(i), float(-i), i) for i in range(400)]
    slow = [(key(), at(), at(), float(i)) for i in range(60)]
    ever = [(key(), at(), f"k{i}", i) for i in range(30)]
    ever = list({(k, t): (k, t, *rest) for k, t, *rest in ever}.values())  # without a created time a tie has no order
    ents = [(i, key(), None if rng.random() < 0.03 else at(), 2, 20) for i in range(300)]
    return ({"user_activity": (spark.createDataFrame(quick, FIELDS + "purchase_share double, ok_share double, n_events long"), quick),
             "slow": (spark.createDataFrame(slow, FIELDS + "level double"), slow),
             "ever": (spark.createDataFrame(ever, "member_id long, event_timestamp timestamp_ntz, kind string, n_events long"), ever)},
            spark.createDataFrame(ents, "request_id long, member_id long, event_timestamp timestamp_ntz, bonus long, extra long"), ents)


def _by_hand(view, rows, entity):
    """The view's fields for one entity row."""
    skip = 3 if view.created_field else 2
    _, key, t, *_ = entity
    able = [r for r in rows if key is not None and r[0] == key and t is not None and r[1] is not None and r[1] <= t
            and (view.ttl is None or r[1] >= t - view.ttl)]
    best = max(able, key=lambda r: r[1:skip], default=None)
    return tuple(best[skip:]) if best else (None,) * len(view.features)


@pytest.mark.parametrize("kw", [{}, {"hot_rows": 1}, {"hot_rows": 25, "buckets_per_ttl": 1}, {"hot_rows": None}])
def test_three_views_in_one_pass_equal_plain_lookups(spark, kw):
    frames, ents, rows = _frames(spark)
    views = [STATS, SLOW, EVER]
    got = vw.point_in_time_views(ents, {n: f for n, (f, _) in frames.items()}, [(v, v.features) for v in views], full_names=True, **kw).collect()
    assert len(got) == len(rows)
    found = {r["request_id"]: r for r in got}
    for e in rows:
        for v in views:
            assert tuple(found[e[0]][f"{v.name}__{f}"] for f in v.features) == _by_hand(v, frames[v.name][1], e)


def test_two_views_cost_no_more_exchanges_of_the_entity_frame_than_one(spark):
    frames, ents, _ = _frames(spark)
    sources = {n: f for n, (f, _) in frames.items()}

    def exchanges(*views):
        df = vw.historical_features(ents, sources, views, full_names=True)
        return len(re.findall(r"\bExchange\b", df._jdf.queryExecution().executedPlan().toString()))

    assert exchanges(STATS, SLOW, EVER) == exchanges(STATS, SLOW) == exchanges(STATS)


def test_views_of_different_keys_take_a_pass_each(spark):
    frames, ents, rows = _frames(spark)
    other = vw.FeatureView("other", vw.Entity("request", ("request_id",)), ("score",), ttl=None, created_field=None)
    scores = spark.createDataFrame([(i, T0 - HOUR, i / 2) for i in range(0, 300, 2)], "request_id long, event_timestamp timestamp_ntz, score double")
    got = vw.historical_features(ents, {"slow": frames["slow"][0], "other": scores}, (SLOW, other)).collect()
    for r in got:
        e = rows[r["request_id"]]
        assert r["score"] == (e[0] / 2 if e[0] % 2 == 0 and e[2] is not None else None)
        assert (r["level"],) == _by_hand(SLOW, frames["slow"][1], e)
    with pytest.raises(ValueError, match="different keys"):
        vw.point_in_time_views(ents, {}, [(SLOW, SLOW.features), (other, other.features)])


def test_online_views_with_shared_fields_need_full_names(spark):
    online = {v: spark.createDataFrame([(1, x, n)], "member_id long, purchase_share double, n_events long") for v, x, n in (("user_activity", 0.5, 3), ("twin", 0.7, 4))}
    twin = dataclasses.replace(STATS, name="twin")
    items = (STATS.select("purchase_share", "n_events"), twin.select("n_events"), TRANSFORMED.select("share_with_bonus"))
    rows = spark.createDataFrame([(1, 2, 20), (9, 2, 20)], "member_id long, bonus long, extra long")
    online = {n: f.withColumn("ok_share", F.lit(1.0)) for n, f in online.items()}
    with pytest.raises(ValueError, match="clash"):
        vw.online_features(rows, online, items)
    out = vw.online_features(rows, online, items, full_names=True)
    assert out.columns == ["member_id", "bonus", "extra", "share_with_bonus", "twin__n_events", "user_activity__n_events", "user_activity__purchase_share"]
    got = {r["member_id"]: r for r in out.collect()}
    assert got[1]["share_with_bonus"] == 52.0 and got[1]["twin__n_events"] == 4 and got[9]["twin__n_events"] is None


def test_request_sources_cast_and_check_both_ways(spark):
    ask = vw.RequestSource("ask", T.StructType([T.StructField("days", T.DoubleType())]))
    double = vw.OnDemandView("double", (SLOW, ask), ("both",), lambda c: {"both": c("level") * c("days")})
    source = spark.createDataFrame([(1, T0, T0, 4.0)], FIELDS + "level double")
    ents = spark.createDataFrame([(1, T0 + HOUR, "2.5")], "member_id long, event_timestamp timestamp_ntz, days string")
    out = vw.historical_features(ents, {"slow": source}, (double,))
    assert out.schema["days"].dataType == T.DoubleType() and out.first()["both"] == 10.0
    assert vw.online_features(ents, {"slow": source}, (double,)).first()["both"] == 10.0
    for call in (lambda: vw.historical_features(ents.drop("days"), {"slow": source}, (double,)),
                 lambda: vw.online_features(ents.drop("days"), {"slow": source}, (double,))):
        with pytest.raises(ValueError, match="misses columns"):
            call()

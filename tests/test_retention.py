"""Report retention: whole hours go, the running hour is filtered, nothing else is touched."""

import datetime as dt

from pyspark.sql import functions as F

from featurelake.operators import quality as qa
from featurelake.operators.retention import ReportStore
from featurelake.session import scratch_dir

T0 = dt.datetime(2024, 1, 1, 10, 30)


def _report(spark, name, at, ttl=3600):
    return qa.report_rows(spark.createDataFrame([(name,)], "name string"), at, ttl)


def test_hours_go_as_folders(spark):
    store = ReportStore(spark, scratch_dir(spark, "reports"))
    assert store.live(T0) is None and store.expire(T0) == []
    for name, minutes in (("a", 0), ("b", 20), ("c", 45), ("d", 120)):
        store.keep(_report(spark, name, T0 + dt.timedelta(minutes=minutes)))
    store.keep(_report(spark, "ever", T0).withColumn("expires_at", F.lit(None).cast("timestamp_ntz")))
    names = lambda now: sorted(r["name"] for r in store.live(now).collect())
    assert names(T0) == ["a", "b", "c", "d", "ever"]
    assert names(T0 + dt.timedelta(hours=1)) == ["b", "c", "d", "ever"]  # a expires at 11:30, that instant included
    before = store.hours()
    assert store.expire(T0 + dt.timedelta(hours=1)) == [] and store.hours() == before  # 11 o'clock still runs
    assert len(store.expire(dt.datetime(2024, 1, 1, 12, 0))) == 1 and len(store.hours()) == len(before) - 1
    assert names(T0) == ["c", "d", "ever"]  # a and b are gone for good
    assert store.expire(dt.datetime(2030, 1, 1)) and store.hours() == [-1] and names(dt.datetime(2030, 1, 1)) == ["ever"]


def test_reads_prune_passed_hours(spark):
    store = ReportStore(spark, scratch_dir(spark, "reports"))
    for h in range(5):
        store.keep(_report(spark, str(h), T0 + dt.timedelta(hours=h)))
    plan = store.live(T0 + dt.timedelta(hours=3))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "hour" in plan.split("PartitionFilters: [")[1].split("]")[0]

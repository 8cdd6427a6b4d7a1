"""Queries for data quality: profile, schema, numeric summary, drift."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from featurelake.functions.columns import rounded
from featurelake.operators import guard
from featurelake.operators import quality as qa
from featurelake.operators.retention import ReportStore
from featurelake.plans.catalog import query
from featurelake.session import scratch_dir
from featurelake.sources import fixtures as fx
from featurelake.sources.tables import table


@query("quality_profile")
def quality_profile(spark, sf_dir):
    return qa.profile(table(spark, sf_dir, "events"), "events").unionByName(
        qa.profile(table(spark, sf_dir, "lineitem"), "lineitem"))


@query("quality_schema")
def quality_schema(spark, sf_dir):
    return qa.schema_rows(table(spark, sf_dir, "events"), "events")


@query("quality_describe")
def quality_describe(spark, sf_dir):
    return rounded(qa.describe(fx.flowers(spark, sf_dir, balance=True)), 6)


@query("mean_drift")
def mean_drift(spark, sf_dir):
    df = fx.flowers_with_period(spark, sf_dir, cut="1998-07-01")
    return rounded(qa.mean_drift(df, "period"), 6)


@query("schema_watch")
def schema_watch(spark, sf_dir):
    """E5: the events of three periods as three runs of one dataset, with columns gone, new, retyped and emptied; what each run changed."""
    events, kept = table(spark, sf_dir, "events"), guard.SchemaHistory(spark, scratch_dir(spark, "schemas"))
    day = F.to_date("ts")
    first = events.filter(day < F.lit("2024-01-11").cast("date"))
    second = events.filter((day >= F.lit("2024-01-11").cast("date")) & (day < F.lit("2024-01-21").cast("date"))).select(
        "event_id", "ts", F.col("user_id").cast("string").alias("user_id"), "event_type", F.lit(None).cast("double").alias("value"), day.alias("day"))
    third = events.filter(day >= F.lit("2024-01-21").cast("date")).select("event_id", "user_id", "event_type", "value", day.alias("day"))
    for i, run in enumerate((first, second, third)):
        kept.record(run, "events", f"2024-02-0{i + 1} 00:00:00")
    return guard.changes(kept.history("events"))


@query("report_retention")
def report_retention(spark, sf_dir):
    """A report per day and kind of event, kept for ten days after the day's last event; what is left on 20 January at noon."""
    reports = table(spark, sf_dir, "events").groupBy(F.to_date("ts").cast("string").alias("day"), "event_type").agg(
        F.count(F.lit(1)).alias("n_events"), F.max("ts").cast("timestamp_ntz").alias("validated_at"))
    store, now = ReportStore(spark, scratch_dir(spark, "reports")), datetime(2024, 1, 20, 12)
    store.keep(reports.withColumn("expires_at", F.col("validated_at") + F.expr("INTERVAL 10 DAYS")))
    store.expire(now)
    return store.live(now).select("day", "event_type", "n_events", "validated_at", "expires_at")

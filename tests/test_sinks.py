"""Sinks: CSV export, partitioned splits, model persistence, served-feature log, report retention."""

import datetime as dt
import os
import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelake.operators import quality as qa
from featurelake.operators import trips as tp
from featurelake.operators import views as vw
from featurelake.sources import fixtures as fx
from featurelake.streaming import envelopes as env
from featurelake.sources.tables import read_csv, table, write_csv, write_parquet
from tests.conftest import SF_SMALL


def test_catalogue_csv_round_trip(spark):
    d = tempfile.mkdtemp(prefix="fl-csv-")
    cat = spark.createDataFrame([("a", "first", "numeric")], "feature_name string, description string, data_type string")
    write_csv(cat, os.path.join(d, "cat"))
    schema = T.StructType([T.StructField(n, T.StringType()) for n in cat.columns])
    assert read_csv(spark, os.path.join(d, "cat"), schema).collect() == cat.collect()


def test_splits_written_partitioned(spark):
    d = tempfile.mkdtemp(prefix="fl-split-")
    data = tp.temporal_split(tp.trip_prep(fx.trips(spark, SF_SMALL), "pickup_datetime", "dropoff_datetime",
                                          unit="days"), "pickup_datetime", "1999-01-01", "2000-01-01")
    write_parquet(data, os.path.join(d, "trips"), partition_by=["split"])
    back = spark.read.parquet(os.path.join(d, "trips"))
    assert back.filter(F.col("split") == "train").count() == data.filter(F.col("split") == "train").count()
    assert {n for n in os.listdir(os.path.join(d, "trips")) if n.startswith("split=")} <= \
        {"split=train", "split=val", "split=test"}


def test_served_features_log(spark):
    d = tempfile.mkdtemp(prefix="fl-served-")
    served = spark.createDataFrame([(1, 0.5)], "member_id long, purchase_share double")
    vw.log_served(served, "activity_service_v1", dt.datetime(2024, 1, 1), os.path.join(d, "log"))
    vw.log_served(served, "activity_service_v1", dt.datetime(2024, 1, 2), os.path.join(d, "log"))
    back = spark.read.parquet(os.path.join(d, "log"))
    assert back.count() == 2 and set(back.columns) >= {"feature_service", "served_at", "purchase_share"}


def test_report_retention(spark):
    rep = qa.profile(table(spark, SF_SMALL, "events"), "events")
    rows = qa.report_rows(rep, dt.datetime(2024, 1, 1, 0, 0, 0))
    assert qa.live_reports(rows, dt.datetime(2024, 1, 1, 0, 59, 59)).count() == rep.count()
    assert qa.live_reports(rows, dt.datetime(2024, 1, 1, 1, 0, 0)).count() == 0


def test_trip_counts_observed_while_writing(spark):
    d = tempfile.mkdtemp(prefix="fl-obs-")
    out, (before, after) = tp.trip_prep_observed(fx.trips(spark, SF_SMALL), "pickup_datetime", "dropoff_datetime",
                                                 unit="days")
    write_parquet(out, os.path.join(d, "prepared"))
    want = tp.trip_counts(fx.trips(spark, SF_SMALL), "pickup_datetime", "dropoff_datetime", unit="days").first()
    assert before.get["rows_before"] == want["rows_before"]
    assert after.get["rows_after"] == want["rows_after"]


def test_publish_batch_and_stream_through_file_sinks(spark):
    from featurelake.streaming import envelopes as env

    d = tempfile.mkdtemp(prefix="fl-pub-")
    ev = table(spark, SF_SMALL, "events")
    e = env.update_envelope(ev, F.col("user_id"), F.create_map(F.col("event_type"), F.col("value")), F.col("ts"))
    env.publish(e, sink="json", path=os.path.join(d, "topic"))
    assert spark.read.json(os.path.join(d, "topic")).count() == ev.count()
    # the same envelopes as a stream: file source in, file sink out
    e.select("value").write.text(os.path.join(d, "in"))
    stream = env.update_stream(spark, source="text", path=os.path.join(d, "in"))
    q = env.publish(stream.select(F.col("value").alias("key"), "value"), sink="parquet",
                    checkpoint=os.path.join(d, "ckpt"), path=os.path.join(d, "out"))
    q.processAllAvailable()
    q.stop()
    assert spark.read.parquet(os.path.join(d, "out")).count() == ev.count()


def test_spread_only_when_the_scan_is_narrow(spark):
    from featurelake.sources.tables import spread

    wide = spark.range(0, 1000, numPartitions=spark.sparkContext.defaultParallelism * 2)
    assert spread(wide) is wide  # enough splits already: no shuffle added
    narrow = spark.range(0, 1000, numPartitions=1)
    assert spread(narrow).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_file_source_reads_with_declared_schema(spark):
    d = tempfile.mkdtemp(prefix="fl-src-")
    stats = fx.user_activity(spark, SF_SMALL)
    write_parquet(stats, os.path.join(d, "stats"))
    src = vw.FileSource(os.path.join(d, "stats"), schema=stats.schema)
    assert src.read(spark).count() == stats.count()


def test_a_message_is_parsed_once_a_pass(spark):
    raw = ['{"entity_id":"e","feature_data":{"x":1.5},"timestamp":"2024-01-01T00:00:00"}', "{bad", None, '{"feature_data":{"x":1}}']
    decoded = env.decode_updates(spark.createDataFrame([(v,) for v in raw], "value string"))
    good, bad = env.split_bad(decoded)
    for part, n in ((good, 1), (bad, 3)):
        rows = part.select("m.entity_id", "m.feature_data", "m.timestamp") if part is good else part
        assert rows._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1
        assert rows.count() == n

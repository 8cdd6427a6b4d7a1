"""The latest value in the keyed state store: order, replays, restarts, expiry, one hot key."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from featurelake.streaming import state as ss

DAY = dt.timedelta(days=1)
T0 = dt.datetime(2024, 1, 10)
ROW = "entity_id string, feature_name string, feature_value double, event_ts timestamp, seq bigint"


@pytest.fixture()
def topic(spark):
    root = tempfile.mkdtemp(prefix="fl-state-")
    sink = ss.StateSink(os.path.join(root, "out"), compact_every=2)

    def send(*rows):
        """Each call is one more file of the source."""
        spark.createDataFrame(list(rows), ROW).coalesce(1).write.mode("append").parquet(os.path.join(root, "in"))

    def run(**kw):
        stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(os.path.join(root, "in"))
        ss.run_changes(stream, sink, os.path.join(root, "checkpoint"), **kw)
        return {(r["entity_id"], r["feature_name"]): (r["feature_value"], r["seq"]) for r in sink.current(spark).collect()}

    return send, run, sink


def test_newest_wins_across_batches_and_restarts(spark, topic):
    send, run, sink = topic
    send(("a", "x", 1.0, T0, 1), ("a", "x", 2.0, T0, 2), ("b", "x", 5.0, T0, 3), ("a", "y", None, T0, 4))
    assert run() == {("a", "x"): (2.0, 2), ("b", "x"): (5.0, 3)}
    send(("a", "x", 9.0, T0 - DAY, 5), ("b", "x", 6.0, T0, 6))  # the first is older than what the state holds
    assert run() == {("a", "x"): (2.0, 2), ("b", "x"): (6.0, 6)}
    send((None, "x", 1.0, T0 + DAY, 7), ("a", None, 1.0, T0 + DAY, 8), ("a", "x", 1.0, None, 9), ("a", "x", None, T0 + DAY, 9))
    send(("a", "x", 3.0, T0 + DAY, 10))
    assert run()[("a", "x")] == (3.0, 10)
    assert run()[("a", "x")] == (3.0, 10)  # nothing new
    written = spark.read.parquet(sink.changes_path)
    assert written.filter("entity_id = 'a' AND feature_name = 'x'").count() == 2  # one row for each change, none for what changed nothing


def test_idle_keys_expire_by_event_time(spark, topic):
    send, run, sink = topic
    send(("old", "x", 1.0, T0, 1), ("kept", "x", 1.0, T0, 2))
    run(idle=3 * DAY, lateness="0 seconds")
    send(("kept", "x", 2.0, T0 + 2 * DAY, 3))
    run(idle=3 * DAY, lateness="0 seconds")
    send(("new", "x", 1.0, T0 + 4 * DAY, 4))  # the watermark passes T0 + 3 days
    run(idle=3 * DAY, lateness="0 seconds")
    send(("new", "x", 2.0, T0 + 4 * DAY + dt.timedelta(hours=1), 5))
    got = run(idle=3 * DAY, lateness="0 seconds")
    assert got == {("kept", "x"): (2.0, 3), ("new", "x"): (2.0, 5)}
    gone = spark.read.parquet(sink.changes_path).filter("op = 'expired'").collect()
    assert [(r["entity_id"], r["feature_value"]) for r in gone] == [("old", 1.0)]
    send(("old", "x", 7.0, T0 + 6 * DAY, 6))  # comes back
    assert run(idle=3 * DAY, lateness="0 seconds")[("old", "x")] == (7.0, 6)


def test_a_replayed_batch_changes_nothing(spark, topic):
    send, run, sink = topic
    send(("a", "x", 1.0, T0, 1))
    before = run()
    rows = spark.read.parquet(os.path.join(sink.changes_path, "batch_id=0")).collect()
    sink(spark.createDataFrame(rows, ss.CHANGES), 0)
    assert {(r["entity_id"], r["feature_name"]): (r["feature_value"], r["seq"]) for r in sink.current(spark).collect()} == before


def test_a_hot_key_is_reduced_before_the_shuffle(spark):
    rows = spark.range(20_000, numPartitions=4).select(F.lit("hot").alias("entity_id"), F.lit("x").alias("feature_name"), F.col("id").cast("double").alias("feature_value"),
                                                       F.lit(T0).cast("timestamp").alias("event_ts"), F.col("id").alias("seq"))
    left = rows.mapInPandas(ss._newest_of_batches, ss.ROWS)
    assert left.count() <= 8 and left.agg(F.max("seq")).first()[0] == 19_999


def test_a_key_costs_one_look_up_and_takes_rows():
    class Held:
        def __init__(self):
            self.value, self.looks = None, 0

        def get(self):
            self.looks += 1
            return self.value

        def exists(self):
            self.looks += 1
            return self.value is not None

        def update(self, value):
            self.value = value

    latest = ss.LatestValue(None)
    latest.held = held = Held()
    row = lambda at, seq, value: Row(entity_id="a", feature_name="x", feature_value=value, event_us=at, seq=seq)
    out = list(latest.handleInputRows(("a", "x"), iter([row(5, 1, 1.0), row(7, 0, 2.0), row(7, 0, 9.0)]), None))
    assert out == [Row(entity_id="a", feature_name="x", feature_value=2.0, event_us=7, seq=0, op="set")]
    assert list(latest.handleInputRows(("a", "x"), iter([row(6, 9, 3.0)]), None)) == [] and held.value == (2.0, 7, 0)
    assert held.looks == 2


def test_other_time_zones_raise(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ValueError, match="UTC"):
            ss.changes(spark.createDataFrame([], ROW))
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")

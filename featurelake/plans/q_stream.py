"""Queries for envelopes and streaming.

Streaming keys write their input messages (derived from the tables) to a
scratch folder under the session's checkpoint folder, run the stream with
``availableNow`` and return the table the stream produced, read back.
"""

from __future__ import annotations

import os

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from featurelake.operators import metrics as mt
from featurelake.operators import transform as tr
from featurelake.plans.catalog import query
from featurelake.session import scratch_dir
from featurelake.sources import fixtures as fx
from featurelake.sources.tables import table
from featurelake.streaming import envelopes as env
from featurelake.streaming import state
from featurelake.streaming.scoring import bad_messages, score_messages
from featurelake.streaming.store_sink import FeatureStoreSink, read_committed, run_available_now

def update_messages(spark, sf_dir):
    """One update message per event, its time cut to the day (so many of an entity share one), and five kinds of
    malformed messages for events of large value. offset = event id, as a topic would number them."""
    ev = table(spark, sf_dir, "events")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    body = F.struct(F.col("user_id").cast("string").alias("entity_id"), F.create_map("event_type", "value").alias("feature_data"),
                    env.iso(day).alias("timestamp"), F.lit(env.UPDATE_EVENT).alias("event_type"))
    key = F.col("user_id").cast("string").alias("key")
    good = ev.select(key, F.to_json(body).alias("value"), F.col("event_id").alias("offset"))
    n = F.col("event_id").cast("string")
    kind = F.col("event_type")
    malformed = (F.when(kind == "error", F.concat(F.lit("{bad"), n))
                 .when(kind == "click", F.concat(F.lit('{"feature_data":{"x":'), n, F.lit('},"timestamp":"2024-01-01T00:00:00"}')))
                 .when(kind == "view", F.concat(F.lit('{"entity_id":"'), n, F.lit('","feature_data":{},"timestamp":"2024-01-01T00:00:00"}')))
                 .when(kind == "signup", F.concat(F.lit('{"entity_id":"'), n, F.lit('","timestamp":"2024-01-01T00:00:00"}')))
                 .when(kind == "purchase", F.concat(F.lit('{"entity_id":"'), n, F.lit('","feature_data":{"x":1.0},"timestamp":"not-a-time"}'))))
    bad = ev.filter(F.col("value") > 45).select(key, malformed.alias("value"), F.col("event_id").alias("offset")).filter("value IS NOT NULL")
    return good.unionByName(bad)


def _message_stream(spark, messages, path: str):
    """Write keyed messages as a topic would hold them (an entity's messages lie in one file) and stream them in a few micro-batches."""
    messages.select("key", "value", "offset").repartition("key").write.parquet(path)
    files = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return env.update_stream(spark, "parquet", path=path, maxFilesPerTrigger=max(1, files // 4))


def _parse_updates(envelopes):
    m = F.from_json("value", env.UPDATE_SCHEMA)
    return envelopes.select("key", m.alias("m")).select(
        "key", "m.entity_id", "m.event_type", "m.timestamp", F.explode("m.feature_data").alias("feature_name", "feature_value"))


@query("update_envelope")
def update_envelope(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    e = env.update_envelope(ev, F.col("user_id"), F.create_map(F.col("event_type"), F.col("value")), F.col("ts"))
    return _parse_updates(e)


@query("prediction_envelope")
def prediction_envelope(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    e = env.prediction_envelope(ev, F.col("user_id"), mt.rule_score(F.col("value")),
                                F.create_map(F.col("event_type"), F.col("value")), F.col("ts"))
    m = F.from_json("value", env.PREDICTION_SCHEMA)
    return e.select("key", m.alias("m")).select("key", "m.entity_id", "m.prediction", "m.event_type", "m.timestamp",
                                                F.size("m.features").cast("bigint").alias("n_features"))


def _run_store_stream(spark, sf_dir) -> FeatureStoreSink:
    root = scratch_dir(spark, "stream")
    src = os.path.join(root, "messages")
    stream = _message_stream(spark, update_messages(spark, sf_dir), src)
    sink = FeatureStoreSink(os.path.join(root, "store"))
    run_available_now(stream, sink, os.path.join(root, "checkpoint"))
    return sink


@query("stream_decode")
def stream_decode(spark, sf_dir):
    return _run_store_stream(spark, sf_dir).log(spark).select("entity_id", "feature_name", "feature_value", "event_ts")


@query("stream_bad_records")
def stream_bad_records(spark, sf_dir):
    return _run_store_stream(spark, sf_dir).dead_letters(spark).select("raw_value", "reason")


@query("stream_upsert")
def stream_upsert(spark, sf_dir):
    return _run_store_stream(spark, sf_dir).latest(spark).select("entity_id", "feature_name", "feature_value", "event_ts")


@query("stream_state_latest")
def stream_state_latest(spark, sf_dir):
    """T3 by the stream's own state; the same messages and rows as ``stream_upsert``."""
    root = scratch_dir(spark, "state")
    messages = _message_stream(spark, update_messages(spark, sf_dir), os.path.join(root, "messages"))
    good, _ = env.split_bad(env.decode_updates(messages))
    sink = state.StateSink(os.path.join(root, "latest"))
    state.run_changes(env.fan_out(good, seq=F.col("offset")), sink, os.path.join(root, "checkpoint"))
    return sink.current(spark).select(
        "entity_id", "feature_name", "feature_value", F.col("event_ts").cast("timestamp_ntz").alias("event_ts"))


def measurement_messages(spark, sf_dir):
    """Update messages carrying the four measurements of each line item."""
    li = table(spark, sf_dir, "lineitem")
    feats = F.create_map(F.lit("sepal_length"), F.col("l_quantity"), F.lit("sepal_width"), F.col("l_tax"),
                         F.lit("petal_length"), F.col("l_extendedprice"), F.lit("petal_width"), F.col("l_discount"))
    return env.update_envelope(li, F.concat_ws("-", "l_orderkey", "l_linenumber"), feats, F.col("l_shipdate")).withColumn("offset", F.lit(0).cast("bigint"))


#: The model's training columns; the ratios, which can be NULL, are not among them.
TRAINING_COLUMNS = ["sepal_length", "sepal_width", "petal_length", "petal_width", "sepal_area", "petal_area"]


def band_model(spark, sf_dir):
    """A decision tree fitted to the quantity bands of the line items (X10's label)."""
    rows = fx.flowers(spark, sf_dir)
    q = F.col("sepal_length")
    rows = tr.engineer_features(rows.withColumn("label", F.when(q < 17, 0.0).when(q < 34, 1.0).otherwise(2.0)))
    tree = DecisionTreeClassifier(maxDepth=4, maxBins=128, seed=0)
    return Pipeline(stages=[VectorAssembler(inputCols=TRAINING_COLUMNS, outputCol="features"), tree]).fit(rows)


@query("stream_score")
def stream_score(spark, sf_dir):
    root = scratch_dir(spark, "score")
    src, out = os.path.join(root, "messages"), os.path.join(root, "predictions")
    model = band_model(spark, sf_dir)
    stream = _message_stream(spark, measurement_messages(spark, sf_dir), src)

    def sink(batch, batch_id):
        scored = score_messages(batch, fx.FLOWER_FEATURES, model.transform, TRAINING_COLUMNS)
        scored.write.mode("overwrite").parquet(os.path.join(out, f"batch_id={batch_id}"))
        bad_messages(batch).write.mode("overwrite").parquet(os.path.join(root, "dead_letter", f"batch_id={batch_id}"))

    run_available_now(stream, sink, os.path.join(root, "checkpoint"))
    m = F.from_json("value", env.PREDICTION_SCHEMA)
    return read_committed(spark, out).select("key", m.alias("m")).select(
        "key", "m.entity_id", "m.prediction", "m.event_type", "m.timestamp",
        F.size("m.features").cast("bigint").alias("n_features"))

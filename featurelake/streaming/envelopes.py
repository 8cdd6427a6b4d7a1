"""Message envelopes for feature updates and predictions.

The same functions serve batch frames and streaming frames: encoding is
``to_json(struct(...))`` keyed by entity (so a Kafka-style sink partitions by
entity), decoding is ``from_json`` with a fixed schema. Malformed messages are
not dropped silently: ``split_bad`` routes them to a dead-letter frame.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelake.functions.columns import nan_to_null

# Event type names of the two message kinds.
UPDATE_EVENT = "feature_update"
PREDICTION_EVENT = "model_prediction"

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

UPDATE_SCHEMA = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("feature_data", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("timestamp", T.StringType()),
    T.StructField("event_type", T.StringType()),
])

PREDICTION_SCHEMA = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("features", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("timestamp", T.StringType()),
    T.StructField("event_type", T.StringType()),
])


def iso(ts: Column) -> Column:
    return F.date_format(ts, ISO_FORMAT)


def update_envelope(df: DataFrame, entity: Column, features: Column, ts: Column) -> DataFrame:
    """(key, value) rows; key = entity id, value = JSON update message.

    ``features`` is a map column name->value (see ``transform.feature_map``);
    rows with an empty map are skipped, like the reference's publisher.
    """
    body = F.struct(entity.cast("string").alias("entity_id"), features.alias("feature_data"),
                    iso(ts).alias("timestamp"), F.lit(UPDATE_EVENT).alias("event_type"))
    return (df.select(entity.cast("string").alias("key"), body.alias("m"))
              .filter(F.size("m.feature_data") > 0)
              .select("key", F.to_json("m").alias("value")))


def prediction_envelope(df: DataFrame, entity: Column, prediction: Column, features: Column, ts: Column) -> DataFrame:
    """(key, value) rows carrying a prediction, its input features and a time stamp."""
    body = F.struct(entity.cast("string").alias("entity_id"), prediction.cast("double").alias("prediction"),
                    features.alias("features"), iso(ts).alias("timestamp"),
                    F.lit(PREDICTION_EVENT).alias("event_type"))
    return df.select(entity.cast("string").alias("key"), F.to_json(body).alias("value"))


def event_time() -> Column:
    """The message's time; NULL, not an error, when it cannot be read."""
    return F.col("m.timestamp").try_cast("timestamp_ntz")


def decode_updates(messages: DataFrame, value: str = "value") -> DataFrame:
    """Parse update messages; adds ``_valid`` (parsed, has an entity, a non-empty map and a readable time).

    The parsed message is a generated column: the optimizer would else copy the parser into each condition and each field read of it.
    """
    m = F.from_json(F.col(value).cast("string"), UPDATE_SCHEMA)
    out = messages.select("*", F.explode(F.array(m)).alias("m"))
    valid = (F.col("m").isNotNull() & F.col("m.entity_id").isNotNull() & F.col("m.feature_data").isNotNull()
             & (F.size("m.feature_data") > 0) & event_time().isNotNull())
    return out.select("*", F.coalesce(valid, F.lit(False)).alias("_valid"))


def split_bad(decoded: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good rows, dead-letter rows with the raw message and a reason)."""
    good = decoded.filter("_valid")
    bad = decoded.filter(~F.col("_valid")).select(
        F.col(value).cast("string").alias("raw_value"),
        F.when(F.col("m").isNull() | F.get_json_object(F.col(value).cast("string"), "$").isNull(), "unparseable")
         .when(F.col("m.entity_id").isNull(), "missing entity_id")
         .when(F.col("m.feature_data").isNull(), "missing feature_data")
         .when(F.size("m.feature_data") == 0, "empty feature_data").otherwise("bad timestamp").alias("reason"))
    return good, bad


def fan_out(good: DataFrame, ingest_ts: Column | None = None, seq: Column | None = None) -> DataFrame:
    """One long-log row per (message, feature): the intent of one value per feature per message (Q1)."""
    ing = ingest_ts if ingest_ts is not None else F.lit(None).cast("timestamp_ntz")
    sq = seq if seq is not None else F.lit(0).cast("bigint")
    rows = good.select(F.col("m.entity_id").alias("entity_id"), event_time().alias("event_ts"),
                       ing.cast("timestamp_ntz").alias("ingest_ts"), sq.cast("bigint").alias("seq"),
                       F.explode("m.feature_data").alias("feature_name", "feature_value"))
    return rows.select("entity_id", "feature_name", nan_to_null("feature_value").alias("feature_value"), "event_ts",
                       "ingest_ts", "seq")


def update_stream(spark, source: str = "kafka", **options) -> DataFrame:
    """A stream of update messages: string ``value``, ``ingest_ts`` and ``offset`` (its place in the source).

    ``source="kafka"`` reads the topic from its latest offsets by default
    (``subscribe`` and ``kafka.bootstrap.servers`` come in ``options``); a file
    source (``"text"``/``"json"``) takes ``path`` and serves tests and replays.
    """
    if source == "kafka":
        opts = {"startingOffsets": "latest", **options}
        raw = spark.readStream.format("kafka").options(**opts).load()
        return raw.select(F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"),
                          F.col("timestamp").alias("ingest_ts"), "offset")
    path = options.pop("path")
    if source == "parquet":  # rows (value, offset), as a topic archive keeps them
        raw = spark.readStream.options(**options).schema("value string, offset bigint").parquet(path)
        return raw.select("value", F.col("_metadata.file_modification_time").alias("ingest_ts"), "offset")
    raw = spark.readStream.options(**options).schema("value string").format("text").load(path)
    return raw.select("value", F.col("_metadata.file_modification_time").alias("ingest_ts"))


def publish(envelopes: DataFrame, sink: str = "kafka", checkpoint: str | None = None, **options):
    """Write (key, value) envelopes; keyed by entity so the topic partitions by entity.

    Works for batch and streaming frames. Delivery guarantees come from the
    sink (Kafka idempotent producer settings pass through ``options``, e.g.
    ``kafka.acks=all``) and, for streams, the checkpoint.
    """
    if envelopes.isStreaming:
        w = envelopes.writeStream.format(sink).options(**options)
        if checkpoint:
            w = w.option("checkpointLocation", checkpoint)
        return w.start()
    envelopes.write.format(sink).options(**options).mode("append").save()
    return None

"""Score a stream with the batch feature logic.

Messages that cannot be decoded go to ``bad_messages``. The stream is decoded with the same envelope schema, its feature map is turned
into the named columns the model expects, ``engineer_features`` (the batch
function, unchanged) adds the derived columns, ``align_schema`` fixes the
column set, and the model's ``transform`` (or any ``DataFrame -> DataFrame``
scorer) predicts. Predictions leave as prediction envelopes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.operators.transform import align_schema, engineer_features, feature_map
from featurelake.streaming.envelopes import decode_updates, event_time, prediction_envelope, split_bad


def features_from_messages(messages: DataFrame, names: list[str], value: str = "value") -> DataFrame:
    """Decode update messages into one row per message with the named feature columns."""
    d = decode_updates(messages, value).filter("_valid")
    return d.select(F.col("m.entity_id").alias("entity_id"),
                    event_time().alias("event_ts"),
                    *[F.col("m.feature_data").getItem(n).alias(n) for n in names])


def score_messages(messages: DataFrame, names: list[str], model: Callable[[DataFrame], DataFrame],
                   feature_columns: list[str] | None = None, value: str = "value") -> DataFrame:
    """T5: messages -> engineered, aligned features -> model -> prediction envelopes (key, value).

    The envelope carries the raw inputs ``names``. ``feature_columns`` are the model's training columns: columns it
    was not trained on are dropped, missing ones filled.
    """
    raw = features_from_messages(messages, names, value)
    raw = raw.select("*", feature_map(raw.select(*names)).alias("inputs__"))
    rows = engineer_features(raw)
    if feature_columns is not None:
        rows = align_schema(rows, feature_columns, keep=("entity_id", "event_ts", "inputs__"))
    scored = model(rows)
    return prediction_envelope(scored, F.col("entity_id"), F.col("prediction"), F.col("inputs__"), F.col("event_ts"))


def bad_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """The messages that cannot be scored: (raw_value, reason)."""
    return split_bad(decode_updates(messages, value), value)[1]

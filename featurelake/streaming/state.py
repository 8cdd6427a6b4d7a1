"""Latest value per (entity, feature) in Spark's keyed state store, with event-time expiry.

``FeatureStoreSink`` keeps a log and merges on read. Here the newest value of every key lives in the stream's own state (RocksDB, checkpointed
with the offsets), so a micro-batch emits only what changed, each change once, also after a restart:

1. every Arrow batch of decoded rows is first reduced to its newest row per key, so a key that holds a third of all messages
   sends one row per Arrow batch through the shuffle;
2. ``LatestValue`` compares them with the key's state, keeps the newer by (event time, offset), and sets an event-time timer
   ``idle`` after it. When the watermark passes a timer whose key has had nothing newer since, the state goes and an expiry is emitted;
3. ``StateSink`` writes a micro-batch's changes to ``changes/batch_id=N`` (a replay overwrites the same folder) and folds them into a
   snapshot every ``compact_every`` batches. ``current`` reads the newest snapshot and the changes after it.

Messages of one event time are ordered by the source's offset. The watermark lies ``lateness`` behind the newest event time; messages
older than that are not read, so it has to span the source's disorder.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from datetime import timedelta

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from featurelake.streaming.store_sink import list_versions, read_committed, run_available_now

KEY = ["entity_id", "feature_name"]
ROWS = "entity_id string, feature_name string, feature_value double, event_ts timestamp, seq bigint"
CHANGES = ROWS + ", op string"
#: Rows of the keyed state: a key has few rows a micro-batch, so they go as rows, not as a pandas frame a key.
_STATE_ROWS = "entity_id string, feature_name string, feature_value double, event_us bigint, seq bigint, op string"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_ORDER = ["event_ts", "seq"]


def _newest_of_batches(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for rows in frames:
        yield rows.sort_values(_ORDER, kind="stable").drop_duplicates(KEY, keep="last")


class LatestValue(StatefulProcessor):
    """Keeps a key's newest row; ``idle`` after its event time it expires (never, where ``idle`` is None)."""

    def __init__(self, idle: timedelta | None):
        self.idle_ms = None if idle is None else int(idle / timedelta(milliseconds=1))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("held", "feature_value double, event_us bigint, seq bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803 - Spark's names
        best = max(((row["event_us"], row["seq"], row["feature_value"]) for row in rows), key=lambda row: row[:2])
        held = self.held.get()
        if held is not None and (held[1], held[2]) >= best[:2]:
            return
        if self.idle_ms is not None:
            if held is not None:
                self.handle.deleteTimer(self._due(held[1]))
            self.handle.registerTimer(self._due(best[0]))
        self.held.update((best[2], best[0], best[1]))
        yield self._change(key, best[2], best[0], best[1], "set")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        held = self.held.get()
        if held is None:
            return
        value, at, seq = held
        if self._due(at) <= expiredTimerInfo.getExpiryTimeInMs():
            self.held.clear()
            yield self._change(key, value, at, seq, "expired")

    def close(self) -> None:
        pass

    def _due(self, event_us: int) -> int:
        return -(-event_us // 1000) + self.idle_ms

    @staticmethod
    def _change(key, value, at, seq, op) -> Row:
        return Row(entity_id=key[0], feature_name=key[1], feature_value=value, event_us=at, seq=seq, op=op)


def changes(rows: DataFrame, idle: timedelta | None = None, lateness: str = "3650 days") -> DataFrame:
    """The stream of changes of a stream of long rows (entity_id, feature_name, feature_value, event_ts, seq).

    Rows without a key, a time or a value change nothing, as in the batch reads of the latest values. The session needs the RocksDB state store; it is set here where the session has the default.
    """
    spark = rows.sparkSession
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        raise ValueError("event times are UTC: set spark.sql.session.timeZone to UTC")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    long = rows.select("entity_id", "feature_name", F.col("feature_value").cast("double"), F.col("event_ts").cast("timestamp").alias("event_ts"),
                       F.col("seq").cast("bigint").alias("seq")).dropna()
    reduced = long.mapInPandas(_newest_of_batches, ROWS)
    timed = reduced.withWatermark("event_ts", lateness).withColumn("event_us", F.unix_micros("event_ts"))
    found = timed.groupBy(*KEY).transformWithState(LatestValue(idle), _STATE_ROWS, "Update", "EventTime")
    return found.select(*KEY, "feature_value", F.timestamp_micros("event_us").alias("event_ts"), "seq", "op")


class StateSink:
    """``foreachBatch`` sink of ``changes``, and the current table made of them."""

    def __init__(self, root: str, compact_every: int = 8):
        self.changes_path, self.current_path = os.path.join(root, "changes"), os.path.join(root, "current")
        self.compact_every = max(1, compact_every)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(os.path.join(self.changes_path, f"batch_id={batch_id}"))
        if (batch_id + 1) % self.compact_every == 0:
            self._folded(batch.sparkSession, batch_id).write.mode("overwrite").parquet(os.path.join(self.current_path, f"v={batch_id}"))

    def _folded(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """A key's last change; expired keys are gone."""
        done = read_committed(spark, self.changes_path)
        if done is None:
            return spark.createDataFrame([], ROWS)
        snaps = [v for v in list_versions(spark, self.current_path, "v") if upto is None or v < upto]
        if upto is not None:
            done = done.filter(F.col("batch_id") <= upto)
        if snaps:
            base = spark.read.parquet(os.path.join(self.current_path, f"v={snaps[-1]}"))
            done = done.filter(F.col("batch_id") > snaps[-1]).unionByName(base.select("*", F.lit("set").alias("op"), F.lit(-1).alias("batch_id")))
        # an expiry and a new value of one key may come in one micro-batch: the expiry is of the older row, so it loses
        order = F.struct("batch_id", "event_ts", "seq", (F.col("op") == "expired").alias("gone"))
        last = done.groupBy(*KEY).agg(F.max_by(F.struct("feature_value", "event_ts", "seq", "op"), order).alias("last"))
        return last.filter("last.op = 'set'").select(*KEY, "last.feature_value", "last.event_ts", "last.seq")

    def current(self, spark: SparkSession) -> DataFrame:
        return self._folded(spark)


def run_changes(rows: DataFrame, sink: StateSink, checkpoint: str, idle: timedelta | None = None, lateness: str = "3650 days") -> None:
    """Process all that is available, then stop; the next call goes on from the checkpoint, with its state."""
    stream = changes(rows, idle, lateness)
    if not stream.isStreaming:
        raise ValueError("a stream of rows is needed")
    run_available_now(stream, sink, checkpoint, output_mode="update")

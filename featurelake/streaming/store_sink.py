"""Keep the feature store current from a stream.

``FeatureStoreSink`` is a ``foreachBatch`` function, log-structured so that a
micro-batch costs work proportional to the batch, not to the stored state.
For micro-batch ``b`` it

1. decodes the messages and sends malformed ones to ``dead_letter/batch_id=b``;
2. writes the long rows to ``log/batch_id=b`` (overwrite of that one partition,
   so a replayed batch changes nothing);
3. writes catalogue rows for the features seen in the batch (reads fold them, last write wins);
4. every ``compact_every`` batches, folds the log written since the last
   snapshot into a new latest-value snapshot ``latest/v=b``.

Reads of the latest values merge the newest snapshot with the log partitions
after it (partition-pruned on ``batch_id``). The merge orders by event time,
so a late message with an older event time is logged but never served over a
newer value. Snapshots are new folders; nothing a reader may be using is
overwritten in place.
"""

from __future__ import annotations

import os

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelake.operators import store as st
from featurelake.streaming.envelopes import decode_updates, fan_out, split_bad


def list_versions(spark: SparkSession, path: str, prefix: str) -> list[int]:
    """Version numbers of ``path/prefix=N`` sub-folders, via the Hadoop file system API."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if s.isDirectory() and name.startswith(prefix + "="):
            sub = s.getPath()
            if fs.exists(jvm.org.apache.hadoop.fs.Path(sub, "_SUCCESS")):
                out.append(int(name.split("=", 1)[1]))
    return sorted(out)


def read_committed(spark: SparkSession, path: str, prefix: str = "batch_id") -> DataFrame | None:
    """The table of the sub-folders whose writes have been committed; a half-written batch stays invisible."""
    done = list_versions(spark, path, prefix)
    if not done:
        return None
    return spark.read.option("basePath", path).parquet(*[os.path.join(path, f"{prefix}={n}") for n in done])


def read_latest(spark: SparkSession, latest_path: str, before: int | None = None) -> DataFrame | None:
    vs = [v for v in list_versions(spark, latest_path, "v") if before is None or v < before]
    if not vs:
        return None
    return spark.read.parquet(os.path.join(latest_path, f"v={vs[-1]}"))


class FeatureStoreSink:
    """``foreachBatch`` sink keeping log, dead letters, catalogue and latest-value snapshots."""

    def __init__(self, root: str, value_col: str = "value", compact_every: int = 8):
        self.root = root
        self.log_path = os.path.join(root, "log")
        self.latest_path = os.path.join(root, "latest")
        self.dead_path = os.path.join(root, "dead_letter")
        self.catalog_path = os.path.join(root, "catalog")
        self.value_col = value_col
        self.compact_every = max(1, compact_every)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # parse each message once: the log and the dead-letter writes both read it
        decoded = decode_updates(batch, self.value_col).persist(StorageLevel.MEMORY_AND_DISK)
        good, bad = split_bad(decoded, self.value_col)
        # the source's own arrival time and offset where it has them: a replayed batch then writes the same rows, and of
        # equal event times the later message wins (Q3); else the batch's time and the place in the batch
        ingest = F.col("ingest_ts") if "ingest_ts" in batch.columns else F.current_timestamp()
        seq = F.col("offset") if "offset" in batch.columns else F.monotonically_increasing_id()
        rows = fan_out(good, ingest_ts=ingest, seq=seq)
        rows.write.mode("overwrite").parquet(os.path.join(self.log_path, f"batch_id={batch_id}"))
        bad.write.mode("overwrite").parquet(os.path.join(self.dead_path, f"batch_id={batch_id}"))
        # catalogue entries of this batch (one row per feature name); reads fold them, last write wins
        names = rows.groupBy("feature_name").agg(F.max("event_ts").alias("at"))
        st.describe_stream_features(names, F.col("at")).write.mode("overwrite").parquet(
            os.path.join(self.catalog_path, f"batch_id={batch_id}"))
        decoded.unpersist()
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(spark, upto=batch_id)

    def _merged(self, spark: SparkSession, upto: int | None = None) -> DataFrame | None:
        """Latest rows: newest snapshot (at or before ``upto``) merged with the log after it."""
        snaps = [v for v in list_versions(spark, self.latest_path, "v") if upto is None or v <= upto]
        base = spark.read.parquet(os.path.join(self.latest_path, f"v={snaps[-1]}")) if snaps else None
        if not list_versions(spark, self.log_path, "batch_id"):
            return base
        log = self.log(spark)
        if snaps:
            log = log.filter(F.col("batch_id") > snaps[-1])
        if upto is not None:
            log = log.filter(F.col("batch_id") <= upto)
        delta = log.select(*st.LOG_COLUMNS)
        both = delta if base is None else base.select(*st.LOG_COLUMNS).unionByName(delta)
        return st.latest_long_rows(both)

    def compact(self, spark: SparkSession, upto: int) -> None:
        """Fold the log up to batch ``upto`` into snapshot ``latest/v=upto`` (idempotent)."""
        merged = self._merged(spark, upto=upto)
        if merged is not None:
            merged.write.mode("overwrite").parquet(os.path.join(self.latest_path, f"v={upto}"))

    def latest(self, spark: SparkSession) -> DataFrame | None:
        return self._merged(spark)

    def log(self, spark: SparkSession) -> DataFrame | None:
        return read_committed(spark, self.log_path)

    def dead_letters(self, spark: SparkSession) -> DataFrame | None:
        return read_committed(spark, self.dead_path)

    def catalog(self, spark: SparkSession) -> DataFrame | None:
        if not list_versions(spark, self.catalog_path, "batch_id"):
            return None
        return st.metadata_upsert(None, read_committed(spark, self.catalog_path))


def run_available_now(stream: DataFrame, batch_fn, checkpoint: str, timeout_s: float | None = None, output_mode: str = "append") -> None:
    """Process everything available now in micro-batches, then stop (checkpointed, restartable).

    Waits until all of it is processed. A ``timeout_s`` that runs out before that stops the stream and raises; the
    checkpoint lets the next call go on from there.
    """
    q = (stream.writeStream.foreachBatch(batch_fn).outputMode(output_mode).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    done = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination() is None
    if not done:
        q.stop()
        raise TimeoutError(f"the stream had input left after {timeout_s} s")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))

"""Reports that go when their time is up (S16): stored by the hour of their expiry, dropped by whole folders.

Rows carry ``expires_at`` (``quality.report_rows``) and lie in ``root/hour=H``, H being the hours since 1970 in which they expire. ``expire``
removes the folders of hours that have passed without reading a row, so its cost does not follow the size of what is kept or dropped. The
hour that is running keeps its folder; ``live`` leaves its expired rows out.
"""

from __future__ import annotations

import os
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelake.session import discard

_HOUR = 3_600_000_000


def _now_micros(now: datetime) -> int:
    now = now.replace(tzinfo=timezone.utc) if now.tzinfo is None else now
    return round(now.timestamp() * 1_000_000)


class ReportStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def keep(self, rows: DataFrame) -> None:
        """Append rows with ``expires_at`` (timestamp_ntz); a row without one never expires."""
        hour = F.floor(F.unix_micros(F.col("expires_at").cast("timestamp")) / F.lit(_HOUR))
        rows.withColumn("hour", F.coalesce(hour, F.lit(-1)).cast("bigint")).write.mode("append").partitionBy("hour").parquet(self.root)

    def hours(self) -> list[int]:
        """The hours of expiry that have a folder; -1 holds what never expires."""
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(self.root)
        fs = at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
        return sorted(int(n.split("=", 1)[1]) for n in names if n.startswith("hour="))

    def expire(self, now: datetime) -> list[int]:
        """Drop the folders in which every row has expired at ``now``; returns their hours."""
        gone = [h for h in self.hours() if h >= 0 and (h + 1) * _HOUR <= _now_micros(now)]
        for h in gone:
            discard(self.spark, os.path.join(self.root, f"hour={h}"))
        return gone

    def live(self, now: datetime) -> DataFrame | None:
        """The rows still within their time; only folders of this hour and later ones are read. None where nothing is kept."""
        if not self.hours():
            return None
        at = _now_micros(now)
        rows = self.spark.read.parquet(self.root)
        fresh = F.col("expires_at").isNull() | (F.unix_micros(F.col("expires_at").cast("timestamp")) > at)
        return rows.filter(((F.col("hour") == -1) | (F.col("hour") >= at // _HOUR)) & fresh).drop("hour")

"""Online tables laid out for point reads (J3, S9): bucketed and sorted by key, with Parquet Bloom filters on the keys.

A version of a view's online table is written once: one file per bucket, sorted by key, each row group with a Bloom filter per key column. A
lookup then deals out the request rows by key into the same buckets and merges; the table itself is never shuffled. Where the
requests hold few different keys, those keys go into the scan as a filter: whole buckets are not opened (one key column), row groups whose Bloom
filter denies every key are not read. Either way gives the same rows.

Versions are folders ``v=N`` beside a small description, so a new session declares the newest one again and reads on.
"""

from __future__ import annotations

import json
import os
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelake.operators.views import FeatureView, latest_per_key
from featurelake.streaming.store_sink import list_versions, read_latest

#: Up to so many different keys are looked up by a filter in the scan.
POINT_KEYS = 1_000


class OnlineTable:
    """One view's newest row per key under ``root``. ``buckets`` holds for the next version written; each version knows its own."""

    def __init__(self, spark: SparkSession, root: str, view: FeatureView, buckets: int = 64):
        self.spark, self.root, self.view, self.buckets = spark, root, view, buckets

    def _data(self, version: int) -> str:
        return os.path.join(self.root, "data", f"v={version}")

    def _name(self, version: int) -> str:
        """A table name that says which folder it is declared on."""
        return "online_" + re.sub(r"\W+", "_", self._data(version)).strip("_").lower()

    def version(self) -> int | None:
        found = list_versions(self.spark, os.path.join(self.root, "about"), "v")
        return found[-1] if found else None

    def write(self, rows: DataFrame) -> int:
        """Keep ``rows`` (one per key) as the next version. The description is written last: a version without one is not read."""
        version, keys = (self.version() if self.version() is not None else -1) + 1, list(self.view.keys)
        kept = rows.repartition(self.buckets, *[F.col(k) for k in keys])
        writer = kept.write.format("parquet").bucketBy(self.buckets, *keys).sortBy(*keys).option("path", self._data(version))
        for k in keys:
            writer = writer.option(f"parquet.bloom.filter.enabled#{k}", "true")
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(version)}")
        writer.mode("overwrite").saveAsTable(self._name(version))
        about = self.spark.range(1).select(F.lit(rows.schema.json()).alias("schema"), F.lit(self.buckets).alias("buckets"))
        about.write.mode("overwrite").parquet(os.path.join(self.root, "about", f"v={version}"))
        return version

    def upsert(self, updates: DataFrame) -> int:
        """Fold rows into the table; the newest (event, created) of a key wins."""
        view = self.view
        cols = [*view.keys, view.timestamp_field, *([view.created_field] if view.created_field else []), *view.features]
        return self.write(latest_per_key(updates.select(*cols) if self.version() is None else self.read().select(*cols).unionByName(updates.select(*cols)), view))

    def read(self) -> DataFrame:
        """The newest version, known to Spark as bucketed; declared anew where the session has not seen it."""
        version = self.version()
        if version is None:
            raise ValueError(f"nothing is online under {self.root}")
        if not self.spark.catalog.tableExists(self._name(version)):
            about = read_latest(self.spark, os.path.join(self.root, "about")).first()
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(json.loads(about["schema"])).fields)
            keys = ", ".join(f"`{k}`" for k in self.view.keys)
            self.spark.sql(f"CREATE TABLE {self._name(version)} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                           f"INTO {about['buckets']} BUCKETS LOCATION '{self._data(version)}'")
        return self.spark.table(self._name(version))

    def for_requests(self, requests: DataFrame, point_keys: int = POINT_KEYS) -> DataFrame:
        """The table, to be joined with ``requests`` on the key (``views.online_features`` takes it): merged bucket by bucket, and
        scanned for the requests' keys alone where they are at most ``point_keys`` (that many, and one, are looked at here)."""
        keys, table = list(self.view.keys), self.read()
        asked = requests.select(*keys).dropna().distinct().limit(point_keys + 1).collect()
        if len(asked) <= point_keys:
            table = table.filter(_any_of(keys, [tuple(r) for r in asked]))
        return table.hint("merge")


def _any_of(keys: list[str], asked: list[tuple]):
    """Rows whose key is among ``asked``; each key column's own values are stated too, as filters that reach the scan."""
    if not asked:
        return F.lit(False)
    each = F.lit(True)
    for i, k in enumerate(keys):
        each = each & F.col(k).isin(list({a[i] for a in asked}))
    if len(keys) == 1:
        return each
    return each & F.struct(*keys).isin([F.struct(*[F.lit(v).alias(k) for k, v in zip(keys, a)]) for a in asked])

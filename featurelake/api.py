"""User-level entry points shaped like the reference's workflow, backed by the Spark operators.

* ``FeatureStore``: long feature log + catalogue in Parquet (store, get, metadata, list).
* ``FeatureRepo``: feature views and services over source frames (historical
  retrieval, incremental materialisation, online reads, pushes).
* ``QualityValidator``: dataset profile / summary and mean drift.
* ``NetworkAnalyzer``: correlation network and its metrics.

Every method returns DataFrames (or writes Parquet); nothing is collected
except the few scalars an operator documents. Tables are new version folders
or append-only partitions, so readers never see a half-written table.
"""

from __future__ import annotations

import os
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelake.operators import graph as gr
from featurelake.operators import quality as qa
from featurelake.operators import store as st
from featurelake.operators import views as vw
from featurelake.session import written
from featurelake.streaming.store_sink import list_versions, read_committed, read_latest


def _utcnow() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


class FeatureStore:
    """Long-format feature store: ``root/features`` (log, partitioned by event date) and ``root/metadata``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.log_path = os.path.join(root, "features")
        self.meta_path = os.path.join(root, "metadata")

    def store_features(self, df: DataFrame, key: str, features: list[str] | None = None, prefix: str = "",
                       descriptions: dict[str, str] | None = None, event_ts=None) -> None:
        """Append every (entity, numeric feature) cell of ``df``; upsert descriptions (last write wins)."""
        at = event_ts if event_ts is not None else _utcnow()
        st.append_log(st.melt(df, key=key, values=features, prefix=prefix, event_ts=at), self.log_path)
        if descriptions:
            rows = [(n, d, "numeric", at) for n, d in descriptions.items()]
            upd = self.spark.createDataFrame(rows, "feature_name string, description string, data_type string, "
                                                   "created_at timestamp_ntz")
            version = max(list_versions(self.spark, self.meta_path, "v"), default=-1) + 1
            st.metadata_upsert(self.get_feature_metadata(), upd).write.mode("overwrite").parquet(
                os.path.join(self.meta_path, f"v={version}"))

    def log(self) -> DataFrame:
        return self.spark.read.parquet(self.log_path)

    def get_features(self, feature_names: list[str], entities: DataFrame | None = None, as_of=None,
                     keep_missing: bool = False) -> DataFrame:
        """Newest value per entity and feature as one wide row per entity (optionally as of a time)."""
        return st.latest_pivot(self.log(), feature_names, entities=entities,
                               as_of=as_of, keep_missing=keep_missing)

    def get_feature_metadata(self) -> DataFrame | None:
        return read_latest(self.spark, self.meta_path)

    def list_features(self, contains: str | None = None) -> DataFrame:
        return st.list_features(self.log(), self.get_feature_metadata(), contains)


class FeatureRepo:
    """Feature views over source frames, with an online table per view kept in ``root/online/<view>``."""

    def __init__(self, spark: SparkSession, root: str, views: dict, sources: dict[str, DataFrame]):
        self.spark, self.root, self.views, self._given = spark, root, dict(views), dict(sources)

    def _offline_path(self, name: str) -> str:
        return os.path.join(self.root, "offline", name)

    @property
    def sources(self) -> dict[str, DataFrame]:
        """Each view's history: its given source and the rows pushed to it, which are kept under the root."""
        out = {}
        for name, given in self._given.items():
            pushed = read_committed(self.spark, self._offline_path(name), "v")
            out[name] = given if pushed is None else given.unionByName(pushed.select(*given.columns))
        return out

    def mark(self, name: str):
        """The end of the view's last materialisation; NULL before the first. It is kept under the root."""
        row = read_latest(self.spark, os.path.join(self.root, "marks", name))
        return None if row is None else row.first()["end"]

    def _set_mark(self, name: str, end) -> None:
        path = os.path.join(self.root, "marks", name)
        version = max(list_versions(self.spark, path, "v"), default=-1) + 1
        self.spark.range(1).select(F.lit(end).cast("timestamp_ntz").alias("end")).write.mode("overwrite").parquet(os.path.join(path, f"v={version}"))

    def _online_path(self, name: str) -> str:
        return os.path.join(self.root, "online", name)

    def online_table(self, name: str) -> DataFrame | None:
        return read_latest(self.spark, self._online_path(name))

    def _write_online(self, name: str, df: DataFrame) -> None:
        version = max(list_versions(self.spark, self._online_path(name), "v"), default=-1) + 1
        df.write.mode("overwrite").parquet(os.path.join(self._online_path(name), f"v={version}"))

    def _items(self, features):
        if isinstance(features, vw.FeatureService):
            return features.items
        if features and isinstance(features[0], str):
            return vw.parse_refs(list(features), self.views)
        return tuple(features)

    def get_historical_features(self, entity_df: DataFrame, features, as_of=None) -> DataFrame:
        """Point-in-time training rows; ``as_of`` replaces every entity time (batch scoring)."""
        if as_of is not None:
            entity_df = entity_df.withColumn("event_timestamp", F.lit(as_of).cast("timestamp_ntz"))
        return vw.historical_features(entity_df, self.sources, self._items(features))

    def materialize_incremental(self, end_date) -> None:
        """Fold each view's source rows since the last run (up to ``end_date``) into its online table."""
        sources = self.sources
        for name, view in self.views.items():
            if not isinstance(view, vw.FeatureView) or name not in sources:
                continue
            new = vw.materialize_incremental(self.online_table(name), sources[name], view, self.mark(name), end_date)
            self._write_online(name, new)
            self._set_mark(name, end_date)

    def get_online_features(self, entity_rows: DataFrame, features) -> DataFrame:
        online = {n: self.online_table(n) for n, v in self.views.items()
                  if isinstance(v, vw.FeatureView) and self.online_table(n) is not None}
        served = vw.online_features(entity_rows, online, self._items(features))
        if isinstance(features, vw.FeatureService) and features.log_path:
            vw.log_served(served, features.name, _utcnow(), features.log_path)
        return served

    def push(self, view_name: str, rows: DataFrame, to_offline: bool = True, to_online: bool = True) -> None:
        """Push fresh rows: append to the offline source and merge into the online table."""
        view = self.views[view_name]
        if to_offline:
            path = self._offline_path(view_name)
            version = max(list_versions(self.spark, path, "v"), default=-1) + 1
            rows.select(*self._given[view_name].columns).write.mode("overwrite").parquet(os.path.join(path, f"v={version}"))
        if to_online:
            self._write_online(view_name, vw.merge_latest(self.online_table(view_name), rows, view))


class QualityValidator:
    """Dataset profile and summary, and mean drift between two datasets."""

    def __init__(self, spark: SparkSession, report_path: str | None = None):
        self.spark, self.report_path = spark, report_path

    def validate_dataset(self, df: DataFrame, name: str = "dataset", exact: bool = True) -> dict[str, DataFrame]:
        profile = qa.profile(df, name)
        out = {"profile": profile, "schema": qa.schema_rows(df, name), "summary": qa.describe(df, exact=exact)}
        if self.report_path:
            run, at = uuid.uuid4().hex[:8], _utcnow()
            for part, rows in out.items():
                qa.report_rows(rows, at).write.mode("append").parquet(os.path.join(self.report_path, f"dataset={name}", f"part={part}", run))
        return out

    def check_data_drift(self, current: DataFrame, reference: DataFrame, columns: list[str] | None = None,
                         threshold_pct: float = 10.0) -> DataFrame:
        """Per shared numeric column: reference / current means, drift %, flag (one pass over the union)."""
        cols = columns or [c for c in qa.numeric_columns(current) if c in reference.columns]
        both = (reference.select(*cols, F.lit("reference").alias("__period"))
                .unionByName(current.select(*cols, F.lit("current").alias("__period"))))
        return qa.mean_drift(both, "__period", cols=cols, threshold_pct=threshold_pct)


class NetworkAnalyzer:
    """Correlation network of numeric columns and its graph metrics."""

    def build_feature_correlation_network(self, df: DataFrame, threshold: float = 0.5) -> DataFrame:
        return gr.correlation_edges(gr.correlation_matrix(df), threshold)

    def get_network_metrics(self, edges: DataFrame) -> dict[str, DataFrame]:
        e = edges.select("src", "dst")
        return {"summary": gr.summary(e), "clustering": gr.average_clustering(e),
                "components": gr.component_sizes(e), "centrality": gr.degree_centrality(e)}


def run_batch_flow(spark: SparkSession, data: DataFrame, key: str, features: list[str], label: str, store_root: str,
                   train_pct: int = 80, threshold: float = 0.9) -> DataFrame:
    """Entry C: extract -> train -> evaluate -> gate, as four DataFrame steps sharing tables.

    1. extract: the feature columns go into the long feature store (keyed rows, no positions);
    2. train: multinomial logistic regression on the md5 train split;
    3. evaluate: class metrics of the scored test rows (label and prediction on one row);
    4. gate: SUCCESS / WARNING with the reference's thresholds.

    The rows are written once to the shared folder, since each step reads them.
    """
    from pyspark.ml import PipelineModel
    from pyspark.ml.feature import VectorAssembler

    from featurelake.operators import guard
    from featurelake.operators import metrics as mt
    from featurelake.operators import models as ml
    from featurelake.operators import trips as tp

    data, _ = written(data.select(*dict.fromkeys([key, *features, label])), "rows")
    FeatureStore(spark, store_root).store_features(data.select(key, *features), key=key, features=features)
    split = tp.hash_split(data, key, train_pct)
    watch = guard.SchemaGuard(inputCols=features).fit(split)
    assembler = VectorAssembler(inputCols=features, outputCol="features")
    fitted = ml.logistic_regression(assembler.transform(split.filter(F.col("split") == "train")), label=label)
    model = PipelineModel([watch, assembler, fitted])  # what scores refuses a frame of another schema
    # the scored rows still carry the label, so actual and predicted stay on the same row (no re-alignment)
    pred = model.transform(split.filter(F.col("split") == "test"))
    metrics = mt.class_metrics(pred.select(F.col(label).alias("actual"), F.col("prediction").alias("predicted")))
    return mt.gate(metrics, threshold=threshold)

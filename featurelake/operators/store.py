"""Long-format feature log and catalogue.

Log schema: ``entity_id STRING, feature_name STRING, feature_value DOUBLE,
event_ts TIMESTAMP_NTZ, ingest_ts TIMESTAMP_NTZ, seq BIGINT``. The log is
append-only; reads resolve the newest value per (entity, feature) with
``max_by`` so the work is a partial (map-side) aggregate, never a full sort.
Written logs are partitioned by ``event_date`` so time-bounded reads prune files.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelake.functions.columns import nan_to_null
from featurelake.operators.transform import numeric_columns

LOG_COLUMNS = ["entity_id", "feature_name", "feature_value", "event_ts", "ingest_ts", "seq"]
CATALOG_COLUMNS = ["feature_name", "description", "data_type", "created_at"]


def _ts(x) -> Column:
    if isinstance(x, Column):
        return x.cast("timestamp_ntz")
    return F.lit(x).cast("timestamp_ntz")


def melt(df: DataFrame, key: str, values: list[str] | None = None, prefix: str = "",
         event_ts=None, ingest_ts=None, seq: str | None = None) -> DataFrame:
    """Wide rows -> long log rows, one per (entity, numeric feature).

    Entity ids come from a stable business key (``prefix`` + key), never from row
    position; a NaN cell is stored as NULL. ``event_ts``/``ingest_ts`` are a column name, a Column or a literal.
    """
    values = values or numeric_columns(df, exclude=(key,) + ((seq,) if seq else ()))

    def tcol(x):
        return F.col(x).cast("timestamp_ntz") if isinstance(x, str) and x in df.columns else _ts(x)

    ev = tcol(event_ts) if event_ts is not None else F.lit(None).cast("timestamp_ntz")
    ing = tcol(ingest_ts) if ingest_ts is not None else ev
    base = df.select(
        F.concat(F.lit(prefix), F.col(key).cast("string")).alias("entity_id"),
        *[nan_to_null(F.col(v).cast("double")).alias(v) for v in values],
        ev.alias("event_ts"), ing.alias("ingest_ts"),
        (F.col(seq).cast("bigint") if seq else F.lit(0).cast("bigint")).alias("seq"),
    )
    long = base.unpivot(["entity_id", "event_ts", "ingest_ts", "seq"], values, "feature_name", "feature_value")
    return long.select(*LOG_COLUMNS)


def append_log(log: DataFrame, path: str) -> None:
    """Bulk append to the log table, partitioned by event date (replaces per-cell INSERTs).

    Rows are ranged by date and entity first, so a date is written by few tasks (and a large one by several).
    """
    (log.withColumn("event_date", F.to_date("event_ts")).repartitionByRange("event_date", "entity_id")
        .write.mode("append").partitionBy("event_date").parquet(path))


def _select_log(log: DataFrame, features: list[str] | None, entities: DataFrame | None, as_of) -> DataFrame:
    """Feature IN-list (pushed to the scan), entity left-semi join, time bound."""
    if features is not None:
        log = log.filter(F.col("feature_name").isin(list(features)))
    if as_of is not None:
        log = log.filter(F.col("event_ts") <= _ts(as_of))
        if "event_date" in log.columns:  # a written log: the bound prunes its date partitions
            log = log.filter(F.col("event_date") <= F.to_date(_ts(as_of)))
    if entities is not None:  # a semi join needs no distinct: each log row is kept at most once
        ent = entities.select(F.col(entities.columns[0]).cast("string").alias("entity_id"))
        log = log.join(ent, "entity_id", "left_semi")
    return log


def latest_long(log: DataFrame, features: list[str] | None = None, entities: DataFrame | None = None,
                as_of=None, order_by: str = "event") -> DataFrame:
    """Newest non-NULL value per (entity, feature) as long rows.

    ``order_by="event"`` orders by (event_ts, ingest_ts, seq); ``"ingest"``
    reproduces arrival-order semantics (Q3).
    """
    log = _select_log(log, features, entities, as_of)
    order = (F.struct("event_ts", "ingest_ts", "seq") if order_by == "event"
             else F.struct("ingest_ts", "seq"))
    ordering = F.when(F.col("feature_value").isNotNull(), order)
    return log.groupBy("entity_id", "feature_name").agg(
        F.max_by("feature_value", ordering).alias("feature_value"),
        F.max_by("event_ts", ordering).alias("event_ts"))


def latest_pivot(log: DataFrame, features: list[str], entities: DataFrame | None = None, as_of=None,
                 keep_missing: bool = False, order_by: str = "event") -> DataFrame:
    """One row per entity, one column per requested feature, newest non-NULL value.

    Two steps: the newest value per (entity, feature), a partial ``max_by`` whose work does not depend on the number of
    features asked for; then the pivot of that small table, whose values are given.
    Features absent from the log come back as NULL columns. Entities whose
    requested values are all NULL are dropped unless ``keep_missing``.
    """
    features = list(dict.fromkeys(features))
    log = _select_log(log, features, entities, as_of)
    order = (F.struct("event_ts", "ingest_ts", "seq") if order_by == "event"
             else F.struct("ingest_ts", "seq"))
    ordering = F.when(F.col("feature_value").isNotNull(), order)
    newest = log.groupBy("entity_id", "feature_name").agg(F.max_by("feature_value", ordering).alias("v"))
    if not keep_missing:
        newest = newest.filter("v IS NOT NULL")
    wide = newest.groupBy("entity_id").agg(*[F.max(F.when(F.col("feature_name") == f, F.col("v"))).alias(f) for f in features])
    if not keep_missing and features:
        wide = wide.filter(reduce(or_, [F.col(f).isNotNull() for f in features]))
    if keep_missing and entities is not None:
        ent = entities.select(F.col(entities.columns[0]).cast("string").alias("entity_id")).distinct()
        wide = ent.join(wide, "entity_id", "left")
    return wide


def list_features(log: DataFrame, catalog: DataFrame | None = None, contains: str | None = None) -> DataFrame:
    """Distinct feature names, optionally searched by name or description."""
    names = log.select("feature_name").distinct()
    if catalog is not None:
        names = names.join(catalog.select("feature_name", "description"), "feature_name", "left")
    if contains:
        cond = F.lower(F.col("feature_name")).contains(contains.lower())
        if catalog is not None:
            cond = cond | F.lower(F.coalesce(F.col("description"), F.lit(""))).contains(contains.lower())
        names = names.filter(cond)
    return names


def metadata_upsert(catalog: DataFrame | None, updates: DataFrame, order_col: str = "created_at",
                    tie_col: str | None = None) -> DataFrame:
    """Last write wins per ``feature_name``; ``created_at`` is that of the winner."""
    cols = CATALOG_COLUMNS + ([tie_col] if tie_col else [])
    both = updates.select(*cols) if catalog is None else catalog.select(*cols).unionByName(updates.select(*cols))
    order = F.struct(F.col(order_col), F.col(tie_col)) if tie_col else F.col(order_col)
    row = F.struct(*[F.col(c) for c in CATALOG_COLUMNS])
    return both.groupBy("feature_name").agg(F.max_by(row, order).alias("r")).select(
        *[F.col("r." + c).alias(c) for c in CATALOG_COLUMNS])


def describe_stream_features(names: DataFrame, at, keep: tuple[str, ...] = ()) -> DataFrame:
    """T4: catalogue rows for features seen on a stream (``keep`` passes extra columns through)."""
    # Description template and data type used by the reference for streamed features.
    return names.select(
        "feature_name",
        F.concat(F.lit("Real-time updated feature: "), F.col("feature_name")).alias("description"),
        F.lit("numeric").alias("data_type"),
        _ts(at).alias("created_at"),
        *keep)


def feature_counts(log: DataFrame, original: list[str]) -> DataFrame:
    """Number of original, engineered and total features present in a log."""
    names = log.select("feature_name").distinct().withColumn(
        "grp", F.when(F.col("feature_name").isin(list(original)), "original").otherwise("engineered"))
    per = names.groupBy("grp").agg(F.count(F.lit(1)).alias("n_features"))
    total = names.agg(F.count(F.lit(1)).alias("n_features")).select(F.lit("total").alias("grp"), "n_features")
    return per.unionByName(total).withColumnRenamed("grp", "feature_group")


def latest_long_rows(log: DataFrame, order_by: str = "event") -> DataFrame:
    """W1 keeping full log rows: the newest non-NULL row per (entity, feature).

    Used to merge a micro-batch into the latest-value table; a late row with an
    older event time loses to the newer one already there.
    """
    order = (F.struct("event_ts", "ingest_ts", "seq") if order_by == "event"
             else F.struct("ingest_ts", "seq"))
    ordering = F.when(F.col("feature_value").isNotNull(), order)
    row = F.struct("feature_value", "event_ts", "ingest_ts", "seq")
    return (log.groupBy("entity_id", "feature_name").agg(F.max_by(row, ordering).alias("r"))
            .filter(F.col("r").isNotNull())
            .select("entity_id", "feature_name", "r.feature_value", "r.event_ts", "r.ingest_ts", "r.seq"))

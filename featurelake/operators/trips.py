"""Trip preparation, dataset splits and one-hot encoding."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelake.functions.columns import hash_bucket

_UNIT_MICROS = {"minutes": 60_000_000.0, "days": 86_400_000_000.0, "seconds": 1_000_000.0}


def duration(pickup: str, dropoff: str, unit: str = "minutes") -> Column:
    """Elapsed time as a float in ``unit`` (microsecond precision, works on TIMESTAMP_NTZ)."""
    micros = F.expr(f"timestampdiff(MICROSECOND, `{pickup}`, `{dropoff}`)")
    return micros / F.lit(_UNIT_MICROS[unit])


def trip_prep(df: DataFrame, pickup: str, dropoff: str, unit: str = "minutes", lo: float = 1, hi: float = 60,
              ids: tuple[str, str] = ("PULocationID", "DOLocationID"), pair: bool = True,
              numeric: tuple[str, ...] = ("trip_distance",), label: str = "duration") -> DataFrame:
    """Duration, inclusive range filter, ids as strings, pickup_dropoff pair key.

    The duration filter is a plain predicate on the scan output; ids are cast
    after filtering. ``concat`` (not ``concat_ws``) keeps a NULL id NULL.
    """
    d = duration(pickup, dropoff, unit)
    out = df.select(*[F.col(c) for c in ids], *[F.col(c) for c in numeric], F.col(pickup), d.alias(label))
    out = out.filter(F.col(label).between(lo, hi))
    cols = [F.col(c).cast("string").alias(c) for c in ids]
    if pair:
        cols.append(F.concat(F.col(ids[0]).cast("string"), F.lit("_"), F.col(ids[1]).cast("string")).alias("PU_DO"))
    return out.select(*cols, *[F.col(c) for c in numeric], F.col(pickup), F.col(label))


def trip_counts(df: DataFrame, pickup: str, dropoff: str, unit: str = "minutes", lo: float = 1, hi: float = 60) -> DataFrame:
    """A10: rows before and after the duration filter, from one scan."""
    d = duration(pickup, dropoff, unit)
    return df.agg(F.count(F.lit(1)).alias("rows_before"), F.count_if(d.between(lo, hi)).alias("rows_after"))


def temporal_split(df: DataFrame, ts: str, val_from, test_from, name: str = "split") -> DataFrame:
    """M7: train / val / test by time: [.., val_from) / [val_from, test_from) / [test_from, ..). A NULL time is in none (NULL)."""
    t = F.col(ts)
    s = (F.when(t < F.lit(val_from).cast("timestamp_ntz"), "train")
         .when(t < F.lit(test_from).cast("timestamp_ntz"), "val").when(t.isNotNull(), "test"))
    return df.withColumn(name, s)


def hash_split(df: DataFrame, key: str, train_pct: int = 80, name: str = "split") -> DataFrame:
    """M6: repeatable train/test split from the md5 of a stable key (any partitioning, any engine). A NULL key is in neither (NULL)."""
    return df.withColumn(name, F.when(hash_bucket(key, 100) < train_pct, "train").when(F.col(key).isNotNull(), "test"))


def fit_one_hot(train: DataFrame, categorical: list[str], numeric: list[str], output: str = "features") -> PipelineModel:
    """M5 fit: vocabulary per categorical column (alphabetical), one slot per seen value.

    ``handleInvalid="keep"`` on the indexer sends unseen values to the extra last
    index, and ``dropLast=True`` on the encoder drops exactly that slot, so an
    unseen category encodes as all zeros; numerics pass through unchanged.
    The vocabulary is the set of distinct category values, bounded by the
    category domain (not by the row count).
    """
    stages = []
    for c in categorical:
        stages.append(StringIndexer(inputCol=c, outputCol=f"{c}__idx", stringOrderType="alphabetAsc",
                                    handleInvalid="keep"))
        stages.append(OneHotEncoder(inputCol=f"{c}__idx", outputCol=f"{c}__vec", dropLast=True))
    stages.append(VectorAssembler(inputCols=[f"{c}__vec" for c in categorical] + list(numeric), outputCol=output,
                                  handleInvalid="keep"))
    return Pipeline(stages=stages).fit(train)


def active_category(encoded: DataFrame, column: str) -> Column:
    """Index of the active one-hot slot of ``column`` (NULL for an unseen value), from the indexer's column: unseen
    values have the index after the vocabulary's last, which the encoder's vector length names."""
    slots = encoded.schema[f"{column}__vec"].metadata["ml_attr"]["num_attrs"]
    return F.when(F.col(f"{column}__idx") < slots, F.col(f"{column}__idx")).cast("bigint")


def hash_bucket_col(key: str, buckets: int = 100) -> Column:
    """The md5 bucket in [0, buckets) used by ``hash_split`` (for further deterministic splits)."""
    return hash_bucket(key, buckets)


def trip_prep_observed(df: DataFrame, pickup: str, dropoff: str, name: str = "trip_counts", **kw):
    """A10 without a second scan: (prepared frame, Observation).

    The row counts before and after the duration filter are collected by
    ``observe`` while the prepared frame is written (or otherwise consumed);
    read them with ``obs.get`` after that action.
    """
    from pyspark.sql import Observation

    obs_in, obs_out = Observation(name + "_before"), Observation(name + "_after")
    src = df.observe(obs_in, F.count(F.lit(1)).alias("rows_before"))
    out = trip_prep(src, pickup, dropoff, **kw).observe(obs_out, F.count(F.lit(1)).alias("rows_after"))
    return out, (obs_in, obs_out)

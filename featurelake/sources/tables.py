"""Readers and writers for the Parquet tables the operators work on.

Reads go through ``spark.read.parquet`` so Catalyst prunes columns and pushes
filters into the scan; nothing here materialises data.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Give a scan at least the session's parallelism in partitions.

    A table stored as a few large row groups is read by as many tasks as it has
    row groups, and everything pipelined behind the scan (projections, broadcast
    joins, partial aggregates) runs in those few tasks. When the scan has fewer
    partitions than the default parallelism, rows are redistributed round-robin;
    otherwise (the normal case on a cluster reading many files) the frame is
    returned unchanged and no shuffle is added. Filters and column pruning still
    reach the scan below the repartition. For scans and projections of scans only:
    asking a shuffled frame for its partitions would run the stages before them.
    """
    want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= want:
        return df
    return df.repartition(want)


def table(spark: SparkSession, sf_dir: str, name: str, schema: T.StructType | None = None,
          balance: bool = False) -> DataFrame:
    """Read one of the given tables. ``schema`` skips footer inference on wide deployments.

    ``balance`` applies ``spread``; CPU-heavy operators call ``spread`` themselves
    on their (already projected) input instead, so cheap scans pay no shuffle.
    """
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return spread(df) if balance else df


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> str:
    """Bulk columnar write (S7/S12): one file set per partition value, no per-row inserts."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV export with a header row (S11: the catalogue export)."""
    df.write.mode(mode).option("header", True).csv(path)
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.option("header", True).schema(schema).csv(path)

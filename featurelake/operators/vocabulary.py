"""One-hot encoding with vocabularies kept as tables (M5, S12): no category value ever reaches the driver.

A vocabulary is a table (value, index): the distinct values of a column in alphabetical order, numbered densely from 0. The numbers are made
in executors: values are dealt out by ranges and sorted, a value has a place in its range, and a running sum over the ranges' counts
(one number per range) says where each begins. Encoding joins a frame with the table, and Spark ML builds sparse vectors from the indexes; the
driver knows each vocabulary's size and nothing else. Use ``trips.fit_one_hot`` where a vocabulary surely fits into one pipeline stage.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelake.session import discard, written


#: Bits of a row's place within its partition in Spark's monotonically increasing ids; the partition's number is above them.
_PLACE_BITS = 33


def numbered(values: DataFrame, column: str) -> tuple[DataFrame, int, str]:
    """((value, index), size, path): the distinct non-NULL values of ``column`` numbered from 0 in their order, their number, and the
    working table below. The values are sorted once; the driver sees a count per range."""
    spark = values.sparkSession
    ranges = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    distinct = values.select(F.col(f"`{column}`").alias("value")).filter("value IS NOT NULL").distinct()
    place = F.monotonically_increasing_id()  # of sorted ranges: the range's number, and the place in it
    table, path = written(distinct.repartitionByRange(ranges, "value").sortWithinPartitions("value").withColumn("place", place), "values")
    part = F.shiftright("place", _PLACE_BITS)
    counts = sorted((r["part"], r["n"]) for r in table.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect())
    begins, size = [], 0
    for k, n in counts:
        begins.append((k, size - (k << _PLACE_BITS)))
        size += n
    shift = spark.createDataFrame(begins, "part bigint, shift bigint")
    index = F.col("place") + F.col("shift")
    return table.withColumn("part", part).join(F.broadcast(shift), "part").select("value", index.alias("index")), size, path


@dataclass(frozen=True)
class OneHotTables:
    """Fitted vocabularies under ``root/<column number>``; ``sizes`` are their lengths."""

    root: str
    columns: tuple[str, ...]
    sizes: tuple[int, ...]

    @staticmethod
    def fit(train: DataFrame, columns: list[str], root: str) -> OneHotTables:
        """Write each column's vocabulary, then what ``load`` needs to find them."""
        spark, sizes = train.sparkSession, []
        for i, c in enumerate(columns):
            table, size, path = numbered(train, c)
            table.write.mode("overwrite").parquet(os.path.join(root, str(i)))
            discard(spark, path)
            sizes.append(size)
        about = spark.createDataFrame(list(zip(range(len(columns)), columns, sizes)), "place int, name string, size bigint")
        about.coalesce(1).write.mode("overwrite").parquet(os.path.join(root, "about"))
        return OneHotTables(root, tuple(columns), tuple(sizes))

    @staticmethod
    def load(spark: SparkSession, root: str) -> OneHotTables:
        rows = spark.read.parquet(os.path.join(root, "about")).orderBy("place").collect()
        return OneHotTables(root, tuple(r["name"] for r in rows), tuple(r["size"] for r in rows))

    def table(self, spark: SparkSession, column: str) -> DataFrame:
        return spark.read.parquet(os.path.join(self.root, str(self.columns.index(column))))

    def indexed(self, df: DataFrame, suffix: str = "__idx") -> DataFrame:
        """df and ``<column>__idx`` per column: the value's number, NULL for NULL and for a value that was not seen."""
        for i, c in enumerate(self.columns):
            vocabulary = self.table(df.sparkSession, c).select(F.col("value").alias(f"__value{i}"), F.col("index").alias(c + suffix))
            df = df.join(vocabulary, F.col(f"`{c}`") == F.col(f"__value{i}"), "left").drop(f"__value{i}")
        return df

    def transform(self, df: DataFrame, numeric: list[str] | None = None, output: str = "features") -> DataFrame:
        """df and ``output``: a sparse vector of one slot per seen value of each column, then the ``numeric`` columns as they are.

        A value that was not seen, or NULL, has zeros in all slots of its column. NULL numbers become NaN.
        """
        df, vectors = self.indexed(df), []
        for c, n in zip(self.columns, self.sizes):
            # the slot after the last stands for what was not seen; the encoder drops it
            df = df.withColumn(f"{c}__slot", F.coalesce(F.col(f"{c}__idx"), F.lit(n)).cast("double"))
            df = df.withMetadata(f"{c}__slot", {"ml_attr": {"type": "nominal", "num_vals": n + 1}})
            df = OneHotEncoder(inputCol=f"{c}__slot", outputCol=f"{c}__vec", dropLast=True).fit(df).transform(df)
            vectors.append(f"{c}__vec")
        out = VectorAssembler(inputCols=vectors + list(numeric or []), outputCol=output, handleInvalid="keep").transform(df)
        return out.drop(*vectors, *[f"{c}__slot" for c in self.columns])

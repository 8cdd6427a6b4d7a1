"""Null-safe scalar expressions used across the operators."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x) -> Column:
    """NaN -> NULL so every aggregate skips it (NaN compares greater than all numbers in Spark)."""
    c = _c(x)
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c.cast("double"))


def safe_div(a, b) -> Column:
    """a / b, NULL when b is 0 or NULL (plain ``/`` raises under ANSI mode)."""
    return F.try_divide(_c(a).cast("double"), _c(b).cast("double"))


def safe_log1p(x) -> Column:
    """ln(x + 1), NULL outside the domain x > -1."""
    c = _c(x).cast("double")
    return F.when(c > -1, F.log1p(c))


def row_sum(cols, skip_nulls: bool = False) -> Column:
    """Row-wise sum. ``skip_nulls=False`` propagates NULL like ``a + b + c``."""
    cs = [_c(c).cast("double") for c in cols]
    if skip_nulls:
        return reduce(add, [F.coalesce(c, F.lit(0.0)) for c in cs])
    return reduce(add, cs)


def row_mean(cols, skip_nulls: bool = False) -> Column:
    cs = [_c(c).cast("double") for c in cols]
    if not skip_nulls:
        return row_sum(cs) / F.lit(float(len(cs)))
    n = reduce(add, [F.when(c.isNotNull(), 1).otherwise(0) for c in cs])
    return F.try_divide(row_sum(cs, skip_nulls=True), n.cast("double"))


def hash_bucket(key, buckets: int = 100) -> Column:
    """Deterministic bucket in [0, buckets) from the md5 of a key.

    Repeatable under any partitioning and on any engine that has md5, unlike
    ``randomSplit`` whose result depends on partition layout.
    """
    h = F.conv(F.substring(F.md5(_c(key).cast("string")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(h, F.lit(buckets))


def _bits(digits: int) -> int:
    return int(math.ceil(digits * math.log2(10)))


def quantize(c, digits: int = 6) -> Column:
    """Round to a multiple of 2^-b with 2^-b just below 10^-digits: ``round(x * 2^b) / 2^b``.

    Scaling by a power of two is exact, so engines that differ only in the last
    bits of a sum agree after this unless the value sits within that noise of a
    multiple of 2^-b. Unlike decimal rounding, values that are exact decimal
    halves (means of decimal data often are) are not ties here.
    """
    scale = F.lit(float(2 ** _bits(digits)))
    return F.round(_c(c).cast("double") * scale) / scale


def rounded(df: DataFrame, digits: int = 6, cols: list[str] | None = None) -> DataFrame:
    """Quantize floating columns (all, or ``cols``) where engines may differ in the last bits.

    Only results of transcendental functions and of order-dependent aggregates
    need this; exact IEEE arithmetic (+, -, *, /) is left untouched.
    """
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (cols is None or f.name in cols):
            out.append(quantize(f.name, digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def literal_frame(spark, rows: list[tuple], schema: T.StructType | str) -> DataFrame:
    """A small DataFrame from driver-side values (summaries, trial tables), built JVM-side.

    The rows become literals of one exploded array, so no Python worker is
    started; meant for results whose size is bounded by parameters or columns.
    """
    if isinstance(schema, str):
        schema = spark.createDataFrame([], schema).schema
    if not rows:
        return spark.createDataFrame([], schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(r, schema.fields)]) for r in rows]
    return spark.range(1).select(F.explode(F.array(*structs)).alias("r")).select("r.*")

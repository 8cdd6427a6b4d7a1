"""Row-level feature engineering.

All functions are narrow projections: no shuffle, one ``select`` each, so
Catalyst collapses them into the scan's whole-stage-codegen span.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelake.functions.columns import nan_to_null, row_mean, row_sum, safe_div

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)

# (prefix, length column, width column) pairs of the default measurement layout.
DEFAULT_PAIRS = (("sepal", "sepal_length", "sepal_width"), ("petal", "petal_length", "petal_width"))


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] = ()) -> list[str]:
    """Names of numeric columns; vectors, strings and timestamps are skipped."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def engineered_columns(pairs=DEFAULT_PAIRS) -> dict[str, Column]:
    """The ten engineered features as named column expressions.

    The same expressions serve the batch path and the streaming path (E7).
    """
    out: dict[str, Column] = {}
    for prefix, length, width in pairs:
        out[f"{prefix}_area"] = F.col(length) * F.col(width)
    for prefix, length, width in pairs:
        out[f"{prefix}_length_to_width_ratio"] = safe_div(length, width)
    for _, length, _ in pairs:
        c = F.col(length).cast("double")
        out[f"log_{length}"] = F.when(c > -1, F.ln(c + F.lit(1.0)))
    for _, length, _ in pairs:
        out[f"{length}_squared"] = F.col(length) * F.col(length)
    base = [c for _, length, width in pairs for c in (length, width)]
    out["feature_sum"] = row_sum(base)
    out["feature_mean"] = row_mean(base)
    return out


def engineer_features(df: DataFrame, pairs=DEFAULT_PAIRS) -> DataFrame:
    """Interaction, ratio, log, square, row sum and mean, in one projection."""
    exprs = engineered_columns(pairs)
    keep = [F.col(c) for c in df.columns if c not in exprs]
    return df.select(*keep, *[e.alias(n) for n, e in exprs.items()])


def row_stats(df: DataFrame, cols: list[str] | None = None, include_all: bool = False,
              sum_name: str = "feature_sum", mean_name: str = "feature_mean") -> DataFrame:
    """Row sum and mean that skip NULL and NaN.

    ``cols`` defaults to every numeric column. ``include_all=True`` reproduces the
    reference's sequential behaviour where the mean also averages the new sum.
    """
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    cols = [nan_to_null(c) if c in floating else c for c in cols or numeric_columns(df, exclude=(sum_name, mean_name))]
    s = row_sum(cols, skip_nulls=True)
    mean_cols = [*cols, s] if include_all else cols
    m = row_mean(mean_cols, skip_nulls=True)
    keep = [F.col(c) for c in df.columns if c not in (sum_name, mean_name)]
    return df.select(*keep, s.alias(sum_name), m.alias(mean_name))


def clean_name(name: str) -> str:
    """S3's name rule: drop the ' (cm)' unit suffix, spaces become underscores."""
    return name.replace(" (cm)", "").replace(" ", "_")


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def align_schema(df: DataFrame, want: list[str], fill: float = 0.0, keep: tuple[str, ...] = ()) -> DataFrame:
    """Keep ``want`` in order, add missing columns as ``fill``, drop the rest.

    ``keep`` names pass-through columns (keys, times) placed before the features.
    """
    have = set(df.columns)
    return df.select(*[F.col(c) for c in keep],
                     *[F.col(c) if c in have else F.lit(fill).cast("double").alias(c) for c in want])


def schema_diff(df: DataFrame, expected: T.StructType) -> list[str]:
    """Human-readable differences between a frame and a stored training schema."""
    got = {f.name: f.dataType for f in df.schema.fields}
    want = {f.name: f.dataType for f in expected.fields}
    diffs = [f"missing column {n}" for n in want if n not in got]
    diffs += [f"extra column {n}" for n in got if n not in want]
    diffs += [f"type of {n}: {got[n].simpleString()} != {want[n].simpleString()}"
              for n in want if n in got and got[n] != want[n]]
    return diffs


def check_schema(df: DataFrame, expected: T.StructType | str) -> DataFrame:
    """Raise when ``df`` does not carry the expected columns and types; else return it."""
    if isinstance(expected, str):
        expected = T.StructType.fromJson(json.loads(expected))
    problems = [d for d in schema_diff(df, expected) if not d.startswith("extra")]
    if problems:
        raise ValueError("schema check failed: " + "; ".join(problems))
    return df


def feature_map(df: DataFrame, exclude: tuple[str, ...] = ("target", "prediction"), name: str = "features") -> Column:
    """P20: numeric columns (minus target/prediction) as a name->value map without NULLs."""
    cols = numeric_columns(df, exclude=exclude)
    m = F.map_from_arrays(F.array(*[F.lit(c) for c in cols]), F.array(*[F.col(c).cast("double") for c in cols]))
    return F.map_filter(m, lambda k, v: v.isNotNull()).alias(name)


def residuals(predictions: DataFrame, actuals: DataFrame, key: str = "entity_id",
              pred_col: str = "predicted", actual_col: str = "actual") -> DataFrame:
    """Align predictions with actuals by key (never by position) and add the difference."""
    j = predictions.join(actuals, key, "inner")
    return j.select(key, F.col(actual_col), F.col(pred_col), (F.col(pred_col) - F.col(actual_col)).alias("difference"))


def vector_to_array_col(name: str) -> Column:
    """unwrap an ML vector column into an array<double> (for storage or per-element access)."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(F.col(name))

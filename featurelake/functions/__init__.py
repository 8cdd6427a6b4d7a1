"""Column-level helpers. Everything here returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from featurelake.functions.columns import (  # noqa: F401
    hash_bucket,
    literal_frame,
    nan_to_null,
    quantize,
    row_mean,
    row_sum,
    safe_div,
    safe_log1p,
    rounded,
)

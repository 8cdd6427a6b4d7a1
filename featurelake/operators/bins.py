"""Forests over many rows: rows that fall into the same bins of all features are fitted as one row with a weight.

Spark's trees cut each feature into at most ``maxBins`` bins before they look at a split, so no split tells rows of one such cell
apart, and n rows gain as much by a split as their mean with the weight n. Above ``ROWS`` rows, each cell is dealt into
shares, as many as make about ``ROWS`` rows in all, and a share is one row: its mean label, its number of rows as weight. Every row counts in a
share; the bootstrap draws shares, where a forest of fewer rows draws rows. The bounds on a leaf's rows become bounds on its weight. The size of
the fit then does not grow with the table.
"""

from __future__ import annotations

from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.session import written

#: Rows that a forest is fitted on one by one, and about the shares that more rows are dealt into.
ROWS = 1 << 18
#: Spark's own number of bins.
MAX_BINS = 32


class Bins(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A vector's values as the numbers of their bins: how many of a feature's thresholds are at most the value."""

    thresholds = Param(Params._dummy(), "thresholds", "ascending thresholds of each feature", typeConverter=TypeConverters.identity)

    @keyword_only
    def __init__(self, *, inputCol: str | None = None, outputCol: str | None = None, thresholds: list[list[float]] | None = None):  # noqa: N803
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        values = vector_to_array(F.col(self.getInputCol()))
        numbers = [reduce(lambda a, b: a + b, [(values[i] >= F.lit(t)).cast("double") for t in ts], F.lit(0.0))
                   for i, ts in enumerate(self.getOrDefault(self.thresholds))]
        return dataset.withColumn(self.getOutputCol(), array_to_vector(F.array(*numbers)))


def fit_bins(frame: DataFrame, features: str, output: str, max_bins: int = MAX_BINS) -> Bins:
    """Bins of about equal numbers of rows; where a feature has few values, one bin for each."""
    width = len(frame.select(features).first()[0])
    values = vector_to_array(F.col(features))
    split = frame.select(*[values[i].alias(f"v{i}") for i in range(width)])
    steps = 8 * max_bins
    thresholds = []
    for at in split.approxQuantile(split.columns, [k / steps for k in range(steps + 1)], 0.25 / steps):
        distinct = sorted(set(at))
        few = len(distinct) <= max_bins
        thresholds.append([(a + b) / 2 for a, b in zip(distinct, distinct[1:])] if few else sorted(set(at[8:-1:8])))
    return Bins(inputCol=features, outputCol=output, thresholds=thresholds)


def has_categories(frame: DataFrame, features: str) -> bool:
    """Whether the vector's attributes name categorical features; those are not put into ordered bins."""
    attrs = frame.schema[features].metadata.get("ml_attr", {}).get("attrs", {})
    return bool(attrs.get("nominal") or attrs.get("binary"))


def cells(frame: DataFrame, bins: Bins, label: str, shares: int = 1, seed: int = 0, by: list[str] | None = None) -> DataFrame:
    """(by..., bins, label, weight, within): the rows of each cell, dealt into ``shares``: mean label, rows, squares about that mean."""
    out = bins.getOutputCol()
    share = F.floor(F.rand(seed) * shares).cast("int") if shares > 1 else F.lit(0)
    rows = bins.transform(frame.filter(F.col(label).isNotNull())).select(
        *(by or []), vector_to_array(F.col(out)).alias("cell__"), share.alias("share__"), F.col(label).cast("double").alias("y__"))
    y = F.col("y__")
    grouped = rows.groupBy(*(by or []), "cell__", "share__").agg(F.avg(y).alias(label), F.count(F.lit(1)).cast("double").alias("weight"), F.var_pop(y).alias("spread__"))
    return grouped.select(*(by or []), array_to_vector(F.col("cell__")).alias(out), label, "weight", (F.col("spread__") * F.col("weight")).alias("within"))


def condensed(frame: DataFrame, features: str, label: str, rows: int = ROWS, seed: int = 0) -> tuple[Bins, DataFrame, int] | None:
    """(bins, a written table of weighted shares, number of rows), or None where the frame has at most ``rows`` rows or names categories."""
    if has_categories(frame, features):
        return None
    n = frame.filter(F.col(label).isNotNull()).count()
    if n <= rows:
        return None
    bins = fit_bins(frame, features, f"{features}__bins")
    n_cells = bins.transform(frame).agg(F.approx_count_distinct(vector_to_array(F.col(bins.getOutputCol())))).first()[0]
    table, _ = written(cells(frame, bins, label, max(1, rows // max(1, n_cells)), seed), "cells")
    return bins, table, n


def weighted(forest, bins: Bins, n: int):
    """The estimator set to fit ``n`` rows' shares: a leaf's least number of rows as a share of all weight."""
    leaf = forest.getMinInstancesPerNode()
    return forest.setFeaturesCol(bins.getOutputCol()).setWeightCol("weight").setMinInstancesPerNode(1).setMinWeightFractionPerNode(
        (leaf - 0.5) / n if leaf > 1 else 0.0)

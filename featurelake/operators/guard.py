"""Schemas that are kept, and checked before anything is scored.

* ``SchemaGuard`` is a pipeline stage that learns its input columns' types at fit time. Its model, ``SchemaGuardModel``, is saved with the
  pipeline and refuses a frame whose columns are missing or of another type, before any later stage sees it. The check looks at the plan's
  schema only: it costs no job and adds nothing to the plan.
* ``SchemaHistory`` keeps, per dataset and run, each column's place and type and how many rows it fills, as an append-only table.
  ``changes`` compares every run with the one before it in one window pass.
"""

from __future__ import annotations

import json
import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelake.operators.transform import schema_diff
from featurelake.streaming.store_sink import list_versions, read_committed


class SchemaDrift(ValueError):
    """A frame does not carry the columns and types that a model was fitted on."""

    def __init__(self, problems: list[str]):
        super().__init__("schema check failed: " + "; ".join(problems))
        self.problems = problems


class _Policy(Params):
    allowWidening = Param(Params._dummy(), "allowWidening", "accept numbers that fit into the expected type without loss, and cast them",
                          TypeConverters.toBoolean)
    expected = Param(Params._dummy(), "expected", "the learned columns and types, as a JSON schema", TypeConverters.toString)


class SchemaGuard(Estimator, HasInputCols, _Policy, DefaultParamsReadable, DefaultParamsWritable):
    """First stage of a pipeline: learns the types of ``inputCols`` from the frame it is fitted on."""

    @keyword_only
    def __init__(self, *, inputCols: list[str] | None = None, allowWidening: bool = False):  # noqa: N803 - Spark ML's style
        super().__init__()
        self._setDefault(allowWidening=False)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> SchemaGuardModel:
        missing = [c for c in self.getInputCols() if c not in dataset.columns]
        if missing:
            raise SchemaDrift([f"missing column {c}" for c in missing])
        learned = T.StructType([T.StructField(c, dataset.schema[c].dataType) for c in self.getInputCols()])
        return SchemaGuardModel()._set(inputCols=self.getInputCols(), allowWidening=self.getOrDefault("allowWidening"), expected=learned.json())


#: Numeric types from narrow to wide; each fits into those after it without loss.
_WIDENING = (("tinyint", "smallint", "int", "bigint"), ("tinyint", "smallint", "int", "double"), ("float", "double"))


def widens(got: T.DataType, want: T.DataType) -> bool:
    a, b = got.simpleString(), want.simpleString()
    return any(a in chain and b in chain and chain.index(a) < chain.index(b) for chain in _WIDENING)


class SchemaGuardModel(Model, HasInputCols, _Policy, DefaultParamsReadable, DefaultParamsWritable):
    """Returns the frame as it is, or raises ``SchemaDrift``. Extra columns pass. Persisted with its pipeline."""

    def __init__(self):
        super().__init__()
        self._setDefault(allowWidening=False)

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.getOrDefault("expected")))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        types = {f.name: f.dataType for f in dataset.schema.fields}
        cast = {}
        if self.getOrDefault("allowWidening"):
            cast = {f.name: f.dataType for f in self.schema.fields if f.name in types and widens(types[f.name], f.dataType)}
        checked = dataset.select(*[F.col(f"`{c}`").cast(cast[c]).alias(c) if c in cast else F.col(f"`{c}`") for c in dataset.columns]) if cast else dataset
        problems = [d for d in schema_diff(checked, self.schema) if not d.startswith("extra")]
        if problems:
            raise SchemaDrift(problems)
        return checked


def guarded(stages: list, cols: list[str], allow_widening: bool = False) -> Pipeline:
    """The stages behind a guard of their input columns."""
    return Pipeline(stages=[SchemaGuard(inputCols=list(cols), allowWidening=allow_widening), *stages])


HISTORY = "dataset string, run bigint, recorded_at timestamp_ntz, position int, column_name string, data_type string, n_rows bigint, n_filled bigint"


def schema_profile(df: DataFrame, dataset: str, run: int, recorded_at) -> DataFrame:
    """One row per column of ``df``: place, type, rows, and rows in which it is not NULL; one aggregate pass."""
    counted = df.agg(F.count(F.lit(1)).alias("n"), F.array(*[F.count(F.col(f"`{c}`")) for c in df.columns]).alias("filled")) if df.columns else \
        df.agg(F.count(F.lit(1)).alias("n"), F.array().cast("array<bigint>").alias("filled"))
    told = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"))
                     for i, f in enumerate(df.schema.fields)]) if df.columns else F.array().cast("array<struct<position:int,column_name:string,data_type:string>>")
    rows = counted.select("n", "filled", F.explode(told).alias("c"))
    return rows.select(F.lit(dataset).alias("dataset"), F.lit(run).cast("bigint").alias("run"), F.lit(recorded_at).cast("timestamp_ntz").alias("recorded_at"),
                       "c.position", "c.column_name", "c.data_type", F.col("n").alias("n_rows"), F.col("filled")[F.col("c.position")].alias("n_filled"))


def changes(history: DataFrame) -> DataFrame:
    """(dataset, run, column_name, change, type_before, type_after, filled_before, filled_after) of every run against the one before it.

    ``change`` is added, removed, retyped, emptied (a column that had values has none) or filled (the other way). A dataset's first run changes nothing.
    A column's runs meet by (dataset, column), the runs of a dataset are few rows; nothing is read but the history.
    """
    runs = history.select("dataset", "run").distinct().withColumn(
        "previous", F.lag("run").over(Window.partitionBy("dataset").orderBy("run")))
    now = history.join(runs, ["dataset", "run"]).select("dataset", "column_name", "run", "previous", "data_type", "n_filled")
    follows = runs.filter("previous IS NOT NULL").select("dataset", F.col("previous").alias("run"), F.col("run").alias("next"))
    before = history.join(follows, ["dataset", "run"]).select(
        "dataset", "column_name", F.col("next").alias("run"), F.col("data_type").alias("type_before"), F.col("n_filled").alias("filled_before"))
    both = now.filter("previous IS NOT NULL").join(before, ["dataset", "column_name", "run"], "full")
    change = (F.when(F.col("type_before").isNull(), "added").when(F.col("data_type").isNull(), "removed").when(F.col("data_type") != F.col("type_before"), "retyped")
              .when((F.col("filled_before") > 0) & (F.col("n_filled") == 0), "emptied").when((F.col("filled_before") == 0) & (F.col("n_filled") > 0), "filled"))
    return both.select("dataset", "run", "column_name", change.alias("change"), "type_before", F.col("data_type").alias("type_after"),
                       "filled_before", F.col("n_filled").alias("filled_after")).filter("change IS NOT NULL")


class SchemaHistory:
    """Each dataset's schemas under ``root/<dataset>/run=N``; a run is one folder, committed or invisible."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def record(self, df: DataFrame, dataset: str, recorded_at) -> DataFrame:
        """Keep the frame's schema as the dataset's next run, and return what changed since the last one."""
        path = os.path.join(self.root, dataset)
        run = max(list_versions(self.spark, path, "run"), default=-1) + 1
        schema_profile(df, dataset, run, recorded_at).drop("dataset", "run").write.mode("overwrite").parquet(os.path.join(path, f"run={run}"))
        return changes(self.history(dataset).filter(F.col("run") >= run - 1))

    def history(self, dataset: str) -> DataFrame:
        kept = read_committed(self.spark, os.path.join(self.root, dataset), "run")
        if kept is None:
            return self.spark.createDataFrame([], HISTORY)
        return kept.select(F.lit(dataset).alias("dataset"), F.col("run").cast("bigint").alias("run"), "recorded_at", "position", "column_name", "data_type",
                           "n_rows", "n_filled")

    def check(self, df: DataFrame, dataset: str) -> DataFrame:
        """The frame, if it carries the columns and types of the dataset's last run; else ``SchemaDrift``."""
        last = self.history(dataset)
        rows = last.filter(F.col("run") == last.agg(F.max("run")).first()[0]).orderBy("position").collect()  # one row per column
        got = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        problems = [f"missing column {r['column_name']}" if r["column_name"] not in got else f"type of {r['column_name']}: {got[r['column_name']]} != {r['data_type']}"
                    for r in rows if got.get(r["column_name"]) != r["data_type"]]
        if problems:
            raise SchemaDrift(problems)
        return df

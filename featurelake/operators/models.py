"""Model fit / score / evaluate / select with Spark ML.

Estimators are the distributed Spark ML ones (tree aggregation over
partitions). Models are saved and loaded with the ML writers, so a scoring
job can run far from the training job. Hyper-parameter search samples a
parameter grid with a fixed seed and reads many candidates off one forest
(``operators.search``).
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.operators import bins as bn
from featurelake.operators import search
from featurelake.operators.search import MAX_DEPTH
from featurelake.session import scratch_dir

NORMAL_WIDTH = 4096


def feature_pipeline(cols: list[str], k: int | None = None, with_pca: bool = True) -> Pipeline:
    """M1–M4: assemble, standardise (mean 0, sample std 1), optional PCA with k = min(10, #features).

    NULL inputs are rejected by the assembler (``handleInvalid="error"``): impute or
    filter first, nothing is dropped silently.
    """
    stages = [VectorAssembler(inputCols=cols, outputCol="features_vector", handleInvalid="error"),
              StandardScaler(inputCol="features_vector", outputCol="scaled_features", withMean=True, withStd=True)]
    if with_pca:
        stages.append(PCA(inputCol="scaled_features", outputCol="pca_features", k=k or min(10, len(cols))))
    return Pipeline(stages=stages)


def scaled_columns(model_out: DataFrame, cols: list[str], vec: str = "scaled_features", suffix: str = "_scaled") -> DataFrame:
    arr = vector_to_array(F.col(vec))
    return model_out.select(*[arr[i].alias(c + suffix) for i, c in enumerate(cols)])


def logistic_regression(train: DataFrame, features: str = "features", label: str = "label", c: float = 1.0,
                        max_iter: int = 1000) -> PipelineModel:
    """M8: multinomial logistic regression, L2 strength 1/(C n) like the reference's default C = 1."""
    n = train.count()
    lr = LogisticRegression(featuresCol=features, labelCol=label, family="multinomial", maxIter=max_iter,
                            regParam=1.0 / (c * max(n, 1)), elasticNetParam=0.0, standardization=False)
    model = Pipeline(stages=[lr]).fit(train)
    if model.stages[0].numClasses == 2:
        # Spark's summary of two classes holds the session, which cannot be sent to tasks once a frame was observed in it; a loaded model has none.
        model = load(save(model, scratch_dir(train.sparkSession, "logistic")))
    return model


def linear_regression(train: DataFrame, features: str = "features", label: str = "label") -> PipelineModel:
    """M9: ordinary least squares with intercept (no penalty). Normal equations up to ``NORMAL_WIDTH`` features, beyond
    that L-BFGS to a tight tolerance: one-hot pairs can be far wider than a matrix on one machine."""
    first = train.select(features).first()
    wide = first is not None and len(first[0]) > NORMAL_WIDTH
    return Pipeline(stages=[LinearRegression(featuresCol=features, labelCol=label, regParam=0.0, maxIter=1000 if wide else 100,
                                             tol=1e-9 if wide else 1e-6, solver="l-bfgs" if wide else "normal")]).fit(train)


def random_forest(train: DataFrame, features: str = "features", label: str = "label", num_trees: int = 20,
                  max_depth: int = 10, min_instances: int = 1, subset: str = "auto", seed: int = 0, rows: int = bn.ROWS) -> PipelineModel:
    """Random-forest regression. Spark's trees have a depth of 30 at most; a larger one raises.

    More than ``rows`` rows are fitted as weighted shares of equal bins (``operators.bins``), which the model's first stage makes.
    """
    if max_depth > MAX_DEPTH:
        raise ValueError(f"max_depth={max_depth}: Spark's trees are at most {MAX_DEPTH} deep")
    rf = RandomForestRegressor(featuresCol=features, labelCol=label, numTrees=num_trees, maxDepth=max_depth,
                               minInstancesPerNode=min_instances, featureSubsetStrategy=subset, seed=seed)
    found = bn.condensed(train, features, label, rows, seed)
    if found is None:
        return Pipeline(stages=[rf]).fit(train)
    bins, shares, n = found
    return PipelineModel([bins, bn.weighted(rf, bins, n).fit(shares)])


def rmse(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> float:
    return RegressionEvaluator(labelCol=label, predictionCol=prediction, metricName="rmse").evaluate(pred)


def hyper_search(train: DataFrame, features: str = "features", label: str = "label", trials: int = 15,
                 depth=(1, 20), trees=(10, 50), leaf=(1, 4), subsets=("auto",), seed: int = 42, key: str | None = None) -> DataFrame:
    """M12 (re-aimed): a seeded sample of a forest grid, all trials read off one forest per (leaf, subset); see ``operators.search``.

    ``subsets`` are Spark's feature-subset strategies (the share of features a split looks at). Spark has no minimum size
    of a node to be split; ``leaf`` bounds the rows of its children instead. A depth beyond 30 raises.
    Returns one row per trial: its parameters and validation RMSE, best first.
    """
    return search.search(train, search.sample_trials(trials, depth, trees, leaf, subsets, seed), features, label, seed, key)


def save(model: PipelineModel, path: str) -> str:
    """Persist a fitted pipeline (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def retrain_and_select(trials: DataFrame, train: DataFrame, val: DataFrame, test: DataFrame, top: int = 5,
                       features: str = "features", label: str = "label", select_on: str = "val_rmse",
                       seed: int = 42) -> DataFrame:
    """Refit the ``top`` best trials, score them on validation and test, rank by ``select_on``.

    The reference picks on the test split; ``select_on`` makes that a choice
    (validation by default). Returns one row per candidate, best first.
    """
    return search.select(trials, train, val, test, top, features, label, select_on, seed)

"""Search over random forests with few fits.

A forest's first k trees are a forest of k trees, and a tree cut at depth d is the tree that stops growing at d: a split
does not depend on what is grown below it, and Spark keeps every inner node's prediction. So trials that agree in the
minimum of rows a leaf and in the share of features need one fit, of their largest depth and tree count, and one pass over
the validation rows gives the errors of all trials: each row walks down each tree once, and running sums over the
trees are read off at the depths and counts that trials ask for.

The driver sends the trees to the tasks, as scoring with Spark's own model does; their size is that of the models. Rows
are read as numeric or two-valued features; a split over more categories raises.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.functions.columns import hash_bucket, literal_frame
from featurelake.operators import bins as bn
from featurelake.session import checkpoint_dir, discard, scratch_dir

MAX_DEPTH = 30
TRIALS = "trial int, max_depth int, num_trees int, min_instances int, subset string"


@dataclass(frozen=True)
class Trial:
    trial: int
    max_depth: int
    num_trees: int
    min_instances: int
    subset: str


def sample_trials(trials: int, depth=(1, 20), trees=(10, 50), leaf=(1, 4), subsets=("auto",), seed: int = 42) -> list[Trial]:
    """The first ``trials`` points of the grid by the md5 of ``seed-depth-trees-leaf-subset``; tree counts go in tens."""
    if depth[1] > MAX_DEPTH:
        raise ValueError(f"depth up to {depth[1]}: Spark's trees are at most {MAX_DEPTH} deep")
    grid = product(range(depth[0], depth[1] + 1), range(trees[0], trees[1] + 1, 10), range(leaf[0], leaf[1] + 1), subsets)
    drawn = sorted(grid, key=lambda p: hashlib.md5("-".join(map(str, (seed, *p))).encode()).hexdigest())[:trials]
    return [Trial(i, *p) for i, p in enumerate(drawn)]


@dataclass
class Tree:
    """Nodes in arrays: a leaf is its own child; ``above`` goes left where the value is over the threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    above: np.ndarray
    left: np.ndarray
    right: np.ndarray
    prediction: np.ndarray


@dataclass
class Forest:
    """One fit and the trials that are read off it; ``bins`` where it was fitted to bins of the features."""

    trees: list[Tree]
    trials: list[Trial] = field(default_factory=list)
    bins: bn.Bins | None = None


def _tree(nodes: pa.Table) -> Tree:
    ids = nodes["id"].to_numpy()
    if len(ids) and ids.max() != len(ids) - 1:
        raise ValueError("node ids of a saved tree are not 0, 1, ...")
    order = np.argsort(ids)
    column = {c: nodes[c].to_numpy(zero_copy_only=False)[order] for c in nodes.column_names}
    inner = column["leftChild"] >= 0
    categories = column["categories"]
    if (inner & (categories > 2)).any():
        raise ValueError("a split over more than two categories")
    two = inner & (categories >= 0)
    # of two categories 0 and 1, the first value tells which one goes left
    threshold = np.where(two, 0.5, np.nan_to_num(column["first"].astype(float)))
    own = np.arange(len(ids))
    return Tree(np.where(inner, column["feature"], 0).astype(np.int64), threshold, two & (column["first"] > 0.5),
                np.where(inner, column["leftChild"], own), np.where(inner, column["rightChild"], own), column["prediction"].astype(float))


def trees_of(model, frame: DataFrame) -> list[Tree]:
    """The trees of a fitted forest, by way of its saved node table."""
    spark = frame.sparkSession
    path = scratch_dir(spark, "forest")
    model.write().overwrite().save(path)
    n = F.col("nodeData")
    nodes = spark.read.parquet(f"{path}/data").select(
        "treeID", n["id"].alias("id"), n["prediction"].alias("prediction"), n["leftChild"].alias("leftChild"), n["rightChild"].alias("rightChild"),
        n["split"]["featureIndex"].alias("feature"), n["split"]["numCategories"].alias("categories"),
        F.coalesce(F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)), F.lit(0.0)).alias("first")).toArrow()
    discard(spark, path)
    which = nodes["treeID"].to_numpy()
    return [_tree(nodes.filter(pa.array(which == t)).drop_columns(["treeID"])) for t in range(model.getNumTrees)]


def fit_forests(train: DataFrame, trials: Iterable[Trial], features: str = "features", label: str = "label", seed: int = 42,
                parallelism: int = 4, rows: int = bn.ROWS) -> list[Forest]:
    """One forest per (min_instances, subset) among the trials, as deep and with as many trees as any of them needs; ``parallelism`` at a time.

    More than ``rows`` rows are fitted as weighted shares (``operators.bins``), which all forests read.
    """
    groups = defaultdict(list)
    for t in trials:
        groups[t.min_instances, t.subset].append(t)
    checkpoint_dir(train.sparkSession)  # where Spark keeps the rows' places in deep trees
    found = bn.condensed(train, features, label, rows, seed)
    bins, train, n = found or (None, train, 0)
    train = train.persist() if bins else train

    def fit(group: tuple[tuple[int, str], list[Trial]]) -> Forest:
        (leaf, subset), members = group
        rf = RandomForestRegressor(featuresCol=features, labelCol=label, seed=seed, maxDepth=max(t.max_depth for t in members),
                                   numTrees=max(t.num_trees for t in members), minInstancesPerNode=leaf, featureSubsetStrategy=subset,
                                   cacheNodeIds=True, maxMemoryInMB=1024)
        rf = bn.weighted(rf, bins, n) if bins else rf
        return Forest(trees_of(rf.fit(train), train), members, bins)

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            return list(pool.map(fit, groups.items()))
    finally:
        if bins:
            train.unpersist()


def predictions(forest: Forest, x: np.ndarray) -> Iterator[tuple[Trial, np.ndarray]]:
    """(trial, predictions of the rows of ``x``) of each of the forest's trials, from one walk down each tree."""
    wanted = defaultdict(list)
    for t in forest.trials:
        wanted[t.num_trees].append(t)
    depths = sorted({t.max_depth for t in forest.trials})
    sums, rows = {d: np.zeros(len(x)) for d in depths}, np.arange(len(x))
    for i, tree in enumerate(forest.trees, 1):
        at, level = np.zeros(len(x), np.int64), 0
        for d in depths:
            while level < d:
                goes_left = (x[rows, tree.feature[at]] <= tree.threshold[at]) != tree.above[at]
                at = np.where(goes_left, tree.left[at], tree.right[at])
                level += 1
            sums[d] += tree.prediction[at]
        for t in wanted[i]:
            yield t, sums[t.max_depth] / i


def score(frame: DataFrame, forests: list[Forest], features: str = "features", label: str = "label", part: str | None = None) -> DataFrame:
    """(part, trial, n, rmse, rmse_of_mean): every trial's error on the rows of each part, in one pass over the frame.

    ``rmse_of_mean`` is the error of the part's own mean. A task returns one row per part, trial and batch of rows; errors are
    summed about the labels' own values. Rows with a NULL label are left out. Without ``part`` there is one, "all".
    Where the forests were fitted to bins, rows of one cell have one prediction: their errors are those of their mean and the squares about it.
    """
    bins = forests[0].bins if forests else None
    sent = frame.sparkSession.sparkContext.broadcast([Forest(f.trees, f.trials) for f in forests])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch["x"].flatten().to_numpy(zero_copy_only=False)
            x, y = flat.reshape(batch.num_rows, -1), batch["y"].to_numpy(zero_copy_only=False)
            weight, within = (batch[c].to_numpy(zero_copy_only=False) for c in ("weight", "within"))
            names, code = np.unique(batch["part"].to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            found = []
            for forest in sent.value:
                for t, predicted in predictions(forest, x):
                    sse = np.bincount(code, weight * (predicted - y) ** 2 + within, len(names))
                    found += [(names[j], t.trial, sse[j]) for j in range(len(names))]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.int32()),
                                              pa.array([f[2] for f in found], pa.float64())], names=["part", "trial", "sse"])

    name = F.lit("all") if part is None else F.col(part).cast("string")
    rows = frame.filter(F.col(label).isNotNull()).select(name.alias("part"), F.col(features), F.col(label).cast("double").alias("y"))
    grouped = bn.cells(rows, bins, "y", by=["part"]) if bins else rows.select("*", F.lit(1.0).alias("weight"), F.lit(0.0).alias("within"))
    x = vector_to_array(bins.getOutputCol() if bins else features).alias("x")
    sums = grouped.select("part", x, "y", "weight", "within").mapInArrow(run, "part string, trial int, sse double").groupBy("part", "trial").agg(F.sum("sse").alias("sse"))
    whole = rows.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("y").alias("rmse_of_mean"))
    return sums.join(whole, "part").select("part", "trial", "n", F.sqrt(F.col("sse") / F.col("n")).alias("rmse"), "rmse_of_mean")


def trial_frame(spark, trials: Iterable[Trial]) -> DataFrame:
    return literal_frame(spark, [(t.trial, t.max_depth, t.num_trees, t.min_instances, t.subset) for t in trials], TRIALS)


def search(train: DataFrame, trials: list[Trial], features: str = "features", label: str = "label", seed: int = 42, key: str | None = None) -> DataFrame:
    """One row per trial with its parameters, the sizes of both parts and its error on the validating part, best first.

    A fifth of the rows by the md5 of ``key`` validates, whatever the partitioning; without a key, rows are drawn by Spark.
    """
    if key is None:
        fit, val = train.randomSplit([0.8, 0.2], seed)
    else:
        bucket = hash_bucket(F.concat(F.lit("search-"), F.col(key).cast("string")), 100)
        fit, val = train.filter(bucket < 80), train.filter(bucket >= 80)
    fit = fit.select(features, label).persist()
    try:
        forests = fit_forests(fit, trials, features, label, seed)
        n_fit = fit.count()
    finally:
        fit.unpersist()
    errors = score(val, forests, features, label).select("trial", F.lit(n_fit).cast("bigint").alias("n_fit"), F.col("n").alias("n_val"),
                                                         F.col("rmse").alias("val_rmse"), F.col("rmse_of_mean").alias("mean_rmse"))
    return trial_frame(train.sparkSession, trials).join(errors, "trial").orderBy("val_rmse", "trial")


def select(trials: DataFrame, train: DataFrame, val: DataFrame, test: DataFrame, top: int = 5, features: str = "features", label: str = "label",
           select_on: str = "val_rmse", seed: int = 42) -> DataFrame:
    """The ``top`` best trials fitted anew on ``train``, one row each with its errors on both parts, best first by ``select_on``."""
    best = [Trial(*r) for r in trials.orderBy("val_rmse", "trial").limit(top).select("trial", "max_depth", "num_trees", "min_instances", "subset").collect()]
    forests = fit_forests(train, best, features, label, seed)
    both = val.select(F.lit("val").alias("part"), features, label).unionAll(test.select(F.lit("test").alias("part"), features, label))
    errors = score(both, forests, features, label, part="part").groupBy("trial").agg(
        *[F.max(F.when(F.col("part") == p, F.col(c))).alias(f"{p}_{c}") for p in ("val", "test") for c in ("n", "rmse", "rmse_of_mean")])
    return trial_frame(train.sparkSession, best).drop("subset").join(errors, "trial").orderBy(select_on, "trial")

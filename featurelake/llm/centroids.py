"""Operator 13, centroid clustering in whole numbers, with a rotated filter before the exact distances.

Vectors become integer points, once, in a written table. Beside each point lie its leading coordinates in a rotated system
(principal axes of a bounded sample) and the length of the rest. For a point and a centroid, the squared distance of the leading
coordinates plus the squared difference of the two rests' lengths is never above the true squared distance. So a
centroid whose bound exceeds an exact distance already known is passed over, and only the survivors are measured in integers.
The rotation and its rounding decide how much is measured, never the result: bounds are lowered by more than their rounding.

A round is one scan: a task returns a sum per cluster and component, so what is shuffled does not follow the number of vectors, and the
driver gets k times the components.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelake.llm.common import keep

DIMS = 64
SCALE = 64
K = 16
ROUNDS = 3
SEED = 1
LEADING = 12
#: Vectors that the rotation is fitted on, about; at most twice as many.
SAMPLE = 2000
#: Components up to this keep every squared distance within 64 bits; larger ones raise.
LARGEST = 1 << 27
_SLACK = 1e-5


def _points(vectors: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows hold ``dims`` finite components, and their integer points."""
    good = pc.fill_null(pc.equal(pc.list_value_length(vectors), dims), False).to_numpy(zero_copy_only=False)
    flat = vectors.filter(pa.array(good)).flatten()
    x = flat.cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(-1, dims)  # NULL: NaN
    finite = np.isfinite(x).all(1)
    at = np.flatnonzero(good)[finite]
    y = np.floor(x[finite] * scale)
    if len(y) and np.abs(y).max() > LARGEST:
        raise ValueError(f"a component beyond {LARGEST // scale}: squared distances would leave 64 bits")
    return at, y.astype(np.int64)


def rotation(vectors: DataFrame, dims: int = DIMS, scale: int = SCALE, sample: int = SAMPLE) -> np.ndarray:
    """Principal axes as columns, strongest first, of about ``sample`` vectors chosen by a hash of their id and components.

    They steer the filter only; so a bounded sample is enough, and any rotation gives the same result.
    """
    share = max(1, vectors.count() // sample)
    chosen = vectors.filter(F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(share)) == 0).select("embedding").limit(2 * sample).toArrow()
    _, y = _points(chosen.column(0).combine_chunks(), dims, scale)
    if len(y) < 2:
        return np.eye(dims)
    return np.linalg.eigh(np.cov(y.astype(float), rowvar=False))[1][:, ::-1]


def projected(points: np.ndarray, axes: np.ndarray, leading: int = LEADING) -> tuple[np.ndarray, np.ndarray]:
    """Leading rotated coordinates, and the length of what remains."""
    z = points @ axes
    return z[:, :leading], np.sqrt((z[:, leading:] ** 2).sum(1))


def indexed(vectors: DataFrame, axes: np.ndarray, dims: int = DIMS, scale: int = SCALE, leading: int = LEADING) -> DataFrame:
    """(vec_id, point, lead, rest) of the vectors that have exactly ``dims`` components, none NULL or non-finite."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, y = _points(batch.column(1), dims, scale)
            lead, rest = projected(y, axes, leading)
            as_list = lambda a, kind: pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1) * a.shape[1], pa.int32()), pa.array(a.ravel(), kind))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), as_list(y, pa.int32()), as_list(lead, pa.float32()),
                                              pa.array(rest, pa.float32())], names=["vec_id", "point", "lead", "rest"])

    schema = (vectors.select("vec_id").schema.add("point", T.ArrayType(T.IntegerType()))
              .add("lead", T.ArrayType(T.FloatType())).add("rest", T.FloatType()))
    return vectors.select("vec_id", "embedding").mapInArrow(run, schema)


def nearest(points: np.ndarray, lead: np.ndarray, rest: np.ndarray, centres: np.ndarray, axes: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(cluster, squared distance) of every point, ties to the smaller number, and how many distances were measured."""
    c_lead, c_rest = projected(centres, axes, lead.shape[1])
    own, other = (lead ** 2).sum(1) + rest ** 2, (c_lead ** 2).sum(1) + c_rest ** 2
    bound = (lead ** 2).sum(1)[:, None] + (c_lead ** 2).sum(1) - 2 * (lead @ c_lead.T) + (rest[:, None] - c_rest) ** 2
    bound -= _SLACK * (own[:, None] + other) + 1e-6
    cluster = bound.argmin(1)
    best = ((points - centres[cluster]) ** 2).sum(1)
    first, measured = cluster.copy(), len(points)
    for j in range(len(centres)):
        at = np.flatnonzero((bound[:, j] <= best) & (first != j))
        d = ((points[at] - centres[j]) ** 2).sum(1)
        better = (d < best[at]) | ((d == best[at]) & (j < cluster[at]))
        best[at[better]], cluster[at[better]] = d[better], j
        measured += len(at)
    return cluster, best, measured


def _read(batch: pa.RecordBatch, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    rows = batch.num_rows
    point = batch.column(1).flatten().to_numpy().astype(np.int64).reshape(rows, dims)
    lead = batch.column(2).flatten().to_numpy().astype(float)
    return point, lead.reshape(rows, -1) if rows else lead.reshape(0, LEADING), batch.column(3).to_numpy().astype(float)


def _sums(table: DataFrame, centres: np.ndarray, axes: np.ndarray) -> DataFrame:
    """(cluster, dim, total): a row per task, cluster and component; dim -1 counts the vectors."""
    k, dims = centres.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k, dims + 1), np.int64)
        for batch in batches:
            points, lead, rest = _read(batch, dims)
            cluster, _, _ = nearest(points, lead, rest, centres, axes)
            for j in np.unique(cluster):
                mine = points[cluster == j]
                total[j, :dims] += mine.sum(0)
                total[j, dims] += len(mine)
        hit = np.flatnonzero(total[:, dims])
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(hit, dims + 1), pa.int32()), pa.array(np.tile(np.r_[np.arange(dims), -1], len(hit)), pa.int32()),
                                          pa.array(total[hit].ravel())], names=["cluster", "dim", "total"])

    return table.mapInArrow(run, "cluster int, dim int, total long")


def moved(table: DataFrame, centres: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Each centroid that has vectors, at the exact floor of their mean; the others where they were."""
    got = _sums(table, centres, axes).groupBy("cluster", "dim").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    total = {(r["cluster"], r["dim"]): int(r["total"]) for r in got}
    out = centres.copy()
    for j in range(len(centres)):
        if (j, -1) in total:
            out[j] = [total[j, i] // total[j, -1] for i in range(centres.shape[1])]
    return out


def assigned(table: DataFrame, centres: np.ndarray, axes: np.ndarray) -> DataFrame:
    """(vec_id, cluster, distance)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cluster, best, _ = nearest(*_read(batch, centres.shape[1]), centres, axes)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(cluster, pa.int32()), pa.array(best)], names=["vec_id", "cluster", "distance"])

    return table.mapInArrow(run, table.select("vec_id").schema.add("cluster", T.IntegerType()).add("distance", T.LongType()))


def seeds(table: DataFrame, k: int, seed: int) -> np.ndarray:
    """The points of the ``k`` vectors with the smallest sha256 of ``seed:vec_id``, in that order (a NULL id counts as an empty one).

    Rows of one id come in the order of their points.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = table.select("point", digest.alias("digest")).orderBy("digest", "point").limit(k).collect()
    return np.array([r["point"] for r in rows], np.int64)


def cluster(vectors: DataFrame, k: int = K, rounds: int = ROUNDS, seed: int = SEED, dims: int = DIMS, scale: int = SCALE,
            axes: np.ndarray | None = None) -> DataFrame:
    """vectors (vec_id, embedding) as vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    Component x counts as floor(scale * x). Vectors that are NULL, of another length, or hold a NULL or non-finite component have no
    row; repeated rows stay. Other columns are not read. Ties go to the smaller cluster. With fewer than ``k`` vectors each is a
    seed; without any there are no rows. A component beyond ``LARGEST / scale`` raises.
    """
    given = vectors.select("vec_id", "embedding")
    axes = rotation(given, dims, scale) if axes is None else axes
    table = keep(indexed(given, axes, dims, scale), "points")
    centres = seeds(table, k, seed)
    if not len(centres):
        centres = np.zeros((1, dims), np.int64)
    for _ in range(rounds):
        centres = moved(table, centres, axes)
    done = keep(assigned(table, centres, axes), "clusters")
    per = {r["cluster"]: int(r["d"]) for r in done.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres.tolist()]
    of_cluster = lambda values: F.element_at(F.array(*map(F.lit, values)), F.col("cluster") + 1)
    inertia = [per.get(j, 0) for j in range(len(centres))]
    return done.select("vec_id", "cluster", "distance", of_cluster(inertia).cast("long").alias("cluster_inertia"),
                       F.lit(sum(inertia)).cast("long").alias("inertia"), of_cluster(digests).alias("centroid_sha256"))

"""Operator 13 against plain integer clustering and its SQL."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as se
from featurelake.llm import centroids, common
from tests.conftest import SF_SMALL
from tests.oracle_check import canon, duck

SCHEMA = "vec_id long, embedding array<float>, cluster string, label int"


@pytest.fixture()
def vectors(spark):
    common.ship_package(spark)
    return lambda rows: spark.createDataFrame([(i, v, "own", 3) for i, v in rows], SCHEMA)


def by_hand(rows, k, rounds, seed, dims, scale):
    """Plain rows of (vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256)."""
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    hashed = sorted(kept, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [list(p) for _, p in hashed[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(p, c)), j) for j, c in enumerate(centres)) for _, p in kept]

    for _ in range(rounds):
        own = assign()
        for j in range(len(centres)):
            mine = [p for (_, p), (_, c) in zip(kept, own) if c == j]
            if mine:
                centres[j] = [sum(col) // len(mine) for col in zip(*mine)]
    own = assign()
    per = [sum(d for d, c in own if c == j) for j in range(len(centres))]
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, c, d, per[c], sum(per), sha[c]) for (i, _), (d, c) in zip(kept, own)), key=str)


def plain(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_clusters_equal_plain_clustering(vectors):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=6).round(2).tolist()) for i in range(200)]
    rows += [(3, rows[3][1])] * 30 + [(3, rows[4][1]), (None, rows[0][1]), (None, rows[9][1])]
    rows += [(500, None), (501, []), (502, [1.0] * 5), (503, [1.0] * 7), (504, [1.0] * 5 + [None]), (505, [1.0] * 5 + [float("nan")]), (506, [float("inf")] * 6)]
    for k, rounds in ((5, 3), (16, 2), (1, 1), (300, 1)):
        got = centroids.cluster(vectors(rows), k=k, rounds=rounds, seed=1, dims=6, scale=64)
        assert plain(got) == by_hand(rows, k, rounds, 1, 6, 64)


def test_ties_go_to_the_smaller_number_and_empty_clusters_stay(vectors):
    rows = [(i, [float(i % 3), 0.0]) for i in range(12)]  # seeds repeat points, so later copies stay empty
    got = centroids.cluster(vectors(rows), k=8, rounds=3, seed=1, dims=2, scale=4)
    assert plain(got) == by_hand(rows, 8, 3, 1, 2, 4)


def test_no_vectors_no_rows(vectors):
    assert centroids.cluster(vectors([])).collect() == []
    assert centroids.cluster(vectors([(1, None), (2, [1.0])])).collect() == []


def test_any_rotation_gives_the_same_rows(spark):
    table = common.table(spark, SF_SMALL, "embeddings")
    turned = np.linalg.qr(np.random.default_rng(1).normal(size=(64, 64)))[0]
    assert plain(centroids.cluster(table, axes=turned)) == plain(centroids.cluster(table))


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 2**32), st.sampled_from([1, 50, 10_000, 1 << 26]), st.integers(1, 12), st.integers(1, 40))
def test_filter_never_loses_the_nearest(seed, size, k, n):
    """Also where rounding is coarse: points far from the origin and close together."""
    rng = np.random.default_rng(seed)
    shift = rng.integers(-size, size + 1, 64)
    points, centres = (rng.integers(-3, 4, (m, 64)) * rng.integers(0, 2) + shift for m in (n, k))
    axes = np.linalg.qr(rng.normal(size=(64, 64)))[0]
    lead, rest = centroids.projected(points, axes)
    cluster, best, _ = centroids.nearest(points, lead.astype(np.float32).astype(float), rest.astype(np.float32).astype(float), centres, axes)
    d = ((points[:, None] - centres[None]) ** 2).sum(2)
    assert (cluster == d.argmin(1)).all() and (best == d.min(1)).all()


def test_filter_spares_most_distances():
    """Where vectors lie in groups, the bound decides most of the distances."""
    rng = np.random.default_rng(4)
    middles = rng.normal(size=(16, 64)) * 30
    points = np.floor(middles[rng.integers(0, 16, 2_000)] + rng.normal(size=(2_000, 64)) * 8).astype(int)
    axes = np.linalg.eigh(np.cov(points.astype(float), rowvar=False))[1][:, ::-1]
    _, _, measured = centroids.nearest(points, *centroids.projected(points, axes), middles.astype(int), axes)
    assert measured < 0.1 * len(points) * 16


def test_components_beyond_64_bit_distances_raise(vectors):
    with pytest.raises(Exception, match="squared distances would leave 64 bits"):
        centroids.cluster(vectors([(1, [3e30, 0.0]), (2, [0.0, 0.0])]), dims=2).collect()


def test_query_equals_its_sql(spark):
    got = se.queries()["op13_centroids"](spark, SF_SMALL).toPandas()
    assert len(got) == common.table(spark, SF_SMALL, "embeddings").filter(F.size("embedding") == 64).count()
    assert canon(got) == canon(duck(SF_SMALL).sql(se.oracle_sql()["op13_centroids"]).df())

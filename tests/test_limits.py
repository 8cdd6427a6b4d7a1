"""No result is cut short: former limits are forced here, with NULL, NaN and Infinity where they used to go wrong."""

import math
import os
import random
import time
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from featurelake.operators import graph as gr
from featurelake.operators import models as ml
from featurelake.operators import quality as qa
from featurelake.operators import store as st
from featurelake.operators import transform as tr
from featurelake.operators import trips as tp
from featurelake.operators import views as vw
from featurelake.session import scratch_dir, written
from featurelake.streaming import envelopes as env
from featurelake.streaming.store_sink import FeatureStoreSink, read_committed, run_available_now


def test_components_converge_or_raise(spark):
    path = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(900, 901), (None, 5)], "src long, dst long")
    sizes = {r["component"]: r["size"] for r in gr.component_sizes(path).collect()}
    assert sizes == {0: 201, 900: 2}
    with pytest.raises(RuntimeError):
        gr.component_labels(path, max_rounds=2)
    assert gr.component_labels(spark.createDataFrame([], "src long, dst long")).count() == 0


def labels_by_hand(edges):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for x, y in edges:
        lo, hi = sorted((root(x), root(y)))
        parent[hi] = lo
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("hub_rows", [3, 500_000])
def test_components_of_dense_graphs_are_contracted_first(spark, hub_rows, monkeypatch):
    """Many repeated edges a node: the rounds pass over fewer edges than nodes."""
    draw = random.Random(5)
    groups = [draw.sample(range(k * 100, k * 100 + 100), 60) for k in range(5)]
    edges = [(draw.choice(g), draw.choice(g)) for g in groups for _ in range(400)] * 2
    edges += [(7000, 7000), (150, 8000), (8000, 250)] + [(9000, i) for i in range(9001, 9030)]
    rounds = []
    at = gr._at
    monkeypatch.setattr(gr, "_at", lambda e, *a: rounds.append(e.count()) or at(e, *a))
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r["node"]: r["label"] for r in gr.component_labels(df, hub_rows=hub_rows).collect()}
    assert got == labels_by_hand(edges)
    assert rounds[0] < len(got) and sum(n > len(got) for n in rounds) <= 2  # once for each end
    with pytest.raises(RuntimeError):
        gr.component_labels(df, max_rounds=0)


@pytest.mark.parametrize("hub_rows", [3, 500_000])
def test_components_of_hubs_long_paths_loops_and_repeats(spark, hub_rows):
    draw = random.Random(7)
    edges = [(50, i) for i in range(40, 140)] + [(i, i + 1) for i in range(1000, 1060)] + [(7, 7), (8, 9), (9, 8), (8, 9)]
    order = draw.sample(range(2000, 2060), 60)  # a path through ids in no order, and two stars that share a leaf
    edges += list(zip(order, order[1:])) + [(3000, i) for i in range(3001, 3060)] + [(3100, i) for i in range(3050, 3100)]
    edges += [(draw.randrange(4000, 4400), draw.randrange(4000, 4400)) for _ in range(180)]
    got = gr.component_labels(spark.createDataFrame(edges + [(None, 1), (2, None)], "src long, dst long"), hub_rows=hub_rows)
    assert {r["node"]: r["label"] for r in got.collect()} == labels_by_hand(edges)


def test_components_of_text_ids(spark):
    edges = [("b", "a"), ("c", "b"), ("é", "z"), ("d", "d")]
    got = gr.component_labels(spark.createDataFrame(edges, "src string, dst string"))
    assert {r["node"]: r["label"] for r in got.collect()} == {"a": "a", "b": "a", "c": "a", "z": "z", "é": "z", "d": "d"}


@pytest.mark.parametrize("center", [0, 60_000])
def test_no_group_of_a_join_holds_a_hub(spark, center):
    star = spark.range(60_000).select(F.greatest("id", F.lit(center)).alias("hi"), F.least("id", F.lit(center)).alias("lo")).filter("hi > lo")
    nodes, _, seen = gr._nodes(star, 1000)
    end = "lo" if center == 0 else "hi"
    assert seen["hubs_above" if center == 0 else "hubs_below"] == 1
    left, right = gr.dealt_hubs(star, nodes, end, 1000)
    largest = left.groupBy(end, "piece").count().agg(F.max("count")).first()[0]
    assert largest <= 1300 and right.groupBy("node", "piece").count().filter("count > 1").count() == 0
    joined = gr._at(star, nodes, end, 1000, 1)
    assert joined.count() == star.count()


@pytest.mark.parametrize("kind, most", [("long", 5), ("string", 8)])
def test_cells_are_sent_few_bytes_an_edge(spark, kind, most):
    edges = spark.range(200_000).select((F.xxhash64("id") % 30_000).cast(kind).alias("a"), (F.xxhash64("id", F.lit(1)) % 30_000).cast(kind).alias("b")).distinct()
    dealt = gr.dealt_blocks(edges, 4)
    assert dealt.agg(F.sum(F.length("edges"))).first()[0] < most * 4 * edges.count()
    assert dealt.groupBy("cell").count().count() == 20  # of four colours, three each


@pytest.mark.parametrize("cell_edges", [10**9, 60, 5])
def test_triangles_in_cells_equal_all_triples(spark, monkeypatch, cell_edges):
    rng = np.random.default_rng(cell_edges % 7)
    pairs = {tuple(sorted(p)) for p in rng.integers(0, 40, (260, 2)).tolist() if p[0] != p[1]}
    pairs |= {(0, i) for i in range(1, 200)} | {(500 + i, 500 + j) for i in range(8) for j in range(i + 1, 8)}  # a hub and a clique
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b), near.setdefault(b, set()).add(a)
    want = {v: sum(1 for x in n for y in n if x < y and y in near[x]) for v, n in near.items()}
    monkeypatch.setattr(gr, "STEP_PAIRS", 50)
    for name in (lambda i: i, lambda i: f"n{i}"):
        edges = gr.canonical_edges(spark.createDataFrame([(name(a), name(b)) for a, b in pairs], "src long, dst long" if name(1) == 1 else "src string, dst string"))
        got = {r["node"]: (r["triangles"], r["clustering"]) for r in gr.local_clustering(edges, cell_edges).collect()}
        assert got == {name(v): (t, pytest.approx(2 * t / (len(near[v]) * (len(near[v]) - 1)) if len(near[v]) > 1 else 0.0)) for v, t in want.items()}
    assert gr.local_clustering(edges.limit(0)).count() == 0


def test_triangles_in_rounds_with_loops_and_missing_ends(spark, monkeypatch):
    rng = np.random.default_rng(11)
    links = {tuple(sorted(p)) for p in rng.integers(0, 60, (500, 2)).tolist()} | {(900 + i, 1900 + i) for i in range(300)} | {(3, 3), (70, 70)}  # some are loops
    after = {}
    for a, b in links:
        after.setdefault(a, set()).add(b)
    degree, want = Counter(), Counter()
    for a, b in [*links, (None, 5), (None, None)]:
        degree.update([a, b])
    for a, b in links:
        want.update(v for c in after[a] & after.get(b, set()) for v in (a, b, c))  # as the SQL counts: a <= b <= c
    monkeypatch.setattr(gr, "ROUND_ROWS", 1)
    monkeypatch.setattr(gr, "PART_NODES", 2)
    monkeypatch.setattr(gr, "SPLIT_EDGES", 50)
    monkeypatch.setattr(gr, "BLOCK_EDGES", 7)
    for cast in ("long", "double", "string"):
        edges = spark.createDataFrame([*links, (None, 5), (None, None)], "src long, dst long").selectExpr(f"cast(src as {cast}) src", f"cast(dst as {cast}) dst")
        got = {None if r["node"] is None else int(float(r["node"])): (r["degree"], r["triangles"]) for r in gr.local_clustering(edges, 100).collect()}
        assert got == {v: (d, want[v]) for v, d in degree.items()}


def test_rounds_deal_each_cell_once_and_few_copies(spark):
    edges = spark.range(200_000).select((F.xxhash64("id") % 30_000).alias("a"), (F.xxhash64("id", F.lit(1)) % 30_000).alias("b")).distinct()
    blocks = gr.packed_blocks(edges, 12).localCheckpoint()
    whole = blocks.agg(F.sum(F.length("edges"))).first()[0]
    cells, copies = [], []
    left = [(12 - c) / 12 for c in range(12)]
    spans = gr.rounds([3 * x * x for x in left], 1)
    for least in spans:
        seen = gr.dealt_blocks(blocks, 12, least).groupBy("cell").agg(F.sum(F.length("edges")).alias("n")).collect()
        cells += [tuple(r["cell"]) for r in seen]
        copies.append(sum(r["n"] for r in seen) / whole)
    assert [c for lo, hi in spans for c in range(lo, hi)] == list(range(12))
    assert len(cells) == len(set(cells)) == 12 * 13 * 14 // 6
    assert max(copies) < 3.2 and sum(copies) == pytest.approx(12)


def test_clustering_leaves_no_shuffle_files_behind(spark):
    def shuffled():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {f.getName(): f.length() for f in (files.apply(i) for i in range(files.size())) if f.getName().startswith("shuffle_") and f.getName().endswith(".data")}

    edges = spark.range(60_000).select((F.xxhash64("id") % 3000).alias("a"), (F.xxhash64("id", F.lit(1)) % 3000).alias("b"))
    edges, _ = written(gr.canonical_edges(edges, "a", "b"), "links", free=True)
    old = set(shuffled())
    gr.local_clustering(edges, 3000)
    for _ in range(40):
        left = sum(n for name, n in shuffled().items() if name not in old)
        if left < 1000:
            break
        time.sleep(0.25)
    assert left < 1000


def test_quantiles_resolve_every_rank(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=3000), np.full(4000, 7.0), [math.inf, -math.inf, 1e-300, -1e300]])
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    got = qa.exact_quantiles(df, ["x"], [0.0, 0.25, 0.5, 0.75, 1.0], window=20, splits=4)["x"]
    for p in (0.25, 0.5, 0.75):
        assert got[p] == pytest.approx(float(np.quantile(x, p)), abs=1e-12)
    assert got[0.0] == -math.inf and got[1.0] == math.inf
    with pytest.raises(RuntimeError):
        qa.exact_quantiles(df, ["x"], [0.1], window=1, splits=4, max_rounds=1)


def test_ranks_equal_a_plain_sort(spark):
    rng = np.random.default_rng(3)
    cols = {"a b": rng.normal(size=5000).round(1), "ties": np.where(rng.random(5000) < 0.4, 7.0, rng.integers(0, 50, 5000)), "same": np.full(5000, 2.5),
            "odd": np.concatenate([rng.normal(size=4990), [math.inf, -math.inf, 0.0, -0.0, 1e-300, -1e300, *[math.nan] * 4]])}
    rows = [tuple(None if i % 97 == 0 and j == 0 else float(v[i]) for j, v in enumerate(cols.values())) + (None,) for i in range(5000)]
    df = spark.createDataFrame(rows, "`a b` double, ties double, same double, odd double, none double")
    names = [*cols, "none"]
    plain = {c: sorted(v for r in rows if (v := r[j]) is not None and not math.isnan(v)) for j, c in enumerate(names)}
    ranks = {c: [0, 1, 17, len(v) // 2, len(v) - 1, len(v), 10**9] for c, v in plain.items()}
    got = qa.values_at_ranks(df, names, ranks)
    assert got == {(c, r): plain[c][r] for c in names for r in ranks[c] if 0 <= r < len(plain[c])}
    assert qa.values_at_ranks(df.limit(0), names, ranks) == {} and qa.values_at_ranks(df, names, {}) == {}


def test_describe_equals_pandas_and_leaves_no_table(spark):
    import glob

    rng = np.random.default_rng(5)
    df = spark.createDataFrame([(float(x), int(n), None) for x, n in zip(rng.normal(size=701), rng.integers(0, 9, 701))], "x double, n int, gone double")
    got = {r["column_name"]: r for r in qa.describe(df).collect()}
    want = df.toPandas()[["x", "n"]].describe()
    for c in ("x", "n"):
        for ours, theirs in (("count", "count"), ("mean", "mean"), ("std", "std"), ("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")):
            assert got[c][ours] == pytest.approx(want[c][theirs], rel=1e-12)
    assert got["gone"]["count"] == 0 and got["gone"]["p50"] is None
    assert not glob.glob(os.path.join(scratch_dir(spark, "x").removeprefix("file:").rsplit("/", 1)[0], "ranks-*"))


def test_nan_is_left_out(spark):
    df = spark.createDataFrame([("reference", 1.0), ("reference", 1.0), ("current", 1.0), ("current", math.nan)], "period string, x double")
    r = qa.mean_drift(df, "period").first()
    assert r["current_mean"] == 1.0 and r["drift_percentage"] == 0.0 and not r["drift_detected"] and r["drifted_features"] == 0
    r = tr.row_stats(spark.createDataFrame([(1.0, math.nan, 3)], "a double, b double, c int")).first()
    assert r["feature_sum"] == 4.0 and r["feature_mean"] == 2.0
    long = st.melt(spark.createDataFrame([(1, math.nan)], "k int, v double"), key="k", event_ts="2024-01-01 00:00:00")
    assert long.first()["feature_value"] is None


def test_profile_counts_decimals_and_nested(spark):
    df = spark.sql("SELECT CAST(1.5 AS DECIMAL(10,2)) AS d, array(1, 2) AS a")
    size = qa.profile(df, "t").filter("stat = 'memory_bytes'").first()["value"]
    assert size == 8 + len("[1,2]")


def test_null_keys_and_times_are_in_no_split(spark):
    df = spark.createDataFrame([(None, None), (1, "2024-01-01 00:00:00")], "k int, t string").withColumn("t", F.col("t").cast("timestamp_ntz"))
    assert [r["split"] for r in tp.hash_split(df, "k").orderBy("k").collect()][0] is None
    got = {r["k"]: r["split"] for r in tp.temporal_split(df, "t", "2023-01-01", "2023-06-01").collect()}
    assert got == {None: None, 1: "test"}


def test_null_keys_match_nothing(spark):
    view = vw.FeatureView(name="v", entity=vw.Entity("e", ("k",)), features=("f",), ttl=None)
    ts = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    src = spark.createDataFrame([(None, 9.0), (1, 2.0)], "k long, f double").withColumn("event_timestamp", ts).withColumn("created", ts)
    ents = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "k long, id int").withColumn("event_timestamp", ts)
    got = {r["id"]: r["f"] for r in vw.point_in_time_join(ents, src, view).collect()}
    assert got == {1: None, 2: None, 3: 2.0}


def test_stream_timeout_raises_and_goes_on_later(spark):
    root = scratch_dir(spark, "limits")
    spark.range(400).select(F.col("id").cast("string").alias("value")).repartition(40).write.text(os.path.join(root, "in"))
    stream = spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(os.path.join(root, "in"))

    def sink(batch, n):
        batch.write.mode("overwrite").parquet(os.path.join(root, "out", f"batch_id={n}"))

    with pytest.raises(TimeoutError):
        run_available_now(stream, sink, os.path.join(root, "checkpoint"), timeout_s=0.5)
    run_available_now(stream, sink, os.path.join(root, "checkpoint"))
    assert read_committed(spark, os.path.join(root, "out")).select("value").distinct().count() == 400


def test_bad_messages_do_not_stop_the_stream(spark):
    good = '{"entity_id":"1","feature_data":{"x":%s},"timestamp":"2024-01-01T00:00:00"}'
    rows = [(good % "1.0", 1), (good % "2.0", 3), (good % "6.0", 2), ('{"entity_id":"1","feature_data":{"x":1.0},"timestamp":"never"}', 4),
            ('{"entity_id":"1","feature_data":{},"timestamp":"2024-01-01T00:00:00"}', 5), ("{", 6)]
    sink = FeatureStoreSink(scratch_dir(spark, "limits-sink"))
    sink(spark.createDataFrame(rows, "value string, offset long"), 0)
    assert [r["feature_value"] for r in sink.latest(spark).collect()] == [2.0]
    assert sorted(r["reason"] for r in sink.dead_letters(spark).collect()) == ["bad timestamp", "empty feature_data", "unparseable"]
    assert env.decode_updates(spark.createDataFrame([(None,)], "value string")).first()["_valid"] is False


def test_as_of_prunes_dates(spark):
    path = os.path.join(scratch_dir(spark, "limits-log"), "log")
    log = spark.sql("SELECT string(id) AS entity_id, 'f' AS feature_name, double(id) AS feature_value, "
                    "timestamp_ntz '2024-01-01 00:00:00' + make_dt_interval(int(id)) AS event_ts, timestamp_ntz '2024-01-01 00:00:00' AS ingest_ts, id AS seq FROM range(10)")
    st.append_log(log, path)
    got = st.latest_pivot(spark.read.parquet(path), ["f"], as_of="2024-01-03 12:00:00")
    assert got.count() == 3
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan


def test_linear_model_on_many_categories(spark):
    rows = [(f"c{i:05d}", float(i % 7)) for i in range(4400)]
    df = spark.createDataFrame(rows, "PU_DO string, label double")
    x = tp.fit_one_hot(df, ["PU_DO"], []).transform(df)
    pred = ml.linear_regression(x.select("features", "label")).transform(x)
    assert ml.rmse(pred) < 0.05
    assert x.select(tp.active_category(x, "PU_DO").alias("i")).filter("i IS NULL").count() == 0


def test_deep_trees_raise(spark):
    with pytest.raises(ValueError):
        ml.hyper_search(spark.range(1), depth=(2, 32))

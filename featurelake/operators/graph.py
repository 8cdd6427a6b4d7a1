"""Correlation networks and graph metrics over edge DataFrames.

Graphs are ``DataFrame(src, dst, ...)`` with one row per undirected edge,
canonical ``src < dst``. Every metric is a DataFrame job:

* degrees: ``groupBy`` over both endpoints (partial aggregation, hub-safe);
* triangles (for clustering): edges oriented from lower to higher
  (degree, id) rank, so no hub expands its full neighbourhood; counted in cells of three node colours (the partition
  algorithm of Suri and Vassilvitskii, "Counting triangles and the curse of the last reducer", WWW 2011), so edges are
  shuffled and wedges are not, in rounds that share one packed copy of them; listed with an equi-join (their node-iterator++);
* components: alternating large and small stars, each step's edges written
  to the session's shared checkpoint folder; a dense graph is first contracted along each
  node's edge to its least neighbour.
"""

from __future__ import annotations

import itertools
import math
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelake.functions.columns import nan_to_null
from featurelake.operators.transform import numeric_columns
from featurelake.session import checkpoint_dir, discard, written


# ---------------------------------------------------------------- correlation network

def correlation_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pairwise-complete Pearson correlation of every numeric pair i < j, long form. NULL and NaN are missing values.

    Each task keeps p x p matrices of masked moment sums, which grow by matrix products of whole Arrow batches;
    it returns p(p-1)/2 rows, which one grouped sum puts together. No row is multiplied by the number
    of pairs. Values are taken from the column's mean (a first, cheap aggregate), so
    the sums lose no digits to a large mean. A constant column gives NULL.
    """
    cols = cols or numeric_columns(df)
    vals = df.select(*[nan_to_null(c).alias(f"v{i}") for i, c in enumerate(cols)])
    if len(cols) < 2:
        return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, correlation double")
    means = np.array([m if m is not None and np.isfinite(m) else 0.0 for m in vals.agg(*[F.avg(c) for c in vals.columns]).first()])

    def moments(batches):
        p = len(means)
        n, s, q, xy = (np.zeros((p, p)) for _ in range(4))
        for batch in batches:
            x = np.column_stack([c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns]) - means
            there = ~np.isnan(x)
            x = np.where(there, x, 0.0)
            m = there.astype(float)
            n += m.T @ m
            s += x.T @ m
            q += (x * x).T @ m
            xy += x.T @ x
        i, j = np.triu_indices(p, 1)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (i, j, n[i, j], s[i, j], s[j, i], q[i, j], q[j, i], xy[i, j])],
                                         names=["i", "j", "n", "sx", "sy", "sxx", "syy", "sxy"])

    total = (vals.mapInArrow(moments, "i long, j long, n double, sx double, sy double, sxx double, syy double, sxy double")
             .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")]))
    names, mean = F.array(*[F.lit(c) for c in cols]), F.array(*[F.lit(float(m)) for m in means])
    n = F.col("n")

    def spread_of(square: str, linear: str, at: str):
        """The sum of squares about the pair's own mean; what rounding leaves of a constant column counts as none."""
        v = F.col(square) - F.try_divide(F.col(linear) * F.col(linear), n)
        return F.when((v > 0) & (v > 1e-29 * n * F.element_at(mean, F.col(at).cast("int") + 1) * F.element_at(mean, F.col(at).cast("int") + 1)), v)

    r = (F.col("sxy") - F.try_divide(F.col("sx") * F.col("sy"), n)) / F.sqrt(spread_of("sxx", "sx", "i") * spread_of("syy", "sy", "j"))
    return total.select(F.element_at(names, F.col("i").cast("int") + 1).alias("feature_a"),
                        F.element_at(names, F.col("j").cast("int") + 1).alias("feature_b"), r.alias("correlation"))


def correlation_edges(corr: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Edges where |corr| > threshold; weight = |corr|. NULL/NaN pairs never form edges."""
    c = F.col("correlation")
    return corr.filter(c.isNotNull() & ~F.isnan(c) & (F.abs(c) > threshold)).select(
        F.col("feature_a").alias("src"), F.col("feature_b").alias("dst"), F.abs(c).alias("weight"), c.alias("correlation"))


# ---------------------------------------------------------------- generic graph metrics

def canonical_edges(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """Undirected simple graph: ``src < dst``, self-loops and duplicates removed."""
    a, b = F.col(src), F.col(dst)
    return (edges.filter(a != b).select(F.least(a, b).alias("src"), F.greatest(a, b).alias("dst")).distinct())


def endpoints(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("src").alias("node")).unionAll(edges.select(F.col("dst").alias("node")))


def degrees(edges: DataFrame) -> DataFrame:
    """Degree per node (nodes exist only as edge endpoints, like graphs built by adding edges)."""
    return endpoints(edges).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))


def summary(edges: DataFrame) -> DataFrame:
    """Node count, edge count, density 2m / (n (n - 1)) (NULL below two nodes), one row."""
    deg = degrees(edges)
    s = deg.agg(F.count(F.lit(1)).alias("node_count"), (F.sum("degree") / 2).cast("bigint").alias("edge_count"))
    n, m = F.col("node_count"), F.col("edge_count")
    return s.select(n, m, F.when(n > 1, (2 * m) / (n * (n - 1))).alias("density"))


def degree_centrality(edges: DataFrame) -> DataFrame:
    """Degree / (n - 1) per node. n is one scalar computed first (a count, not a collect).

    The degree table (one row per node) is checkpointed, so counting it and
    returning it do not evaluate the edge list twice.
    """
    checkpoint_dir(edges.sparkSession)
    deg = degrees(edges).checkpoint()
    n = deg.count()
    denom = F.lit(float(n - 1)) if n > 1 else F.lit(None).cast("double")
    return deg.select("node", "degree", (F.col("degree") / denom).alias("centrality"))


def _oriented(edges: DataFrame, deg: DataFrame | None = None) -> DataFrame:
    """Each edge once, from the lower to the higher (degree, node) rank."""
    deg = degrees(edges) if deg is None else deg
    e = (edges.join(deg.select(F.col("node").alias("src"), F.col("degree").alias("ds")), "src")
              .join(deg.select(F.col("node").alias("dst"), F.col("degree").alias("dd")), "dst"))
    src_low = (F.col("ds") < F.col("dd")) | ((F.col("ds") == F.col("dd")) & (F.col("src") < F.col("dst")))
    return e.select(F.when(src_low, F.col("src")).otherwise(F.col("dst")).alias("a"),
                    F.when(src_low, F.col("dst")).otherwise(F.col("src")).alias("b"),
                    F.when(src_low, F.col("dd")).otherwise(F.col("ds")).alias("db"))


def triangles(edges: DataFrame) -> DataFrame:
    """Each triangle once as (a, b, c), found at its lowest-ranked node."""
    o = _oriented(edges)
    w1 = o.select(F.col("a"), F.col("b").alias("x"), F.col("db").alias("dx"))
    w2 = o.select(F.col("a"), F.col("b").alias("y"), F.col("db").alias("dy"))
    wedges = w1.join(w2, "a").filter((F.col("dx") < F.col("dy")) | ((F.col("dx") == F.col("dy")) & (F.col("x") < F.col("y"))))
    close = o.select(F.col("a").alias("x"), F.col("b").alias("y"))
    return wedges.join(close, ["x", "y"]).select(F.col("a"), F.col("x").alias("b"), F.col("y").alias("c"))


#: Edges that one task's share of the graph should hold, about.
CELL_EDGES = 4_000_000
#: Edges in one packed block.
BLOCK_EDGES = 1 << 17
#: Edges that a task gathers before it packs them.
SPLIT_EDGES = 1 << 21
#: Edges or nodes, each counted as often as it is copied, that one round may send.
ROUND_ROWS = 1 << 26
#: Nodes in one packed part of a colour's node list, about.
PART_NODES = 1 << 16
#: Pairs of an edge and a third node that are looked at in one step.
STEP_PAIRS = 1 << 22


def _tint(node, colours: int):
    return F.pmod(F.xxhash64(node), F.lit(colours)).cast("int")


def _packer():
    """The function that tasks pack tables with (made here, so that it is sent to them with its code)."""
    def packed(rows: pa.Table) -> bytes:
        """Sorted rows as one small Parquet file: neighbouring ids differ little, so most of their bytes go."""
        delta = {pa.int64(): "DELTA_BINARY_PACKED", pa.int32(): "DELTA_BINARY_PACKED", pa.string(): "DELTA_BYTE_ARRAY"}
        encoding = {f.name: delta[f.type] for f in rows.schema if f.type in delta}
        out = pa.BufferOutputStream()
        pq.write_table(rows, out, compression="zstd", use_dictionary=False, column_encoding=encoding or None, write_statistics=False)
        return out.getvalue().to_pybytes()

    return packed


def _summer():
    """The function that tasks add packed counts with."""
    def summed(packs) -> np.ndarray:
        total = np.zeros(0, np.int64)
        for pack in packs:
            counts = pq.read_table(pa.BufferReader(pack.as_buffer()))["n"].to_numpy()
            longer, shorter = (counts.copy(), total) if len(counts) > len(total) else (total, counts)
            longer[:len(shorter)] += shorter
            total = longer
        return total

    return summed


def packed_blocks(edges: DataFrame, colours: int) -> DataFrame:
    """(ca, cb, edges): the edges (a, b) of each task, packed by their ends' colours into blocks of a few bytes an edge; no shuffle."""
    packed, block, split = _packer(), BLOCK_EDGES, SPLIT_EDGES

    def pack(batches):
        def blocks(held):
            rows = pa.Table.from_batches(held)
            pair = rows["ca"].to_numpy().astype(np.int64) * colours + rows["cb"].to_numpy()
            order = np.argsort(pair, kind="stable")
            pairs, first = np.unique(pair[order], return_index=True)
            rows = rows.select(["a", "b"]).take(pa.array(order))
            out = []
            for c, lo, hi in zip(pairs.tolist(), first, [*first[1:], len(order)]):
                part = rows.slice(lo, hi - lo).sort_by([("a", "ascending"), ("b", "ascending")])
                out += [(c // colours, c % colours, packed(part.slice(at, block))) for at in range(0, len(part), block)]
            ca, cb, data = zip(*out)
            return pa.RecordBatch.from_arrays([pa.array(ca, pa.int32()), pa.array(cb, pa.int32()), pa.array(data, pa.binary())], names=["ca", "cb", "edges"])

        held, n = [], 0
        for batch in batches:
            if len(batch):
                held.append(batch)
                n += len(batch)
            if n >= split:
                yield blocks(held)
                held, n = [], 0
        if held:
            yield blocks(held)

    return edges.select("a", "b", _tint("a", colours).alias("ca"), _tint("b", colours).alias("cb")).mapInArrow(pack, "ca int, cb int, edges binary")


def dealt_blocks(edges: DataFrame, colours: int, least: tuple[int, int] | None = None) -> DataFrame:
    """(cell, ca, cb, edges): packed blocks of edges (edges (a, b) are packed first), a row for each cell a block goes to.

    With ``least`` = (lo, hi) only of the cells whose least colour c is lo <= c < hi.
    """
    blocks = edges if "edges" in edges.columns else packed_blocks(edges, colours)
    lo, hi = least or (0, colours)
    smallest = lambda k: F.least("ca", "cb", k)
    third = F.filter(F.sequence(F.lit(0), F.lit(colours - 1)), lambda k: (smallest(k) >= lo) & (smallest(k) < hi))
    return (blocks.select("*", F.explode(third).alias("k"))
            .select(F.array_sort(F.array("ca", "cb", "k")).alias("cell"), "ca", "cb", "edges"))


def packed_nodes(deg: DataFrame, colours: int, parts: int) -> DataFrame:
    """(colour, part, nodes): each colour's nodes and degrees, packed in parts by hash. A node's number among its colour's is place * ``parts`` + part."""
    packed = _packer()

    def pack(rows: pa.Table) -> pa.Table:
        data = packed(rows.select(["node", "degree"]).sort_by("node"))
        return pa.table({"colour": rows["colour"][:1], "part": rows["part"][:1], "nodes": pa.array([data], pa.binary())})

    return (deg.filter("node IS NOT NULL")
            .select("node", "degree", _tint("node", colours).alias("colour"), F.pmod(F.xxhash64("node", F.lit(1)), F.lit(parts)).cast("int").alias("part"))
            .groupBy("colour", "part").applyInArrow(pack, "colour int, part int, nodes binary"))


def oriented_blocks(edges: DataFrame, nodes: DataFrame, colours: int, parts: int, least: tuple[int, int]) -> DataFrame:
    """(ca, cb, edges): packed blocks of the edges (a, b), nodes as their numbers, from the lower to the higher (degree, colour, number).

    Edges are packed where they are read and sent to their pair of colours once, with the two packed node lists, so no edge
    is joined with a degree row by row. Only pairs whose lesser colour c is lo <= c < hi, of ``least`` = (lo, hi).
    """
    packed, block, at_once = _packer(), BLOCK_EDGES, 16 * PART_NODES
    lo, hi = least
    wanted = lambda x, y: (F.least(x, y) >= lo) & (F.least(x, y) < hi)
    cs, cd = _tint("src", colours), _tint("dst", colours)
    pairs = edges.filter(F.col("src").isNotNull() & F.col("dst").isNotNull() & wanted(cs, cd)).select(
        F.when(cs > cd, F.col("dst")).otherwise(F.col("src")).alias("a"), F.when(cs > cd, F.col("src")).otherwise(F.col("dst")).alias("b"))
    other = F.explode(F.filter(F.sequence(F.lit(0), F.lit(colours - 1)), lambda k: wanted(F.col("colour"), k)))
    lists = (nodes.select("*", other.alias("k"))
             .select(F.least("colour", "k").alias("ca"), F.greatest("colour", "k").alias("cb"), "colour", "part", F.col("nodes").alias("rows")))
    none = F.lit(None).cast("int")
    both = packed_blocks(pairs, colours).select("ca", "cb", none.alias("colour"), none.alias("part"), F.col("edges").alias("rows")).unionAll(lists)

    def orient(rows: pa.Table) -> pa.Table:
        ca, cb = rows["ca"][0].as_py(), rows["cb"][0].as_py()
        found = list(zip(rows["colour"].to_pylist(), rows["part"].to_pylist(), (r.as_buffer() for r in rows["rows"])))
        edges = [pq.read_table(pa.BufferReader(r)) for c, _, r in found if c is None]

        def looked_up(ids: pa.ChunkedArray, colour: int) -> tuple[np.ndarray, np.ndarray]:
            """Numbers and degrees of the nodes, of one colour; its list is looked at a piece at a time."""
            coded = ids.combine_chunks().dictionary_encode()
            number, degree = (np.full(len(coded.dictionary), -1, np.int64) for _ in range(2))
            held, numbers = [], []
            of = [(p, r) for c, p, r in found if c == colour]
            for i, (part, r) in enumerate(of):
                held.append(pq.read_table(pa.BufferReader(r)))
                numbers.append(np.arange(len(held[-1])) * parts + part)
                if sum(map(len, numbers)) >= at_once or i == len(of) - 1:
                    known, code = pa.concat_tables(held), np.concatenate(numbers)
                    at = pc.index_in(coded.dictionary, value_set=known["node"].combine_chunks())
                    there, at = at.is_valid().to_numpy(zero_copy_only=False), at.drop_null().to_numpy()
                    number[there], degree[there] = code[at], known["degree"].to_numpy()[at]
                    held, numbers = [], []
            if (number < 0).any():
                raise ValueError("an edge's end has no degree")
            code = coded.indices.to_numpy()
            return number[code], degree[code]

        out = {"ca": [], "cb": [], "edges": []}
        if edges:
            edges = pa.concat_tables(edges)
            (a, da), (b, db) = looked_up(edges["a"], ca), looked_up(edges["b"], cb)
            up = (da < db) | ((da == db) & ((a <= b) | (ca < cb)))
            if ca == cb:
                sides = [(ca, cb, np.where(up, a, b) << 32 | np.where(up, b, a))]
            else:
                sides = [(ca, cb, a[up] << 32 | b[up]), (cb, ca, b[~up] << 32 | a[~up])]
            for x, y, key in sides:
                key = np.sort(key)
                for at in range(0, len(key), block):
                    part = key[at:at + block]
                    out["ca"].append(x), out["cb"].append(y)
                    out["edges"].append(packed(pa.table({"a": (part >> 32).astype(np.int32), "b": (part & 0xFFFFFFFF).astype(np.int32)})))
        return pa.table({"ca": pa.array(out["ca"], pa.int32()), "cb": pa.array(out["cb"], pa.int32()), "edges": pa.array(out["edges"], pa.binary())})

    return both.groupBy("ca", "cb").applyInArrow(orient, "ca int, cb int, edges binary")


def cell_counts(dealt: DataFrame, parts: int) -> DataFrame:
    """(colour, part, counts): packed triangle counts of a colour's nodes, of all cells together, from blocks dealt to cells.

    A cell counts the triangles whose three colours are its own, for each order (x, y, z) of them: of every edge from x to y the shorter
    of its ends' lists of neighbours in z, and the other end's edges to them are looked up, in bounded steps.
    """
    packed, most = _packer(), STEP_PAIRS

    def count(rows: pa.Table) -> pa.Table:
        cell = sorted(rows["cell"][0].as_py())
        parted = {}
        for ca, cb, data in zip(rows["ca"].to_pylist(), rows["cb"].to_pylist(), rows["edges"]):
            part = pq.read_table(pa.BufferReader(data.as_buffer()))
            a = part["a"].to_numpy().astype(np.int64)
            parted.setdefault((ca, cb), []).append(a << 32 | part["b"].to_numpy())
        blocks, ends = {}, {c: [] for c in cell}
        for pair in list(parted):
            key = np.concatenate(sorted(parted.pop(pair), key=lambda k: k[0]))
            blocks[pair] = [key, (key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.int32)]
            ends[pair[0]].append(blocks[pair][1]), ends[pair[1]].append(blocks[pair][2])
        n, present = {}, {}
        for c, seen in ends.items():
            n[c] = max((int(s.max()) + 1 for s in seen), default=0)
            if n[c] > 4 * sum(map(len, seen)):  # of a sparse graph's nodes only those in the cell are numbered
                present[c] = np.unique(np.concatenate(seen))
                n[c] = len(present[c])
        for pair, block in blocks.items():
            for at, c in enumerate(pair, 1):
                if c in present:
                    block[at] = np.searchsorted(present[c], block[at]).astype(np.int32)
            if set(pair) & set(present):
                block[0] = block[1].astype(np.int64) << 32 | block[2]
            out = np.bincount(block[1], minlength=n[pair[0]])
            block += [out, np.cumsum(out) - out]
        triangles = {c: np.zeros(n[c], np.int64) for c in n}

        def close(order, pick, lists, rest, ends, others):
            """The triangles of those edges whose third node is looked for in the lists of their ``ends``, and then at ``others``."""
            _, a, b, _, _ = blocks[order[:2]]
            _, _, near, out, first = lists
            sizes = out[ends]
            past = np.concatenate([[0], np.cumsum(sizes)])
            lo = 0
            while lo < len(pick):
                hi = max(lo + 1, int(np.searchsorted(past, past[lo] + most, side="right")) - 1)
                edge = np.repeat(np.arange(lo, hi), sizes[lo:hi])
                c = near[np.arange(past[lo], past[hi]) + (first[ends] - past[:-1])[edge]]
                wanted = others[edge].astype(np.int64) << 32 | c
                at = np.minimum(np.searchsorted(rest[0], wanted), len(rest[0]) - 1)
                hit = rest[0][at] == wanted
                edge = pick[edge[hit]]
                for colour, nodes in zip(order, (a[edge], b[edge], c[hit])):
                    triangles[colour] += np.bincount(nodes, minlength=n[colour])
                lo = hi

        for order in sorted(set(itertools.permutations(cell))):
            x, y, z = order
            if {(x, y), (x, z), (y, z)} <= set(blocks):
                _, a, b, _, _ = blocks[x, y]
                xz, yz = blocks[x, z], blocks[y, z]
                ours, theirs = xz[3][a], yz[3][b]
                pick = np.flatnonzero((ours > 0) & (ours <= theirs))
                close(order, pick, xz, yz, a[pick], b[pick])
                pick = np.flatnonzero((theirs > 0) & (ours > theirs))
                close(order, pick, yz, xz, b[pick], a[pick])
        out = []
        for c, counts in triangles.items():
            hit = np.flatnonzero(counts)
            place, part = np.divmod(present[c][hit] if c in present else hit, parts)
            order = np.argsort(part, kind="stable")
            of, first = np.unique(part[order], return_index=True)
            for p, picked in zip(of.tolist(), np.split(order, first[1:])):
                dense = np.zeros(place[picked].max() + 1, np.int64)
                dense[place[picked]] = counts[hit[picked]]
                out.append((c, p, packed(pa.table({"n": dense}))))
        colour, part, data = zip(*out) if out else ((), (), ())
        return pa.table({"colour": pa.array(colour, pa.int32()), "part": pa.array(part, pa.int32()), "counts": pa.array(data, pa.binary())})

    summed = _summer()

    def add(rows: pa.Table) -> pa.Table:
        return pa.table({"colour": rows["colour"][:1], "part": rows["part"][:1], "counts": pa.array([packed(pa.table({"n": summed(rows["counts"])}))], pa.binary())})

    kind = "colour int, part int, counts binary"
    return dealt.groupBy("cell").applyInArrow(count, kind).groupBy("colour", "part").applyInArrow(add, kind)


def rounds(sent: list[float], most: float) -> list[tuple[int, int]]:
    """Ranges (lo, hi) of 0..len(sent) - 1, in each of which ``sent`` sums up to at most ``most``, or that hold one number."""
    out, held = [], 0
    for c, more in enumerate(sent):
        if not out or held + more > most:
            out.append((c, c + 1))
            held = more
        else:
            out[-1] = (out[-1][0], c + 1)
            held += more
    return out


def triangle_counts(edges: DataFrame, deg: DataFrame, n_edges: int, cell_edges: int = CELL_EDGES) -> DataFrame:
    """(node, triangles) of the nodes in any triangle, as a written table, of edges (src, dst), each once, and their degrees.

    Nodes get one of C colours by hash, and an edge goes to the C cells {its two colours, any colour}. A triangle's three edges meet in
    the cell of its three colours and are counted there alone. So no wedge leaves a task, and a cell
    holds about 6 m / C^2 edges; C follows from that and ``cell_edges``. Edges are gathered by their two colours once, packed and written;
    the packed blocks are what is sent to C cells each, in rounds over the cells' least colours. A round's shuffle is deleted when
    its counts are written, so the disk holds at most about 3 copies of the packed edges at a time, whatever C is. The node lists are sent
    to the pairs of colours in such rounds too; in all but sparse graphs that is one.
    """
    spark, kind = edges.sparkSession, deg.schema["node"].dataType
    colours = max(1, math.ceil(math.sqrt(6 * max(n_edges, 1) / max(1, cell_edges))))
    n = deg.count()
    parts = max(1, math.ceil(n / colours / PART_NODES))
    nodes, nodes_path = written(packed_nodes(deg, colours, parts), "nodes", free=True)
    real = isinstance(kind, (T.DoubleType, T.FloatType))
    ends = edges.select(*[(F.col(c).cast(kind) + F.lit(0.0).cast(kind) if real else F.col(c).cast(kind)).alias(c) for c in ("src", "dst")])  # -0.0 is 0.0
    left = [(colours - c) / colours for c in range(colours)]
    oriented = [written(oriented_blocks(ends, nodes, colours, parts, least), "oriented", free=True)
                for least in rounds([2 * n * x for x in left], max(ROUND_ROWS, 3 * n_edges))]
    blocks = spark.read.schema("ca int, cb int, edges binary").parquet(*(path for _, path in oriented))
    counted = [written(cell_counts(dealt_blocks(blocks, colours, least), parts), "counts", free=True)
               for least in rounds([3 * n_edges * x * x for x in left], max(ROUND_ROWS, n_edges))]
    summed = _summer()

    def named(rows: pa.Table) -> pa.Table:
        total = summed(c for c in rows["counts"] if c.is_valid)
        names = pq.read_table(pa.BufferReader(next(r for r in rows["nodes"] if r.is_valid).as_buffer()))["node"].combine_chunks()
        hit = np.flatnonzero(total)
        return pa.table({"node": names.take(pa.array(hit)), "triangles": pa.array(total[hit])})

    none = F.lit(None).cast("binary")
    counts = spark.read.schema("colour int, part int, counts binary").parquet(*(path for _, path in counted))
    rows = nodes.withColumn("counts", none).unionAll(counts.select("colour", "part", none.alias("nodes"), "counts"))
    per, _ = written(rows.groupBy("colour", "part").applyInArrow(named, T.StructType([T.StructField("node", kind), T.StructField("triangles", T.LongType())])),
                     "triangles", free=True)
    for path in (nodes_path, *(path for _, path in oriented + counted)):
        discard(spark, path)
    return per


def local_clustering(edges: DataFrame, cell_edges: int = CELL_EDGES) -> DataFrame:
    """Per node: triangles T and clustering 2T / (d (d - 1)); 0 when d < 2. The degrees are written once."""
    deg, _ = written(degrees(edges), "degrees", free=True)
    per = triangle_counts(edges, deg, edges.count(), cell_edges)
    d = F.col("degree")
    return deg.join(per, "node", "left").select(
        "node", "degree", F.coalesce("triangles", F.lit(0)).alias("triangles"),
        F.when(d > 1, 2 * F.coalesce("triangles", F.lit(0)) / (d * (d - 1))).otherwise(F.lit(0.0)).alias("clustering"))


def average_clustering(edges: DataFrame) -> DataFrame:
    """Mean local clustering over all nodes, plus the triangle count; one row.

    The edge list feeds the degrees and the orientation, so
    it is written once (to the shared folder) instead of
    being recomputed from its sources by each branch.
    """
    edges, path = written(edges.select("src", "dst"), "edges", free=True)
    lc = local_clustering(edges)
    discard(edges.sparkSession, path)
    return lc.agg(F.avg("clustering").alias("average_clustering"),
                  (F.sum("triangles") / 3).cast("bigint").alias("triangles"))


def _nodes(edges: DataFrame, t: int) -> tuple[DataFrame, str, dict]:
    """Per end of edges (hi, lo): its least smaller neighbour and its numbers of smaller and larger ones, as a written table.

    Repeated edges count as often as they occur. Also observed while that table is written: the nodes that keep their
    component from being a star about its least node, and the nodes with more than ``t`` edges to smaller or larger neighbours.
    """
    none = F.lit(None).cast(edges.schema["lo"].dataType)
    ends = edges.select(F.col("hi").alias("node"), F.col("lo").alias("least"), F.lit(1).alias("below"), F.lit(0).alias("above")) \
        .unionAll(edges.select("lo", none, F.lit(0), F.lit(1)))
    nodes = ends.groupBy("node").agg(F.min("least").alias("least"), F.max("least").alias("most"), F.sum("below").alias("below"), F.sum("above").alias("above"))
    below, above = F.col("below"), F.col("above")
    obs = Observation(f"nodes_{uuid.uuid4().hex[:8]}")
    nodes, path = written(nodes.observe(
        obs, F.count_if((F.col("least") < F.col("most")) | ((below > 0) & (above > 0))).alias("unsettled"),
        F.count_if(below > t).alias("hubs_below"), F.count_if(above > t).alias("hubs_above")).drop("most"), "nodes")
    return nodes, path, obs.get


def dealt_hubs(edges: DataFrame, nodes: DataFrame, end: str, t: int) -> tuple[DataFrame, DataFrame]:
    """Both sides of the join of edges with the node at their ``end``, in pieces of about ``t`` edges a node (column ``piece``).

    A node with more edges gets as many rows as pieces; its edges go to a piece by the hash of their other end. The list of
    such nodes is broadcast: each has over ``t`` edges, so it has fewer than edges / t rows.
    """
    count, other = ("below", "lo") if end == "hi" else ("above", "hi")
    hubs = F.broadcast(nodes.filter(F.col(count) > t).select(F.col("node").alias("hub"), F.ceil(F.col(count) / t).cast("int").alias("pieces")))
    pieces = F.coalesce("pieces", F.lit(1))
    left = (edges.join(hubs, F.col(end) == F.col("hub"), "left")
            .select("hi", "lo", F.pmod(F.xxhash64(other), pieces).cast("int").alias("piece")))
    right = (nodes.join(hubs, F.col("node") == F.col("hub"), "left")
             .select("node", "least", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece")))
    return left, right


def _at(edges: DataFrame, nodes: DataFrame, end: str, t: int, hubs: int) -> DataFrame:
    """edges (hi, lo) with ``least`` of the node at their ``end`` (NULL where it has no smaller neighbour)."""
    wanted = nodes.filter("below > 0").select("node", "least")
    if not hubs:
        return edges.join(wanted, F.col(end) == F.col("node"), "left")
    left, right = dealt_hubs(edges, nodes, end, t)
    right = right.withColumnRenamed("piece", "part")
    return left.join(right, (F.col(end) == F.col("node")) & (F.col("piece") == F.col("part")), "left")


#: Edges a node from which on a graph is contracted along least neighbours before its stars are made.
DENSE = 4


def _stars(rest: DataFrame, t: int, max_rounds: int | None = None, first: tuple | None = None) -> tuple[DataFrame, str | None]:
    """Edges (hi, lo) turned into one star about the least node for each component, and the path of the table that holds them.

    ``rest`` may repeat edges; where they are stars already they are returned as they are, without a path. ``first`` is what
    ``_nodes`` gives for them, if that is known.
    """
    spark, past, done = rest.sparkSession, None, 0
    while True:
        nodes, nodes_path, seen = first or _nodes(rest, t)
        first = None
        if not seen["unsettled"]:
            discard(spark, nodes_path)
            return rest, past
        if max_rounds is not None and done >= max_rounds:
            raise RuntimeError(f"components have not converged in max_rounds={max_rounds} rounds")
        large, large_path = written(_at(rest, nodes, "lo", t, seen["hubs_above"])
                                    .select("hi", F.coalesce("least", "lo").alias("lo")).distinct(), "large-star")
        mids, mids_path, seen = _nodes(large, t)
        both = F.inline(F.array(F.struct(F.col("lo").alias("hi"), F.col("least").alias("lo")), F.struct("hi", F.col("least").alias("lo"))))
        rest, path = written(_at(large, mids, "hi", t, seen["hubs_below"]).select(both).filter("hi > lo").distinct(), "small-star")
        for old in (nodes_path, large_path, mids_path, past):
            if old:
                discard(spark, old)
        past = path
        done += 1


def _contracted(rest: DataFrame, nodes: DataFrame, seen: dict, t: int, max_rounds: int | None) -> DataFrame:
    """The stars of a graph with many edges a node, for two shuffles of its edges.

    The edges to each node's least smaller neighbour are a forest of fewer edges than nodes; its stars are made first. Only the edges
    between different stars are left to be joined up, each pair of stars once.
    """
    forest, forest_path = _stars(nodes.filter("below > 0").select(F.col("node").alias("hi"), F.col("least").alias("lo")), t, max_rounds)
    root = forest.select(F.col("hi").alias("node"), F.col("lo").alias("least"))
    roots, roots_path = written(nodes.select("node", "below", "above").join(root, "node", "left"), "roots")
    half = _at(rest, roots, "lo", t, seen["hubs_above"]).select("hi", F.coalesce("least", "lo").alias("lo"))
    half = half.distinct() if seen["hubs_below"] else half  # a hub's edges are dealt by their other ends
    a, b = F.coalesce("least", "hi"), F.col("lo")
    cross, cross_path = written(_at(half, roots, "hi", t, seen["hubs_below"]).filter(a != b)
                                .select(F.greatest(a, b).alias("hi"), F.least(a, b).alias("lo")).distinct(), "cross")
    joined, joined_path = _stars(cross, t, max_rounds)
    up = joined.select(F.col("hi").alias("root"), F.col("lo").alias("top"))
    stars, _ = written(forest.join(up, F.col("lo") == F.col("root"), "left").select("hi", F.coalesce("top", "lo").alias("lo")).unionAll(joined), "stars")
    for path in {forest_path, roots_path, cross_path, joined_path} - {None}:
        discard(rest.sparkSession, path)
    return stars


def component_labels(edges: DataFrame, max_rounds: int | None = None, hub_rows: int = 500_000, dense: float = DENSE) -> DataFrame:
    """(node, label) where label = smallest node id reachable. Edges with a NULL end are left out; edges may be repeated.

    Alternating contraction into stars (Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii, "Connected components in
    MapReduce and beyond", SoCC 2014). An edge is (hi, lo), hi > lo. A large star hangs each node's larger neighbours on the
    least of the node and its neighbours; a small star hangs its smaller ones and the node itself there. Both are a lookup of
    that least neighbour (a partial aggregate) at one end of the edges. A hub's edges are looked up in pieces of at most about
    ``hub_rows`` (and at least a 100,000th of all edges, which bounds the list of hubs). The number of edges never grows.
    A graph with more than ``dense`` edges a node is contracted first, so that the rounds pass over its nodes and not its edges.

    Each step's tables lie in the shared folder, so lineage stays flat and a lost executor recomputes one step; those of past
    steps are deleted. The loop ends when every component is a star about its least node. ``max_rounds`` is a guard, not
    a cut: if it is reached before that, the function raises.
    """
    ends = edges.filter("src IS NOT NULL AND dst IS NOT NULL").select(F.greatest("src", "dst").alias("hi"), F.least("src", "dst").alias("lo"))
    whole, _ = written(ends, "edges")
    rest = whole.filter("hi > lo")
    n = whole.count()
    t = max(hub_rows, n // 100_000)
    nodes, nodes_path, seen = _nodes(rest, t)
    if seen["unsettled"] and n > dense * nodes.count():
        stars = _contracted(rest, nodes, seen, t, max_rounds)
        discard(edges.sparkSession, nodes_path)
    else:
        stars, _ = _stars(rest, t, max_rounds, (nodes, nodes_path, seen))
    roots = stars.select("lo", "lo").unionAll(whole.filter("hi = lo"))  # least nodes, and nodes known by an edge to themselves
    return stars.unionAll(roots).groupBy(F.col("hi").alias("node")).agg(F.min("lo").alias("label"))


def component_sizes(edges: DataFrame, **kw) -> DataFrame:
    """G6 result table: one row per component (smallest node id, size)."""
    return component_labels(edges, **kw).groupBy(F.col("label").alias("component")).agg(
        F.count(F.lit(1)).alias("size"))

"""Operator 2, n-gram Jaccard join: a count-vector R-tree over shingle sets.

A text's set holds its distinct k-word shingles (64-bit hashes). Shingles are hashed into groups; a set's point has
as coordinate g the number of its shingles in group g. Whatever two sets share lies group by group below both
counts, so the sum of the smaller coordinates bounds their overlap, and the summed minima of two boxes' upper
corners bound it for all pairs between them.

One tree over all points would prune little: with many dimensions, most boxes of a large corpus lie near each other.
So its top level cuts the space along very fine groups (one per shingle hash): two sets of Jaccard similarity t or more
must both have mass on one of the first n - ceil(t n) + 1 axes of either, in any order of the axes common to all.
The order is by the mass of the coarse groups, rarest first (a table of fixed size), so common passages open no
axis unless a text has little else. Each axis with two or more sets is a cell.

1. ``describe``: one scan gives set sizes, set identities (equal sets become one point), points and the group masses.
2. ``cells``: a second scan deals each set to its first axes; cells of one set end here.
3. In each cell every set is held against the commonest set that its size allows, of all members the likeliest
   original (linear in the cell's size). Links found so merge into components; a group of near copies is then one
   component at nearly no cost.
4. Cells that still hold two components get an R-tree over their count vectors. First each leaf's points are held
   against each other; after merging, the trees of the cells left are joined with themselves, leaving out box pairs
   within one component, pairs of sizes too different, and those below the overlap bound. Cells beyond
   ``CELL_ROWS`` are cut into blocks, and each pair of blocks is a task of its own.
5. All surviving pairs are verified on the whole sets, exactly. Only the sets concerned leave the scan that makes them
   (a filter of fixed size names them), so texts are never shuffled.

No link between different texts is lost: a linked pair meets in a cell, and is verified there or already connected.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from featurelake.llm.common import keep, mix, shingles, slices, utf8, word_hashes
from featurelake.session import discard, written

#: Coarse groups whose masses order the axes, and the pieces in which their table is summed.
MASS_BITS, PIECE_BITS = 20, 12
#: Dimensions of a point. A count of 255 means "or more" and bounds nothing.
DIMS = 256
CELL_ROWS = 50_000
LEAF, FANOUT = 16, 8
_U = np.uint64


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) for each row of (doc_id, text)."""
    at = 0
    for part in slices(batch):
        data, offsets = utf8(part.column(batch.schema.get_field_index("text")))
        found, first = shingles(*word_hashes(data, offsets), k=k)
        for i in range(part.num_rows):
            own = found[first[i]:first[i + 1]]
            yield at + i, np.unique(own) if len(own) > 1 else own
        at += part.num_rows


def _identity(s: np.ndarray) -> int:
    return int(mix(s).sum(dtype=_U).view(np.int64))


def describe(docs: DataFrame, k: int = 5) -> DataFrame:
    """Rows (doc_id, n_shingles, set, counts) of every document (set: 0 for none), and rows (piece, masses) of each task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass = np.zeros(1 << MASS_BITS, np.int32)
        for batch in batches:
            n, sets, counts = [], [], []
            for _, s in _sets(batch, k):
                n.append(len(s))
                sets.append(_identity(s))
                counts.append(np.minimum(np.bincount((s & _U(DIMS - 1)).astype(np.int64), minlength=DIMS), 255).astype(np.uint8).tobytes() if len(s) else None)
                np.add.at(mass, (s >> _U(64 - MASS_BITS)).astype(np.int64), 1)
            rows = len(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(sets, pa.int64()), pa.array(counts, pa.binary()),
                                              pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary())], names=names)
        pieces = mass.reshape(-1, 1 << PIECE_BITS)
        some = np.flatnonzero(pieces.any(1))
        yield pa.RecordBatch.from_arrays([*[pa.nulls(len(some), pa.int64())] * 3, pa.nulls(len(some), pa.binary()), pa.array(some, pa.int32()),
                                          pa.array([pieces[i].tobytes() for i in some], pa.binary())], names=names)

    names = ["doc_id", "n_shingles", "set", "counts", "piece", "masses"]
    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, set long, counts binary, piece int, masses binary")


def _masses(described: DataFrame) -> np.ndarray:
    """The groups' masses over all documents: a table of 2 ** MASS_BITS counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, masses in zip(batch.column(0).to_pylist(), batch.column(1)):
                more = np.frombuffer(masses.as_buffer(), np.int32)
                total[piece] = total[piece] + more if piece in total else more.astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([x.tobytes() for x in total.values()], pa.binary())], names=["piece", "masses"])

    got = described.filter("piece IS NOT NULL").select("piece", "masses").repartition("piece").mapInArrow(run, "piece int, masses binary").toArrow()
    out = np.zeros((1 << MASS_BITS - PIECE_BITS, 1 << PIECE_BITS), np.int64)
    for piece, masses in zip(got["piece"].to_pylist(), got["masses"].to_pylist()):
        out[piece] = np.frombuffer(masses, np.int64)
    return np.minimum(out.ravel(), 2**32 - 1).astype(np.uint32)


def _at_least(n: np.ndarray | int, percent: int):
    """ceil(percent * n / 100)"""
    return -(-n * percent // 100)


def _cells(docs: DataFrame, masses: np.ndarray, k: int, percent: int) -> DataFrame:
    """(axis, set, n, hub): the members of each axis with two or more sets, and the set each is to be held against first."""
    shared = docs.sparkSession.sparkContext.broadcast(masses)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mass, seen = shared.value, set()
        for batch in batches:
            axes, sets, sizes, common = [], [], [], []

            def rows() -> pa.RecordBatch:
                n = np.array(sizes, np.int32)
                each = np.array([len(x) for x in axes], np.int64)
                return pa.RecordBatch.from_arrays([pa.array(np.concatenate(axes).view(np.int64) if axes else np.zeros(0, np.int64)), pa.array(np.repeat(np.array(sets, np.int64), each)),
                                                   pa.array(np.repeat(n, each)), pa.array(np.repeat(np.array(common, np.int32), each))], names=["axis", "set", "n", "common"])
            for _, s in _sets(batch, k):
                if not len(s) or (me := _identity(s)) in seen:
                    continue
                seen.add(me)
                p = len(s) - int(_at_least(len(s), percent)) + 1
                own = mass[(s >> _U(64 - MASS_BITS)).astype(np.int64)]
                order = (own.astype(_U) << _U(32)) | (s & _U(0xFFFFFFFF))
                common.append(int(1000 * np.log2(own + 1.0).mean()))
                axes.append(s[np.argpartition(order, p - 1)[:p]] if p < len(s) else s)
                sets.append(me)
                sizes.append(len(s))
                if len(axes) >= 2000:
                    yield rows()
                    axes, sets, sizes, common = [], [], [], []
            yield rows()

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            cols = [batch.column(i).to_numpy() for i in range(4)]
            if held is not None:
                cols = [np.concatenate([a, b]) for a, b in zip(held, cols)]
            axis = cols[0]
            cut = int(np.searchsorted(axis, axis[-1])) if len(axis) else 0  # the last axis may go on in the next batch
            yield _members([c[:cut] for c in cols], percent)
            held = [c[cut:] for c in cols]
        if held is not None:
            yield _members(held, percent)

    dealt = docs.select("doc_id", "text").mapInArrow(deal, "axis long, set long, n int, common int")
    return (dealt.repartition("axis").sortWithinPartitions("axis", "n", "set")
            .mapInArrow(meet, "axis long, set long, n int, hub long"))


def _members(cols: list[np.ndarray], percent: int) -> pa.RecordBatch:
    new = np.ones(len(cols[0]), bool)
    new[1:] = (cols[0][1:] != cols[0][:-1]) | (cols[1][1:] != cols[1][:-1]) | (cols[2][1:] != cols[2][:-1])
    cols = [c[new] for c in cols]
    same = cols[0][1:] == cols[0][:-1]
    several = np.zeros(len(cols[0]), bool)
    several[1:] |= same
    several[:-1] |= same
    axis, sets, n, common = (c[several] for c in cols)
    hub, none = np.empty(len(axis), np.int64), np.zeros(len(axis), bool)
    at = np.flatnonzero(np.diff(axis, prepend=axis[:1] - 1)) if len(axis) else []
    todo = list(zip(at, [*at[1:], len(axis)]))
    while todo:  # members come by size; the commonest serves all sizes near its own
        lo, hi = todo.pop()
        h = lo + int(common[lo:hi].argmax())
        a = lo + int(np.searchsorted(n[lo:hi], _at_least(int(n[h]), percent)))
        b = lo + int(np.searchsorted(n[lo:hi], int(n[h]) * 100 // percent, side="right"))
        hub[a:b], none[h] = sets[h], True
        if lo < a:
            todo.append((lo, a))
        if b < hi:
            todo.append((b, hi))
    return pa.RecordBatch.from_arrays([pa.array(axis), pa.array(sets), pa.array(n), pa.array(hub, mask=none)], names=["axis", "set", "n", "hub"])


FILTER_BITS = 24


def _wholes(docs: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """(set, members): the sorted shingle hashes of wanted (set, rep), from one scan of docs.

    The scan passes over documents by a bit table of the wanted ids, of fixed size. It lets a few others through by
    chance, which no join asks for; a set that comes twice so gives its links twice.
    """
    bit = F.pmod(F.xxhash64("rep"), F.lit(1 << FILTER_BITS))
    got = (wanted.select(F.shiftright(bit, 6).cast("int").alias("word"), F.expr("shiftleft(1L, cast(pmod(xxhash64(rep), 64) as int))").alias("bit"))
           .groupBy("word").agg(F.expr("bit_or(bit)").alias("bits")).toArrow())
    bits = np.zeros(1 << FILTER_BITS - 6, np.uint64)
    bits[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h = batch.column(2).to_numpy()
            batch = batch.select([0, 1])
            batch = batch.filter(pa.array((shared.value[h >> 6] >> (h & 63).astype(np.uint64) & _U(1)).astype(bool)))
            for lo, hi, found in _in_runs(_sets(batch, k)):
                yield pa.RecordBatch.from_arrays([pa.array([_identity(s) for s in found], pa.int64()),
                                                  pa.array([s.tobytes() for s in found], pa.binary())], names=["set", "members"])

    return (docs.select("doc_id", "text", F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS)).alias("h")).filter("doc_id IS NOT NULL")
            .mapInArrow(run, "set long, members binary"))


def _in_runs(sets: Iterator[tuple[int, np.ndarray]], size: int = 1 << 20) -> Iterator[tuple[int, int, list[np.ndarray]]]:
    lo, found, held = 0, [], 0
    for i, s in sets:
        found.append(s)
        held += len(s)
        if held >= size:
            yield lo, i + 1, found
            lo, found, held = i + 1, [], 0
    if found:
        yield lo, lo + len(found), found


def _vectors(column: pa.Array) -> np.ndarray:
    """Points as rows; a full count becomes one that bounds nothing."""
    raw = np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, DIMS).astype(np.int32)
    raw[raw == 255] = 1 << 22
    return raw


def _needed(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """The least overlap of sets of sizes a and b whose Jaccard similarity is percent / 100."""
    return -(-(a.astype(np.int64) + b) * percent // (100 + percent))


def _bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose summed minima reach the overlap needed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 2000):
                part = batch.slice(lo, 2000)
                low = np.minimum(_vectors(part.column(4)), _vectors(part.column(5))).sum(1)
                ok = low >= _needed(part.column(2).to_numpy(), part.column(3).to_numpy(), percent)
                yield part.filter(pa.array(ok)).select([0, 1])

    a = points.select(F.col("set").alias("a"), F.col("n").alias("na"), F.col("counts").alias("ca"))
    b = points.select(F.col("set").alias("b"), F.col("n").alias("nb"), F.col("counts").alias("cb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "na", "nb", "ca", "cb").mapInArrow(run, "a long, b long")


def _verified(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs whose whole sets have the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = np.zeros(batch.num_rows, bool)
            for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield batch.filter(pa.array(ok)).select([0, 1])

    a = points.select(F.col("set").alias("a"), F.col("members").alias("ma"))
    b = points.select(F.col("set").alias("b"), F.col("members").alias("mb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ma", "mb").mapInArrow(run, "a long, b long")


class Tree:
    """An R-tree packed by sorting: by size, then within runs by the coordinate that varies most."""

    def __init__(self, points: np.ndarray, n: np.ndarray, group: np.ndarray):
        order = np.argsort(n, kind="stable")
        run = LEAF * FANOUT * FANOUT
        for lo in range(0, len(n), run):
            self._pack(points, order, lo, min(lo + run, len(n)))
        self.order = order
        p, n, g = points[order], n[order].astype(np.int64), group[order]
        self.levels = [(p, n, n, g, g)]
        width = LEAF
        while len(self.levels[-1][1]) > 1:
            top, n0, n1, g0, g1 = self.levels[-1]
            at = np.arange(0, len(n0), width)
            self.levels.append((np.maximum.reduceat(top, at), np.minimum.reduceat(n0, at), np.maximum.reduceat(n1, at), np.minimum.reduceat(g0, at), np.maximum.reduceat(g1, at)))
            width = FANOUT

    def _pack(self, points: np.ndarray, order: np.ndarray, lo: int, hi: int) -> None:
        if hi - lo <= LEAF:
            return
        own = points[order[lo:hi]]
        axis = int(np.argmax(own.var(0)))
        order[lo:hi] = order[lo:hi][np.argsort(own[:, axis], kind="stable")]
        mid = lo + -(-(hi - lo) // (2 * LEAF)) * LEAF
        if mid < hi:
            self._pack(points, order, lo, mid)
            self._pack(points, order, mid, hi)

    def pairs(self, percent: int, near: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """All pairs of points of different groups whose bounds reach the overlap needed; ``near``: those within a leaf."""
        top = len(self.levels) - 1
        if near and top:
            leaf = np.arange(len(self.levels[1][1]))
            todo = [(1, leaf, leaf)]
        else:
            todo = [(top, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            level, i, j = todo.pop()
            if len(i) > 4096:
                todo += [(level, i[4096:], j[4096:])]
                i, j = i[:4096], j[:4096]
            top, n0, n1, g0, g1 = self.levels[level]
            ok = (g0[i] != g1[j]) | (g1[i] != g0[j])
            ok &= (100 * n1[i] >= percent * n0[j]) & (100 * n1[j] >= percent * n0[i])
            i, j = i[ok], j[ok]
            ok = np.minimum(top[i], top[j]).sum(1) >= _needed(n0[i], n0[j], percent)
            i, j = i[ok], j[ok]
            if not level:
                if len(i):
                    yield self.order[i], self.order[j]
                continue
            width, below = (LEAF if level == 1 else FANOUT), len(self.levels[level - 1][1])
            for lo in range(0, len(i), 512):
                a = (i[lo:lo + 512, None] * width + np.arange(width))[:, :, None]
                b = (j[lo:lo + 512, None] * width + np.arange(width))[:, None, :]
                a, b = (x.ravel() for x in np.broadcast_arrays(a, b))
                ok = (a < below) & (b < below) & ((a < b) | ((a == b) & (level > 1)))
                todo.append((level - 1, a[ok], b[ok]))


def _mixed(cells: DataFrame, labels: DataFrame, cell_rows: int) -> DataFrame:
    """(axis, set, label, blocks): the cells that hold two components; of cells of the same members, one."""
    own = cells.select("axis", "set").join(labels, "set", "left").select("axis", "set", F.coalesce("label", "set").alias("label"))
    some = lambda *seed: F.sum(F.xxhash64("set", *seed).bitwiseAND((1 << 40) - 1))
    mixed = (own.groupBy("axis").agg(F.min("label").alias("least"), F.max("label").alias("most"), F.count(F.lit(1)).alias("rows"),
                                     some().alias("sum"), some(F.lit(1)).alias("other"))
             .filter("least < most").groupBy("rows", "sum", "other").agg(F.min("axis").alias("axis"))
             .select("axis", F.ceil(F.col("rows") / cell_rows).cast("int").alias("blocks")))
    return own.join(mixed, "axis")


def _remaining(mixed: DataFrame, points: DataFrame, percent: int, near: bool) -> DataFrame:
    """(a, b): pairs of different components that survive the tree of a cell they share; ``near``: of a leaf."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids = np.stack([batch.column(i).to_numpy() for i in range(3)])
            at = [0, *(np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(0)) + 1), batch.num_rows]
            for lo, hi in zip(at, at[1:]):
                if held and key != tuple(ids[:, lo]):
                    yield from cell(held)
                    held = []
                key = tuple(ids[:, lo])
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from cell(held)

    def cell(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held).combine_chunks()
        lo, hi = t["lo"][0].as_py(), t["hi"][0].as_py()
        sets, group, block = t["set"].to_numpy(), t["label"].to_numpy(), t["block"].to_numpy()
        tree = Tree(_vectors(t["counts"]), t["n"].to_numpy(), group)
        for i, j in tree.pairs(percent, near):
            ok = group[i] != group[j]
            if lo != hi:
                ok &= block[i] != block[j]
            x, y = sets[i[ok]], sets[j[ok]]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])

    block = F.pmod(F.xxhash64("set", F.lit(2)), F.col("blocks")).cast("int")
    dealt = (mixed.withColumn("block", block)
             .withColumn("with", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("axis", F.least("block", "with").alias("lo"), F.greatest("block", "with").alias("hi"), "set", "label", "block"))
    full = dealt.join(points, "set").select("axis", "lo", "hi", "set", "label", "block", "n", "counts")
    return full.repartition("axis", "lo", "hi").sortWithinPartitions("axis", "lo", "hi").mapInArrow(run, "a long, b long").distinct()


def components(docs: DataFrame, k: int = 5, percent: int = 80, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs (doc_id, text); further columns are left out.

    component_id is the smallest doc_id reachable by links of Jaccard similarity percent / 100 or more. Texts that are
    NULL, empty or without words have no shingles and link with nothing. Rows with a NULL doc_id keep their size and
    get the smallest id among equal sets and their links, or NULL. Repeated rows give repeated results. No rows: no rows.
    """
    described = keep(describe(docs, k), "sets")
    sized = described.filter("piece IS NULL").select("doc_id", "n_shingles", "set", "counts")
    cells = keep(_cells(docs.filter("doc_id IS NOT NULL"), _masses(described), k, percent), "cells")
    reps = sized.filter("n_shingles > 0").groupBy("set").agg(F.min("doc_id").alias("rep"))
    met = reps.join(cells.select("set").distinct(), "set")
    points = keep(sized.join(met.select(F.col("rep").alias("doc_id"), "set"), ["doc_id", "set"]).dropDuplicates(["set"])
                  .select("set", F.col("n_shingles").cast("int").alias("n"), "counts"), "points")

    def linked(pairs: DataFrame) -> DataFrame:
        pairs = keep(pairs, "pairs")
        sets = pairs.select(F.explode(F.array("a", "b")).alias("set")).distinct()
        return keep(_verified(pairs, keep(_wholes(docs, sets.join(reps, "set"), k), "wholes"), percent), "links")

    pairs = cells.filter("hub IS NOT NULL").select(F.least("hub", "set").alias("a"), F.greatest("hub", "set").alias("b")).distinct()
    links = linked(_bounded(pairs, points, percent))
    labels = _labels(links)
    mixed = keep(_mixed(cells, labels, cell_rows), "mixed")
    for near in (True, False):
        more = linked(_remaining(mixed, points, percent, near))
        if more.limit(1).count():
            links = links.unionAll(more)
            labels = _labels(links)
            mixed = keep(_mixed(mixed, labels, cell_rows), "mixed")
    least = reps.join(labels, "set").groupBy("label").agg(F.min("rep").alias("component_id"))
    found = reps.join(labels, "set", "left").join(least, "label", "left").select("set", F.coalesce("component_id", "rep").alias("component_id"))
    return (sized.drop("counts").join(found, "set", "left")
            .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id")))


def _labels(links: DataFrame, salts: int = 8) -> DataFrame:
    """(set, label) of the sets that have links; label = the smallest set reachable.

    Each round: every set takes the minimum label over itself and its neighbours (a partial aggregate, so hubs are combined
    map-side), then jumps to its label's label, which cuts rounds to about the log of the diameter. A jump looks each label in
    use up once and deals the answers out again by (label, salt), so a giant group is not one task's work. Each round's labels
    are a table in the shared folder; those of past rounds are deleted. The loop ends when no label changes.
    """
    spark = links.sparkSession
    both, _ = written(links.select(F.col("a").alias("src"), F.col("b").alias("dst")).unionAll(links.select(F.col("b").alias("src"), F.col("a").alias("dst"))), "edges")
    labels, path = written(both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("label"))
                           .select("node", F.least("node", "label").alias("label")), "labels")
    none = F.lit(None).cast(labels.schema["label"].dataType)
    done = 0
    while True:
        msgs = both.join(labels.withColumnRenamed("node", "src"), "src").select(F.col("dst").alias("node"), "label")
        cand = labels.select("node", "label", F.col("label").alias("own")).unionAll(msgs.select("node", "label", none.alias("own")))
        new, step = written(cand.groupBy("node").agg(F.min("label").alias("label"), F.min("own").alias("old")), "labels")
        hop = (new.select("label").distinct().join(new.select(F.col("node").alias("label"), F.col("label").alias("label2")), "label")
               .withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(salts)]))))
        # pointer jumping: adopt the label's label (labels only ever decrease)
        new = (new.withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(salts)).cast("int")).join(hop, ["label", "salt"], "left")
               .select("node", F.least("label", F.coalesce("label2", "label")).alias("label"), "old"))
        # the number of changed labels is observed by the job that writes them: one count less per round
        obs = Observation(f"components_{uuid.uuid4().hex[:8]}_{done}")
        new, after = written(new.observe(obs, F.count_if(F.col("label") < F.col("old")).alias("changed")), "labels")
        discard(spark, path)
        discard(spark, step)
        labels, path = new.select("node", "label"), after
        done += 1
        if not obs.get["changed"]:
            return labels.withColumnRenamed("node", "set")

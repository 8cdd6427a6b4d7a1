"""Operator 8, packing: cutting-stock column generation over the histogram of piece lengths.

1. ``token_pieces``: every document becomes ids plus an end id, cut into full sequences and one shorter rest.
2. The pieces' lengths make a histogram: exactly up to ``SHORT`` steps of ``STEP`` tokens, in steps beyond, where rounding up costs
   little. That is at most SHORT * STEP + CAPACITY / STEP classes: the cutting-stock problem, of one size for any corpus.
   Two ways to count the short ones are planned, exactly and in steps like the others; the one of fewer sequences is taken.
3. ``plan``: the linear program of the long classes starts with patterns of one class each; duals price the classes, a knapsack dynamic
   program finds the best new pattern, until none improves. The solution is rounded down; what
   remains of the demand (at most a sequence's worth per pattern) is filled first-fit, longest first. Short classes go
   into the patterns' free tokens, longest first, and then into sequences of their own, by their exact lengths.
   If the plan wastes more than ``WASTE``, no patterns fit these lengths well; the documents' rests are then cut in two at
   a place by their hash, which gives lengths of all kinds, and planned anew. The plan of fewer sequences is taken.
4. ``assign``: pieces are ranked within their class (in salted parts, so that a class with a third of all rows is
   no single task's work), and a piece's class and rank tell its sequence: pattern p, made x times with a pieces of
   the class, takes the next a * x ranks.
"""

from __future__ import annotations

import functools
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelake.llm.common import keep
from featurelake.llm.word_tokens import encoded

CAPACITY, STEP, END_ID = 2048, 8, 1
#: Lengths of at most so many steps are counted exactly, or in steps too.
SHORT = 32
#: The share of sequences beyond the least number possible that a plan may take before rests are cut.
WASTE = 0.02
#: Rows that are ranked in one task.
PART_ROWS = 5_000


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID, with_ids: bool = False,
                 cut_rests: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens[, ids]) per piece of each row of docs (doc_id, text).

    A document's ids are its whole text's and ``end_id``; NULL and empty texts have the end id alone. Pieces are cut
    every ``capacity`` ids, and with ``cut_rests`` the last one again at a place by the text's hash. Repeated rows give repeated pieces; a NULL doc_id stays NULL; further columns are left out.
    """
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, ids, first in encoded(batch, tokenizer):
                total = np.diff(first) + 1
                n = -(-total // capacity)
                row = np.repeat(np.arange(rows.num_rows), n)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)) * capacity
                length = np.minimum(capacity, total[row] - start)
                if cut_rests:
                    rest = np.flatnonzero((length < capacity) & (length > 1))
                    some = rows.column(2).to_numpy()[row[rest]].view(np.uint64) % (length[rest] - 1).astype(np.uint64)
                    first_part = some.astype(np.int64) + 1
                    row, start, length = (np.concatenate(x) for x in (
                        (row, row[rest]), (start, start[rest] + first_part), (length, length[rest] - first_part)))
                    length[rest] = first_part
                crc, own = np.empty(len(row), np.int64), []
                end = np.uint32(end_id).tobytes()
                for k, (i, s, m) in enumerate(zip(row.tolist(), start.tolist(), length.tolist())):
                    lo = first[i] + s
                    hi = min(lo + m, first[i + 1])
                    raw = ids[lo:hi].tobytes()
                    if hi - lo < m:
                        raw += end
                    crc[k] = zlib.crc32(raw)
                    if with_ids:
                        own.append(np.frombuffer(raw, np.uint32))
                cols = [rows.column(0).take(pa.array(row)), pa.array(start), pa.array(length), pa.array(crc), pa.array(total[row])]
                if with_ids:
                    at = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(own).astype(np.int32))))
                yield pa.RecordBatch.from_arrays(cols, names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("hash")).mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long" + ", ids array<int>" * with_ids)


def plan(demand: dict[int, int], capacity: int, step: int = 1, short: int = SHORT) -> list[tuple[dict[int, int], int]]:
    """[({class: pieces of it}, times)] that use each class (its size, 1 to capacity) exactly as often as demanded.

    With a step over 1, sizes over ``short`` steps are multiples of it and go through the linear program in its units.
    """
    if step == 1:
        return _plan(tuple(sorted(demand.items())), capacity)
    long = _plan(tuple((s // step, n) for s, n in sorted(demand.items()) if s > short * step), capacity // step)
    few = {s: n for s, n in sorted(demand.items(), reverse=True) if s <= short * step}
    out = []
    for units, times in sorted(long, key=lambda x: -x[1]):
        pattern = {s * step: a for s, a in units.items()}
        room = capacity - sum(s * a for s, a in pattern.items())
        for s in few:
            a = min(few[s] // times, room // s)
            if a:
                pattern[s], room = a, room - a * s
                few[s] -= a * times
        out.append((pattern, times))
    sizes = np.array(sorted(few), np.int64)
    return out + _first_fit(sizes, np.array([few[s] for s in sizes.tolist()], np.int64), capacity)


@functools.lru_cache(maxsize=4)
def _plan(classes: tuple[tuple[int, int], ...], capacity: int) -> list[tuple[dict[int, int], int]]:
    demand = dict(classes)
    sizes = np.array(sorted(demand), np.int64)
    m = len(sizes)
    if not m:
        return []
    need = np.array([demand[s] for s in sizes.tolist()], float)
    patterns = np.diag(capacity // sizes).astype(float)  # columns; the first ones hold one class each
    inverse = np.diag(1.0 / np.diag(patterns))
    x = inverse @ need
    for _ in range(50 * m + 1000):  # each step lowers the number of sequences or, in ties, changes the basis
        price = inverse.sum(0)
        column, value = _best_pattern(sizes, price, capacity)
        if value <= 1 + 1e-7:
            break
        direction = inverse @ column
        able = direction > 1e-9
        if not able.any():
            break
        ratio = np.where(able, x / np.where(able, direction, 1), np.inf)
        out = int(ratio.argmin())
        step = ratio[out]
        x = np.maximum(x - step * direction, 0)
        x[out] = step
        patterns[:, out] = column
        inverse[out] /= direction[out]
        direction[out] = 0
        inverse -= np.outer(direction, inverse[out])
    times = np.floor(x + 1e-6).astype(np.int64)
    whole = patterns.round().astype(np.int64)
    left = need.astype(np.int64) - whole @ times
    while (left < 0).any():  # a rounding error in x: one less of a pattern that has too much
        p = int(np.argmax((whole[left < 0] > 0).any(0) & (times > 0)))
        times[p] -= 1
        left += whole[:, p]
    out = [({int(s): int(a) for s, a in zip(sizes, whole[:, p]) if a}, int(t)) for p, t in enumerate(times) if t]
    return out + _first_fit(sizes, left, capacity)


def _best_pattern(sizes: np.ndarray, price: np.ndarray, capacity: int) -> tuple[np.ndarray, float]:
    """The unbounded knapsack by dynamic programming: classes that fit together and are worth most."""
    useful = price > 1e-12
    s, v = sizes[useful], price[useful]
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    for c in range(1, capacity + 1):
        fit = int(np.searchsorted(s, c, side="right"))
        best[c], choice[c] = best[c - 1], -1
        if fit:
            worth = best[c - s[:fit]] + v[:fit]
            k = int(worth.argmax())
            if worth[k] > best[c] + 1e-12:
                best[c], choice[c] = worth[k], k
    column, c = np.zeros(len(sizes)), capacity
    index = np.flatnonzero(useful)
    while c > 0:
        if choice[c] < 0:
            c -= 1
        else:
            column[index[choice[c]]] += 1
            c -= s[choice[c]]
    return column, float(best[capacity])


def _first_fit(sizes: np.ndarray, left: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    made: list[tuple[dict[int, int], int]] = []
    left = left.copy()
    while left.any():
        room, pattern = capacity, {}
        for k in range(len(sizes) - 1, -1, -1):
            a = min(int(left[k]), room // int(sizes[k]))
            if a:
                pattern[int(sizes[k])] = a
                room -= a * int(sizes[k])
        times = min(int(left[k]) // pattern[int(s)] for k, s in enumerate(sizes) if int(s) in pattern)
        for k, s in enumerate(sizes):
            left[k] -= times * pattern.get(int(s), 0)
        made.append((pattern, times))
    return made


def size_class(length: Column, step: int = STEP, short: int = SHORT) -> Column:
    """The length; beyond ``short`` steps, rounded up to its step."""
    return F.when(length <= short * step, length).otherwise(F.ceil(length / step) * step).cast("int")


def histogram(pieces: DataFrame, step: int = STEP) -> dict[int, int]:
    """{class: pieces}; a fixed number of classes."""
    counts = pieces.groupBy(size_class(F.col("length"), step).alias("class")).agg(F.count(F.lit(1)).alias("n"))
    return {r["class"]: r["n"] for r in counts.collect()}


def best_plan(demand: dict[int, int], capacity: int, step: int) -> tuple[int, list[tuple[dict[int, int], int]], int]:
    """(sequences, plan, short) of the better way to count short lengths: exactly, or in steps."""
    stepped: dict[int, int] = {}
    for s, n in demand.items():
        up = -(-s // step) * step
        stepped[up] = stepped.get(up, 0) + n
    made = [(plan(d, capacity, step, short), short) for d, short in ((demand, SHORT), (stepped, 0))]
    return min(((sum(times for _, times in p), p, short) for p, short in made), key=lambda x: x[0])


def planned(pieces: DataFrame, capacity: int, step: int) -> int:
    """The plan's number of sequences."""
    return best_plan(histogram(pieces, step), capacity, step)[0]


def wasteful(pieces: DataFrame, made: int, capacity: int, waste: float = WASTE) -> bool:
    tokens = pieces.agg(F.sum("length")).first()[0] or 0
    return made > -(-tokens // capacity) * (1 + waste) + 1


def assign(pieces: DataFrame, capacity: int = CAPACITY, step: int = STEP, part_rows: int = PART_ROWS) -> DataFrame:
    """pieces (doc_id, start, length, ...) and sequence_id, offset: gapless from 0 within a sequence of at most ``capacity``.

    Columns of those two names give way. Every row gets one place, repeated rows too: rows are ranked by doc_id, start and all that
    tells two texts of one id apart, so a task that runs again after a lost executor deals the same places. No rows: no rows.
    """
    carried = [c for c in pieces.columns if c not in ("sequence_id", "offset")]
    told = [c for c in ("ids_crc32", "doc_tokens", "length") if c in carried]
    n = histogram(pieces, step)
    _, patterns, short = best_plan(n, capacity, step)
    pieces = pieces.select(*carried).withColumn("class__", size_class(F.col("length"), step, short))
    parts = max(1, -(-sum(n.values()) // part_rows))
    pieces = pieces.withColumn("part__", F.pmod(F.xxhash64("doc_id", "start", *told), F.lit(parts)).cast("int"))
    sizes = pieces.groupBy("class__", "part__").agg(F.count(F.lit(1)).alias("n__"))
    before = sizes.select("class__", "part__", F.coalesce(F.sum("n__").over(
        Window.partitionBy("class__").orderBy("part__").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before__"))
    ranked = (pieces.withColumn("rank__", F.row_number().over(Window.partitionBy("class__", "part__").orderBy("doc_id", "start", *told)))
              .join(before, ["class__", "part__"]).withColumn("rank__", F.col("rank__") - 1 + F.col("before__")).drop("before__", "part__"))

    rows, used, base = [], Counter(), 0
    for pattern, times in patterns:
        for slot, (k, a) in enumerate(sorted(pattern.items(), reverse=True)):
            rows.append((k, used[k], a, base, slot))
            used[k] += a * times
        base += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    shared = pieces.sparkSession.sparkContext.broadcast(table)
    schema = pieces.select(*carried).schema.add("sequence_id", "long").add("slot__", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = shared.value
        wide = int(t[:, 1].max(initial=0)) + 1
        for batch in batches:
            k = batch.column(len(carried)).to_numpy().astype(np.int64)
            rank = batch.column(len(carried) + 1).to_numpy()
            lo = np.searchsorted(t[:, 0] * wide + t[:, 1], k * wide + np.minimum(rank, wide - 1), side="right") - 1
            since = rank - t[lo, 1]
            a = t[lo, 2]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(carried)], pa.array(t[lo, 3] + since // a), pa.array(t[lo, 4] * capacity + since % a)], names=schema.names)

    placed = ranked.select(*carried, "class__", "rank__").mapInArrow(run, schema)
    earlier = Window.partitionBy("sequence_id").orderBy("slot__").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(earlier), F.lit(0)).cast("long")).drop("slot__")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, step: int = STEP, with_ids: bool = False) -> DataFrame:
    """token_pieces and assign: one row per piece. The pieces are written once; texts are read and encoded once, or
    twice where rests have to be cut."""
    pieces = keep(token_pieces(docs, tokenizer, capacity, with_ids=with_ids), "pieces")
    made = planned(pieces, capacity, step)
    if wasteful(pieces, made, capacity):
        cut = keep(token_pieces(docs, tokenizer, capacity, with_ids=with_ids, cut_rests=True), "pieces")
        pieces = cut if planned(cut, capacity, step) < made else pieces
    return assign(pieces, capacity, step)


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """(sequence_id, ids, doc_ids, starts): the sequences' ids of ``pack(..., with_ids=True)``, padded to ``capacity`` unless
    their number is a power of two. A group is one sequence, so it is bounded by ``capacity``."""
    rows = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "start", "ids")))
    got = packed.groupBy("sequence_id").agg(rows.alias("rows"))
    ids = F.flatten(F.col("rows.ids"))
    n = F.size(ids)
    padding = F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(capacity - n)
    return got.select("sequence_id", F.concat(ids, F.array_repeat(F.lit(pad_id), padding)).alias("ids"),
                      F.col("rows.doc_id").alias("doc_ids"), F.col("rows.start").alias("starts"))

"""Operator 9, benchmark decontamination: SimHash over item-sized windows, multi-index Hamming blocks, exact verification.

Words are runs of letters, digits and non-ASCII characters, lower-cased. A benchmark item of m words is compared with
every window of m words of every document (a document of fewer words is one window):

* a window of similarity 0.8 holds 0.8 of the item's weight, so it shares a shingle with any part of the item that weighs over
  0.2 of it. The item's rarest shingles up to that weight are its anchors; a window without one is passed over at once. Shingles that
  many items share (a common prompt) are anchors of items that have little else only;
* the others get a 64-bit SimHash of their weighted shingles, from running sums, and look it up in the multi-index: the
  fingerprint is cut into 8 blocks, and an item is filed under every value within 2 bits of its block's. Two
  fingerprints within ``RADIUS`` = 23 bits differ by at most 2 in some block, so the index returns all of them;
* what it returns is verified by the exact weighted Jaccard similarity of the shingle multisets, 0.8 or more. For an item, its own
  shingles weigh 1 + ln((items + 1) / (items that have it + 1)), counted over the whole benchmark, all others 1 + ln(items + 1). So
  a similarity does not depend on how the benchmark is dealt into blocks.

At similarity 0.8 the expected distance is about 10 bits and its deviation 3, so the radius lies over four deviations
out. The benchmark is the stated query set: it is read in blocks of ``BLOCK_ITEMS`` items, each broadcast, so what is
broadcast has a fixed bound; documents are only scanned, never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.llm.common import keep, mix, shingles, slices, span_hashes, spans, utf8

K, SIMILARITY, RADIUS = 5, 0.8, 23
BLOCK_ITEMS, BLOCK_BYTES = 5_000, 16 << 20
#: Pairs of a shared shingle and an item that one step of a scan holds, besides those of a single text.
HITS = 1 << 20
_U = np.uint64
_BITS = np.arange(64, dtype=np.uint64)
_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
#: For each byte, the bytes within 2 bits of it.
_NEAR = np.array([[bin(a ^ b).count("1") <= 2 for b in range(256)] for a in range(256)])


def _shingled(text: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All shingle hashes of the texts, the place of each text's first (n + 1), and each text's number of words."""
    data, offsets = utf8(pc.utf8_lower(text))
    starts, ends = spans(_INSIDE[data], offsets)
    first = np.searchsorted(starts, offsets)
    found, at = shingles(span_hashes(data, starts, ends), first, k)
    return found, at, np.diff(first)


def _fingerprints(sums: np.ndarray) -> np.ndarray:
    return ((sums > 0).astype(np.uint64) << _BITS).sum(1, dtype=np.uint64)


def _signed(found: np.ndarray, weight: np.ndarray) -> np.ndarray:
    bits = (mix(found)[:, None] >> _BITS & _U(1)).astype(np.float64)
    return (2 * bits - 1) * weight[:, None]


class Index:
    """The items of one block of a benchmark. ``total`` and ``counted`` (sorted shingles, items that have each) speak for the whole
    benchmark; without them the block is all there is."""

    def __init__(self, ids: list, text: pa.Array, k: int = K, total: int | None = None, counted: tuple[np.ndarray, np.ndarray] | None = None):
        found, at, words = _shingled(text, k)
        own = [i for i in range(len(ids)) if at[i + 1] > at[i]]
        self.k, self.ids = k, [ids[i] for i in own]
        self.words = [int(words[i]) for i in own]
        pairs = [np.unique(found[at[i]:at[i + 1]], return_counts=True) for i in own]
        every = np.concatenate([p[0] for p in pairs]) if pairs else np.zeros(0, np.uint64)
        shingle, have = counted if counted is not None else np.unique(every, return_counts=True)
        n = len(own) if total is None else total
        self.other = 1 + float(np.log(n + 1))
        self.items = [(s, c, 1 + np.log((n + 1) / (have[np.searchsorted(shingle, s)] + 1))) for s, c in pairs]
        self.mass = [float((c * w).sum()) for _, c, w in self.items]
        self.prints = np.array([_fingerprints((_signed(s, w) * c[:, None]).sum(0)[None])[0] for s, c, w in self.items], np.uint64)
        blocks = self.prints[:, None] >> (_BITS[:8] * _U(8)) & _U(255)
        self.filed = np.stack([_NEAR[b.astype(np.int64)] for b in blocks]) if len(blocks) else np.zeros((0, 8, 256), bool)
        anchors = [self._anchors(i) for i in range(len(self.items))]
        every = np.concatenate(anchors) if anchors else np.zeros(0, np.uint64)
        order = np.argsort(every, kind="stable")
        self.owner = np.repeat(np.arange(len(anchors)), [len(x) for x in anchors])[order]
        self.known, self.first, self.have = np.unique(every[order], return_index=True, return_counts=True)
        self.bitmap = np.zeros(1 << 20, bool)
        self.bitmap[(self.known >> _U(44)).astype(np.int64)] = True

    def _anchors(self, item: int) -> np.ndarray:
        """The item's rarest shingles that together weigh more than a window of enough similarity may lack."""
        shingle, count, w = self.items[item]
        order = np.lexsort((shingle, -w))
        enough = np.searchsorted(np.cumsum((count * w)[order]), (1 - SIMILARITY + 1e-6) * self.mass[item], side="right") + 1
        return np.sort(shingle[order[:enough]])

    def weight(self, found: np.ndarray, item: int) -> np.ndarray:
        shingle, _, w = self.items[item]
        j = np.minimum(np.searchsorted(shingle, found), len(shingle) - 1)
        return np.where(shingle[j] == found, w[j], self.other)

    def hits(self, text: pa.Array) -> Iterator[tuple[int, int, int, int, float]]:
        """(row, item, first word, words, similarity): for each text and item the most similar window, the first of equals."""
        if not len(self.known):
            return
        found, at, words = _shingled(text, self.k)
        likely = np.flatnonzero(self.bitmap[(found >> _U(44)).astype(np.int64)])
        j = np.minimum(np.searchsorted(self.known, found[likely]), len(self.known) - 1)
        ok = self.known[j] == found[likely]
        likely, j = likely[ok], j[ok]
        rows = np.searchsorted(at, likely, side="right") - 1
        opens = np.concatenate([[0], np.cumsum(self.have[j])])
        row_ends = np.flatnonzero(np.diff(rows, append=-1)) + 1
        lo = 0
        while lo < len(rows):  # whole texts of about HITS shared shingles at a time
            hi = int(row_ends[max(np.searchsorted(opens[row_ends], opens[lo] + HITS, side="right") - 1, np.searchsorted(row_ends, lo, side="right"))])
            yield from self._met(found, at, words, rows[lo:hi], likely[lo:hi], j[lo:hi])
            lo = hi

    def _met(self, found: np.ndarray, at: np.ndarray, words: np.ndarray, rows: np.ndarray, likely: np.ndarray, j: np.ndarray) -> Iterator[tuple]:
        n = self.have[j]
        owner = self.owner[np.repeat(self.first[j] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
        rows, place = np.repeat(rows, n), np.repeat(likely - at[rows], n)
        order = np.lexsort((place, owner, rows))
        rows, owner, place = rows[order], owner[order], place[order]
        cut = np.flatnonzero((np.diff(rows, prepend=-1) != 0) | (np.diff(owner, prepend=-1) != 0))
        for lo, hi in zip(cut, [*cut[1:], len(rows)]):
            row, item = int(rows[lo]), int(owner[lo])
            best = self._best(found[at[row]:at[row + 1]], place[lo:hi], item)
            if best:
                yield row, item, best[1], min(self.words[item], int(words[row])), -best[0]

    def _best(self, own: np.ndarray, place: np.ndarray, item: int) -> tuple[float, int] | None:
        size = min(max(self.words[item] - self.k + 1, 1), len(own))  # the window's shingles
        last = len(own) - size
        best = None
        lo = np.clip(place - size + 1, 0, last)
        hi = np.minimum(place, last)
        done = -1
        for a, b in zip(lo.tolist(), hi.tolist()):
            a = max(a, done + 1)
            for s in range(a, b + 1, 2048):
                e = min(s + 2047, b)
                best = min(filter(None, (best, self._verified(own, s, e, size, item))), default=None)
            done = max(done, b)
        return best

    def _verified(self, own: np.ndarray, s: int, e: int, size: int, item: int) -> tuple[float, int] | None:
        """Of the windows that start at s to e, the best (-similarity, start)."""
        part = own[s:e + size]
        weight = self.weight(part, item)
        sums = np.zeros((len(part) + 1, 64))
        np.cumsum(_signed(part, weight), axis=0, out=sums[1:])
        n = e - s + 1
        prints = _fingerprints(sums[size:size + n] - sums[:n])
        blocks = (prints[:, None] >> (_BITS[:8] * _U(8)) & _U(255)).astype(np.int64)
        filed = self.filed[item][np.arange(8), blocks].any(1)
        far = np.bitwise_count(prints ^ self.prints[item])
        shingle, count, w = self.items[item]
        best = None
        for i in np.flatnonzero(filed & (far <= RADIUS)).tolist():
            u, c = np.unique(part[i:i + size], return_counts=True)
            j = np.minimum(np.searchsorted(u, shingle), len(u) - 1)
            both = float((np.where(u[j] == shingle, np.minimum(c[j], count), 0) * w).sum())
            similar = both / (float(weight[i:i + size].sum()) + self.mass[item] - both)
            if similar >= SIMILARITY - 1e-9 and (best is None or (-similar, s + i) < best):
                best = (-similar, s + i)
        return best


def _counted(items: DataFrame) -> DataFrame:
    """(block, shingle, opens): the distinct shingles of every item of (block, text); ``opens`` is 1 once per item that has any."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                found, at, _ = _shingled(part.column(1), K)
                own = [np.unique(found[a:b]) for a, b in zip(at, at[1:])]
                sizes = np.array([len(x) for x in own])
                opens = np.zeros(sizes.sum(), np.int64)
                opens[(np.cumsum(sizes) - sizes)[sizes > 0]] = 1
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(np.repeat(np.arange(len(own)), sizes))),
                                                  pa.array(np.concatenate([np.zeros(0, np.uint64), *own]).view(np.int64)), pa.array(opens)],
                                                 names=["block", "shingle", "opens"])

    return items.select("block", "text").mapInArrow(run, "block long, shingle long, opens long")


def indexes(benchmark: DataFrame, block_items: int = BLOCK_ITEMS, block_bytes: int = BLOCK_BYTES) -> Iterator[Index]:
    """The benchmark (item_id, text) in blocks of bounded size, one in the driver's memory at a time.

    Shingles are counted over the whole benchmark in tasks; a block gets the counts of its own shingles. NULL and empty texts
    match nothing; equal rows count once.
    """
    items = benchmark.select("item_id", "text").filter("text IS NOT NULL").distinct()
    size = items.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(-(-size["n"] // max(1, block_items // 2)), -(-(size["bytes"] or 0) // max(1, block_bytes // 2)))
    if blocks > 1:
        items = keep(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))), "benchmark")
        rows = keep(_counted(items), "shingles")
        total = int(rows.agg(F.sum("opens")).first()[0] or 0)
        counts = keep(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("have"), F.collect_set("block").alias("blocks")), "counts")
    for b in range(blocks):
        got = (items if blocks == 1 else items.filter(F.col("block") == b)).select("item_id", "text").orderBy("item_id", "text").toArrow()
        whole = {}
        if blocks > 1:
            own = counts.filter(F.array_contains("blocks", F.lit(b).cast("long"))).select("shingle", "have").toArrow()
            shingle = own["shingle"].to_numpy().view(np.uint64)
            order = np.argsort(shingle)
            whole = {"total": total, "counted": (shingle[order], own["have"].to_numpy()[order])}
        yield Index(got["item_id"].to_pylist(), got["text"].combine_chunks(), **whole)


def find(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """(doc_id, item_id, start_word, n_words, similarity): one row for each row of docs (doc_id, text) and item found in it.

    NULL and empty texts hold nothing; repeated rows give repeated results; either table empty: no rows.
    """
    schema = docs.select("doc_id").schema
    for name, kind in (("item_id", benchmark.schema["item_id"].dataType), ("start_word", "long"), ("n_words", "long"), ("similarity", "double")):
        schema = schema.add(name, kind)
    out = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(benchmark, block_items):
        shared = docs.sparkSession.sparkContext.broadcast(index)  # a block

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            item_type = pa.array(own.ids).type if own.ids else pa.int64()
            for batch in batches:
                for part in slices(batch):
                    hits = list(own.hits(part.column(1)))
                    row, item, start, words, similar = ([h[i] for h in hits] for i in range(5))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(row, pa.int64())), pa.array([own.ids[i] for i in item], item_type),
                         pa.array(start, pa.int64()), pa.array(words, pa.int64()), pa.array(similar, pa.float64())], names=schema.names)

        out = out.unionAll(docs.select("doc_id", "text").mapInArrow(run, schema))
    return out


def remove(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that hold no item of the benchmark. NULL and empty texts stay."""
    at = docs.columns.index("text")
    for index in indexes(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch):
                    clean = np.ones(part.num_rows, bool)
                    clean[[hit[0] for hit in shared.value.hits(part.column(at))]] = False
                    yield part if clean.all() else part.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs

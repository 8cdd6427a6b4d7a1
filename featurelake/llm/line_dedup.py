"""Operator 4, line dedup: winnowing over line hashes.

Lines are compared by their words (A-Z lower-cased, white space reduced). A window is the shortest run of lines from a
line on, or up to a line, that has ``min_words`` words. Of each window the line with the least hash (the last of equals)
is selected as a fingerprint, so every run of ``min_words`` words that two places share holds a fingerprint that
both select, and most texts are told apart by few rows.

1. One scan writes each document's line hashes, word counts and fingerprints. Fingerprints are counted; those seen once
   end there.
2. Documents with repeated fingerprints are joined with their positions, and each match is extended both ways: from
   the windows that selected it, forwards and backwards, by exact hashes of the windows' contents. A line lies in a
   shared run exactly if a window over it is shared, so the windows' union is the whole run, whichever of the earlier
   places it matches.
3. For each window content the first place (by doc_id, then text hash, then line) stays; all later ones are deleted,
   from the first to the last line of the window, blank lines between included.

All steps are aggregates and joins by hash with map-side combination; no pairs of places are made.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featurelake.llm.common import SPACE, keep, mix, powers, slices, span_hashes, spans, utf8

MIN_WORDS = 50
_U = np.uint64
KEY = ["doc_id", "tag"]


def _run_hashes(hashes: np.ndarray) -> np.ndarray:
    """Running totals from which the hash of any run of hashes can be told."""
    up, _ = powers(len(hashes))
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[:-1], out=total[1:])
    return total


def _of_runs(total: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    _, down = powers(len(total) - 1)
    return mix((total[hi] - total[lo]) * down[lo] + (hi - lo).astype(np.uint64))


def lines_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, line number, hash, words) of every line with a word, texts in order."""
    data, offsets = utf8(text)
    starts, ends = spans(~SPACE[data], offsets)
    words = span_hashes(data, starts, ends)
    row = np.searchsorted(offsets, starts, side="right") - 1
    breaks = np.concatenate([[0], np.cumsum(data == 10)])
    line = breaks[starts] - breaks[offsets[row]]
    new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(line, prepend=-1) != 0))
    stop = np.append(new[1:], len(words))[:len(new)]
    return row[new], line[new], _of_runs(_run_hashes(words), new, stop), stop - new


def windows(row: np.ndarray, hashes: np.ndarray, words: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, last + 1, selected) of all windows, forwards and backwards, by place in the arrays; none leaves its row."""
    n = len(row)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    total = np.concatenate([[0], np.cumsum(words)])
    edge = np.flatnonzero(np.diff(row, prepend=row[0] - 1) != 0)
    run = np.searchsorted(edge, np.arange(n), side="right") - 1
    begin, end = edge[run], np.append(edge[1:], n)[run]
    at = np.arange(n)
    to = np.searchsorted(total, total[:-1] + min_words)
    back = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    lo = np.concatenate([at[to <= end], back[(back >= begin) & (total[1:] >= min_words)]])
    hi = np.concatenate([to[to <= end], at[(back >= begin) & (total[1:] >= min_words)] + 1])
    both = np.unique(lo * (n + 1) + hi)
    lo, hi = both // (n + 1), both % (n + 1)
    least, chosen = hashes[lo], lo.copy()
    for step in range(1, int((hi - lo).max(initial=0))):  # at most min_words steps: each line has a word
        i = np.minimum(lo + step, hi - 1)
        better = (lo + step < hi) & (hashes[i] <= least)
        least, chosen = np.where(better, hashes[i], least), np.where(better, i, chosen)
    return lo, hi, chosen


def _ragged(row: np.ndarray, rows: int, values: np.ndarray) -> pa.Array:
    at = np.searchsorted(row, np.arange(rows + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(at), pa.array(values))


def _scan(docs: DataFrame, min_words: int) -> DataFrame:
    names = [*KEY, "line", "hash", "words", "prints"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                row, line, hashes, words = lines_of(part.column(2))
                _, _, chosen = windows(row, hashes, words, min_words)
                chosen = np.unique(chosen)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), _ragged(row, n, line.astype(np.int32)), _ragged(row, n, hashes.view(np.int64)),
                                                  _ragged(row, n, words.astype(np.int32)), _ragged(row[chosen], n, hashes[chosen].view(np.int64))], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(*KEY, "text").mapInArrow(run, f"doc_id {kind}, tag long, line array<int>, hash array<long>, words array<int>, prints array<long>")


def _extended(docs: DataFrame, min_words: int) -> DataFrame:
    """(doc_id, tag, content, first, last): the windows that select one of the row's ``repeated`` fingerprints."""
    names = [*KEY, "content", "first", "last"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, line, hashes, words, owner, wanted = (x.to_numpy() for x in (
                _rows(batch.column(2)), batch.column(2).flatten(), batch.column(3).flatten(), batch.column(4).flatten(),
                _rows(batch.column(5)), batch.column(5).flatten()))
            hashes, words = hashes.view(np.uint64), words.astype(np.int64)
            lo, hi, chosen = windows(row, hashes, words, min_words)
            mark = lambda r, h: mix(r.astype(np.uint64) + _U(1)) ^ h.view(np.uint64)
            ok = np.isin(mark(row[chosen], hashes[chosen]), mark(owner, wanted))
            lo, hi = lo[ok], hi[ok]
            at = pa.array(row[lo])
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(_of_runs(_run_hashes(hashes), lo, hi).view(np.int64)),
                                              pa.array(line[lo]), pa.array(line[hi - 1])], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select(*KEY, "line", "hash", "words", "repeated").mapInArrow(run, f"doc_id {kind}, tag long, content long, first int, last int")


def _rows(lists: pa.Array) -> pa.Array:
    import pyarrow.compute as pc

    return pc.list_parent_indices(lists)


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, tag, removed): for each document (doc_id, text) with later repeated runs, the numbers of their lines.

    tag is the text's hash: rows of equal doc_id and text are one document; rows of one doc_id and different texts
    are several, in the order of their tags. A NULL doc_id comes before all others.
    """
    docs = docs.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    scanned = keep(_scan(docs, min_words), "lines").dropDuplicates(KEY)
    prints = scanned.select(*KEY, F.explode("prints").alias("print"))
    twice = prints.groupBy("print").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("print")
    found = prints.join(twice, "print").groupBy(F.col("doc_id").alias("id__"), F.col("tag").alias("tag__")).agg(F.collect_set("print").alias("repeated"))
    place = [F.col(c) for c in (*KEY, "first", "last")]
    same = F.col("doc_id").eqNullSafe(F.col("id__")) & (F.col("tag") == F.col("tag__"))
    runs = keep(_extended(scanned.join(found, same), min_words), "runs")
    first = (runs.groupBy("content").agg(F.min(F.struct(*place)).alias("at"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("content", "at"))
    later = runs.join(first, "content").filter(~F.struct(*place).eqNullSafe(F.col("at")))
    return later.groupBy(*KEY).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.sequence("first", "last"))))).alias("removed"))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs, all columns, ``text`` without the later repeated runs, and n_lines and n_removed (counts of lines).

    NULL texts stay NULL, with 0 lines. A text all of whose lines go becomes empty. Columns named n_lines or
    n_removed give way. No rows: no rows.
    """
    gone = repeated_lines(docs, min_words).select(F.col("doc_id").alias("id__"), F.col("tag").alias("same__"), F.col("removed").alias("removed__"))
    carried = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    joined = docs.select(*carried, F.xxhash64("text").alias("tag__")).join(
        gone, F.col("doc_id").eqNullSafe(F.col("id__")) & (F.col("tag__") == F.col("same__")), "left")
    # a one-element array binds the lines to a name, so the text is split once
    kept = F.transform(F.array(F.split("text", "\n", -1)), lambda lines: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("removed__")), lambda i: lines[i]), "\n"))[0]
    n_lines = F.coalesce(F.length("text") - F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1, F.lit(0)).cast("long")
    return joined.select(*[(F.when(F.col("removed__").isNull(), F.col("text")).otherwise(kept)).alias("text") if c == "text" else F.col(c) for c in carried],
                         n_lines.alias("n_lines"), F.coalesce(F.size("removed__"), F.lit(0)).cast("long").alias("n_removed"))

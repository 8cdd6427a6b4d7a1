"""Operator 12, resampling towards a target: hashed n-gram weights from prefix CRCs, and a seeded draw without replacement.

A document is normalised to its words parted by one byte each, and one scan stores the CRC-32 register after every byte. The
register is linear over GF(2): the CRC of any stretch is the register at its end, less (by XOR) the register at its start shifted
over the stretch's length. So every n-gram's bucket comes from two stored values, and no n-gram is ever spelled out. Shifts by powers of
two bytes are table look-ups, and a length is put together from its bits.

Counts per bucket cover all documents and the whole target; only these counts (``buckets`` numbers a side) reach the driver. A document's
weight is the floored mean of its features' gains, its score adds a seeded Gumbel number, and the highest scores are drawn.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from featurelake.llm.common import LOWER, keep, slices, spans, utf8

BUCKETS = 10_000
MAX_GRAM = 1
SEED = 2024
MIN_WORDS = 20

#: Bytes of words: digits, small letters (after lower-casing A-Z) and all that is not ASCII.
_WORD = np.zeros(256, bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True

_U32 = np.uint32
_FULL = 0xFFFFFFFF


def _byte_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> _U32(1)) ^ _U32(0xEDB88320), t >> _U32(1)).astype(np.uint32)
    return t


_TABLE = _byte_table()


def _through(tables: np.ndarray, r: np.ndarray) -> np.ndarray:
    return tables[0][r & _U32(255)] ^ tables[1][(r >> _U32(8)) & _U32(255)] ^ tables[2][(r >> _U32(16)) & _U32(255)] ^ tables[3][r >> _U32(24)]


def _shift_tables(n: int) -> list[np.ndarray]:
    """Tables that shift a register over 1, 2, 4, ... zero bytes: one of 256 entries for each byte of the register."""
    single = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * _U32(8))[:, None]
    made = [(_TABLE[single & _U32(255)] ^ (single >> _U32(8))).astype(np.uint32)]
    while len(made) < n:
        made.append(np.stack([_through(made[-1], row) for row in made[-1]]))
    return made


_SHIFTS = _shift_tables(40)


def shifted(registers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each register after its length in zero bytes."""
    out = registers.astype(np.uint32)
    for k in range(int(lengths.max(initial=0)).bit_length()):
        at = np.flatnonzero((lengths >> k) & 1)
        out[at] = _through(_SHIFTS[k], out[at])
    return out


class PrefixCrc:
    """Registers after every byte of a buffer, from a start of 0.

    The scan goes through many equal lanes side by side, each from 0. Stretches within a lane need nothing else; for those that reach
    into further lanes, each lane's true register at its start is carried along.
    """

    def __init__(self, data: np.ndarray):
        n = len(data)
        lanes = max(1, 2 * math.isqrt(n))
        self.width = max(1, -(-n // lanes))
        lanes = -(-n // self.width) if n else 1
        padded = np.zeros(lanes * self.width, np.uint8)
        padded[:n] = data
        columns = np.ascontiguousarray(padded.reshape(lanes, self.width).T)
        self.after = np.empty((self.width + 1, lanes), np.uint32)
        self.after[0] = 0
        for i in range(self.width):
            r = self.after[i]
            self.after[i + 1] = _TABLE[(r ^ columns[i]) & _U32(255)] ^ (r >> _U32(8))
        step = _shift_by(self.width)
        carry, r = np.zeros(lanes, np.uint32), 0
        for lane, end in enumerate(self.after[-1].tolist()):
            carry[lane] = r
            r = step[0][r & 255] ^ step[1][(r >> 8) & 255] ^ step[2][(r >> 16) & 255] ^ step[3][r >> 24] ^ end
        self.carry = carry

    def stretches(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """zlib's CRC-32 of each non-empty stretch [start, end)."""
        lane_a, at_a = np.divmod(starts, self.width)
        lane_b = (ends - 1) // self.width
        at_b = ends - lane_b * self.width
        a, b = self.after[at_a, lane_a], self.after[at_b, lane_b]
        far = np.flatnonzero(lane_a != lane_b)
        a[far] ^= shifted(self.carry[lane_a[far]], at_a[far])
        b[far] ^= shifted(self.carry[lane_b[far]], at_b[far])
        lengths = ends - starts
        return b ^ shifted(a ^ _U32(_FULL), lengths) ^ _U32(_FULL)


def _shift_by(n: int) -> list[list[int]]:
    single = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * _U32(8))[:, None]
    return [shifted(row, np.full(256, n)).tolist() for row in single]


def features(data: np.ndarray, offsets: np.ndarray, buckets: int = BUCKETS, max_gram: int = MAX_GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(buckets of all runs of 1 to ``max_gram`` words, the text each belongs to, words of each text)."""
    data = LOWER[data]
    inside = _WORD[data]
    starts, ends = spans(inside, offsets)
    owner = np.searchsorted(offsets, starts, side="right") - 1
    n_words = np.bincount(owner, minlength=len(offsets) - 1)
    kept = inside
    parting = ends[ends < offsets[owner + 1]]  # one byte after each word, unless the text ends there
    kept[parting] = True
    data[parting] = 0x20
    place = np.concatenate([[0], np.cumsum(kept)])
    crc = PrefixCrc(data[kept])
    found, whose = [], []
    for k in range(1, max_gram + 1):
        runs = np.flatnonzero(owner[:len(owner) - k + 1] == owner[k - 1:]) if len(owner) >= k else np.zeros(0, np.int64)
        found.append(crc.stretches(place[starts[runs]], place[ends[runs + k - 1]]) % _U32(buckets))
        whose.append(owner[runs])
    return np.concatenate(found).astype(np.int64), np.concatenate(whose), n_words


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, max_gram: int = MAX_GRAM) -> dict[int, int]:
    """{bucket: features}, over whole texts. A task sends one row per bucket; the driver gets at most ``buckets`` rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in slices(batch):
                total += np.bincount(features(*utf8(part.column(0)), buckets, max_gram)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])

    counts = texts.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    return {r["bucket"]: r["n"] for r in counts.collect()}


def gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln) of how much likelier a bucket is in the target, each count increased by one."""
    s_all, t_all = float(sum(source.values()) + buckets), float(sum(target.values()) + buckets)
    ratio = [(target.get(b, 0) + 1.0) * s_all / ((source.get(b, 0) + 1.0) * t_all) for b in range(buckets)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, max_gram: int = MAX_GRAM) -> DataFrame:
    """docs (doc_id, text) as doc_id, n_features, n_words, weight. NULL texts, and those without a word, have weight 0."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # one number per bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = shared.value
        for batch in batches:
            for part in slices(batch):
                found, whose, n_words = features(*utf8(part.column(1)), len(g), max_gram)
                n = np.bincount(whose, minlength=part.num_rows)
                total = np.zeros(part.num_rows, np.int64)
                np.add.at(total, whose, g[found])
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n), pa.array(n_words), pa.array(total // np.maximum(n, 1))],
                                                 names=["doc_id", "n_features", "n_words", "weight"])

    schema = docs.select("doc_id").schema.add("n_features", "long").add("n_words", "long").add("weight", "long")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """floor(1000 times a Gumbel number) seeded by the id; a NULL id counts as an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def draw(scored: DataFrame, share: tuple[int, int] = (10, 100), min_words: int = MIN_WORDS) -> DataFrame:
    """scored (doc_id, n_features, n_words, weight, score) and rank: 1, 2, 3 ... for the share of highest scores among the rows of at
    least ``min_words`` words, ties to the smaller doc_id (NULL first, then by weight and features); NULL for all others.

    Scores are whole numbers within a few ten thousand of 0, so the table of rows per score is bounded whatever the input; its running
    sum gives each score's first rank, and only rows of one drawn score are ordered together. Equal rows are counted before they meet, so an
    id that holds a third of all rows is one row there.
    """
    cols = ["doc_id", "n_features", "n_words", "weight", "score"]
    rows = scored.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies"))
    per_score = rows.filter(F.col("n_words") >= min_words).groupBy("score").agg(F.sum("copies").alias("n"))
    down = Window.orderBy(F.desc("score"))
    first = per_score.select(F.col("score").alias("score__"), (F.sum("n").over(down) - F.col("n")).alias("before"),
                             F.floor(F.sum("n").over(Window.partitionBy()) * share[0] / share[1]).cast("long").alias("drawn"))
    met = rows.join(first, (F.col("n_words") >= min_words) & (F.col("score") == F.col("score__")), "left")
    late = F.col("before").isNull() | (F.col("before") >= F.col("drawn"))
    within = Window.partitionBy("score").orderBy("doc_id", "weight", "n_features", "n_words")
    ranked = met.filter(~late).withColumn("before", F.col("before") + F.sum("copies").over(within) - F.col("copies"))
    rank = F.col("before") + F.col("copy") + 1
    out = ranked.unionByName(met.filter(late)).withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    return out.select(*cols, F.when(rank <= F.col("drawn"), rank).alias("rank"))


def resample(docs: DataFrame, target: DataFrame, share: tuple[int, int] = (10, 100), buckets: int = BUCKETS, max_gram: int = MAX_GRAM,
             seed: int = SEED, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, n_features, n_words, weight, score, rank) of every row of docs (doc_id, text) against the texts of ``target``.

    Other columns of either table are not read. NULL texts have no words. Repeated rows stay, with a rank each. An empty target
    gives every bucket its gain from the documents alone; no documents: no rows.
    """
    gain = gains(bucket_counts(docs, buckets, max_gram), bucket_counts(target, buckets, max_gram), buckets)
    scored = weights(docs, gain, max_gram).withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
    return draw(keep(scored, "importance"), share, min_words)

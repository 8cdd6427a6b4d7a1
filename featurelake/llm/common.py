"""Helpers shared by the operators: tables in the shared folder, and vectorised scans of Arrow text columns."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelake.session import scratch_dir
from featurelake.sources.tables import table

#: Texts are scanned in slices of about this many bytes, so a task's memory does not follow its batch size.
SLICE_BYTES = 2 << 20

#: Bytes that part words: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: A-Z to a-z, nothing else.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_U = np.uint64
_BYTE = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
_BYTE_LOWER = _BYTE[LOWER]
_STEP = 0x9E3779B97F4A7C15
_STEP_INVERSE = pow(_STEP, -1, 1 << 64)
_MIX = np.random.default_rng(20240608).integers(0, 2**63, 64, dtype=np.uint64) | _U(1)
_powers: dict[int, np.ndarray] = {}

WORD = r"[^\x20\x09-\x0D]+"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the cluster's shared folder and read it back: lineage ends there, and a lost executor
    loses nothing. The folder is the one named by ``spark.checkpoint.dir``."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package also when only the driver's sys.path holds it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment.setdefault("PYTHONPATH", root)


def remainder(doc_id: str | Column, n: int) -> Column:
    """crc32(doc_id as text) mod n; NULL for a NULL id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % n


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n + 1 powers of an odd 64-bit step, and of its inverse."""
    for k, step in ((0, _STEP), (1, _STEP_INVERSE)):
        if len(_powers.get(k, ())) <= n:
            p = np.full(max(n, SLICE_BYTES) + 1, step, dtype=np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0][:n + 1], _powers[1][:n + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def utf8(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and its n + 1 offsets; NULL counts as empty."""
    if arr.null_count:
        arr = arr.fill_null("")
    if len(arr) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, at, data = arr.buffers()
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, offsets - offsets[0]


def slices(batch: pa.RecordBatch, text: str = "text", size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``size`` bytes of text; a longer text stands alone.

    After a batch, memory that Arrow holds unused goes back: Python workers live on between stages.
    """
    if batch.num_rows == 0:
        return
    _, offsets = utf8(batch.column(batch.schema.get_field_index(text)))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi
    pa.default_memory_pool().release_unused()


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` bytes; no run crosses a text's border."""
    before = np.empty(len(inside) + 1, bool)
    before[0] = False
    before[1:] = inside
    after = np.empty(len(inside) + 1, bool)
    after[:-1] = inside
    after[-1] = False
    border = offsets[1:-1]
    before[border] = False
    starts = np.flatnonzero(inside & ~before[:-1])
    cut = border[border > 0] - 1
    after = after[1:]
    after[cut] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each span's bytes: a polynomial in an odd step over random byte values, then mixed.

    Spans are sums between two points of one running total, so each byte is touched once.
    """
    up, down = powers(len(data))
    total = np.empty(len(data) + 1, np.uint64)
    total[0] = 0
    np.cumsum((_BYTE_LOWER if lower else _BYTE)[data] * up[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts])


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (A-Z lower-cased) of all texts, and for each text the place of its first word (n + 1)."""
    starts, ends = spans(~SPACE[data], offsets)
    return span_hashes(data, starts, ends), np.searchsorted(starts, offsets)


def shingles(words: np.ndarray, first: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all k-word shingles of all texts in order, and the place of each text's first one (n + 1).

    A text of fewer than k words has its whole sequence as one shingle; one without words has none.
    """
    n = np.diff(first)
    count = np.where(n >= k, n - k + 1, (n > 0).astype(np.int64))
    at = np.concatenate([[0], np.cumsum(count)])
    full = len(words) - k + 1
    if full > 0:
        h = words[:full] * _MIX[0]
        for j in range(1, k):
            h += words[j:full + j] * _MIX[j]
        h = mix(h)
    else:
        h = np.zeros(0, np.uint64)
    out = np.zeros(at[-1], np.uint64)
    if at[-1]:
        place = np.arange(at[-1]) - np.repeat(at[:-1], count) + np.repeat(first[:-1], count)
        long_enough = np.repeat(n >= k, count)
        out[long_enough] = h[place[long_enough]]
        for i in np.flatnonzero((n > 0) & (n < k)):
            own = words[first[i]:first[i + 1]]
            out[at[i]:at[i] + 1] = mix((own * _MIX[:len(own)]).sum(dtype=np.uint64, keepdims=True) + _MIX[20 + len(own)])
    return out, at

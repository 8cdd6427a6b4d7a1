"""Operator 1, language ID: prediction by partial matching with frozen statistics.

Per language a context tree counts which byte follows each context of up to ``ORDER`` bytes. A byte's
probability comes from the longest context seen; what that context has not seen escapes to the next shorter one
(escape count: the number of different bytes seen), with the bytes already offered excluded, down to a uniform
choice among the bytes left. The probabilities of a context sum to 1, so the negative logarithm summed over a text
is an exact code length. Statistics are frozen after training, so the code length of a byte depends on its
``ORDER`` predecessors only: all contexts' distributions are laid out once as a table, and scoring whole texts is a
table lookup per byte.

Training data: a bounded sample of labelled texts (about ``docs_per_lang`` whole documents and ``bytes_per_lang`` bytes per
language, chosen by a hash of the id). The counts are made by Spark tasks and written; only counts of the bounded sample reach the driver.

There may be any number of languages. A language's code lengths follow from its own counts, so languages are taken in groups
whose tables stay under ``TABLE_BYTES``: one group at a time reaches the driver and is broadcast, and the documents are scanned once per
group, each scan adding to a document's least code length and to the sum that its posterior needs. A handful of languages is one group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from featurelake.llm.common import keep, slices, utf8

ORDER = 3
DOCS_PER_LANG = 300
BYTES_PER_LANG = 16 << 20
BROADCAST_LABELS = 100_000
#: Bound of a group's table, unless a single language has more.
TABLE_BYTES = 256 << 20


def training_sample(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, bytes_per_lang: int = BYTES_PER_LANG) -> DataFrame:
    """(lang, text): about ``docs_per_lang`` documents and ``bytes_per_lang`` bytes of each language at most, by a hash of the id."""
    docs = docs.select("doc_id", "text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL AND doc_id IS NOT NULL")
    shares = keep(docs.groupBy(F.col("lang").alias("lang__")).agg(F.least(
        F.lit(1.0), docs_per_lang / F.count(F.lit(1)), bytes_per_lang / F.greatest(F.sum(F.octet_length("text").cast("long")), F.lit(1))).alias("share")), "shares")
    if shares.count() <= BROADCAST_LABELS:  # texts are not dealt out by label, unless labels are too many to be sent along
        shares = F.broadcast(shares)
    unit = (F.xxhash64(F.lit("language sample"), "doc_id").bitwiseAND(F.lit((1 << 30) - 1)) / float(1 << 30))
    return docs.withColumn("unit__", unit).join(shares, F.col("lang") == F.col("lang__")).filter(F.col("unit__") < F.col("share")).select("lang", "text")


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, gram, n): counts of every (ORDER + 1)-byte gram, in which 256 stands for "before the text"."""
    for batch in batches:
        for part in slices(batch):
            data, offsets = utf8(pc.utf8_lower(part.column(1)))
            if not len(data):
                continue
            lang = part.column(0).dictionary_encode()
            code = np.asarray(lang.indices.to_numpy(zero_copy_only=False), np.int64)
            symbols = data.astype(np.int64)
            gram = symbols + 512 * _before(symbols, offsets, 256, 512)
            owner = np.repeat(code, np.diff(offsets))
            both, n = np.unique(owner << 36 | gram, return_counts=True)
            yield pa.RecordBatch.from_pydict({"lang": lang.dictionary.take(pa.array(both >> 36)), "gram": pa.array(both & (1 << 36) - 1), "n": pa.array(n)})


def _before(symbols: np.ndarray, offsets: np.ndarray, edge: int, base: int) -> np.ndarray:
    """The ORDER predecessors of each symbol as one number, nearest first; before a text's start stands ``edge``."""
    out = np.zeros(len(symbols), symbols.dtype)
    scale = 1
    for back in range(1, ORDER + 1):
        prior = np.full(len(symbols), edge, symbols.dtype)
        prior[back:] = symbols[:-back]
        for j in range(back):
            at = offsets[:-1] + j
            prior[at[at < offsets[1:]]] = edge
        prior *= scale
        out += prior
        scale *= base
    return out


class Model:
    """Frozen statistics as tables: byte -> symbol, three symbols -> context row, (context row, symbol) -> bits."""

    def __init__(self, langs: list[str], lang: np.ndarray, gram: np.ndarray, n: np.ndarray):
        self.langs = langs
        parts = [(gram >> (9 * k)) & 511 for k in range(ORDER + 1)]  # the byte, then its predecessors, nearest first
        seen = np.unique(parts[0])
        self.a = a = len(seen) + 1  # symbol 0: a byte never seen, or the edge of the text
        self.symbol = np.zeros(512, np.int32)
        self.symbol[seen] = np.arange(1, a)
        parts = [self.symbol[p].astype(np.int64) for p in parts]
        rows: list[np.ndarray] = [np.zeros(1, np.int64)]
        for k in range(1, ORDER + 1):
            key = sum(parts[j] * a ** (j - 1) for j in range(1, k + 1))
            ok = np.all([parts[j] > 0 for j in range(1, k + 1)], axis=0)
            rows.append(np.unique(key[ok]))
        start = np.cumsum([0] + [len(r) for r in rows])
        # the row of a context: its own if seen in any language, else that of the next shorter one
        row = np.zeros(1, np.int32)
        for k in range(1, ORDER + 1):
            row = np.tile(row, a)
            row[rows[k]] = start[k] + np.arange(len(rows[k]))
        self.row = row
        self.bits = np.empty((start[-1], a, len(langs)), np.float32)
        for i in range(len(langs)):
            own = lang == i
            self._distributions(i, [p[own] for p in parts], n[own], rows, start)
        self.bits = self.bits.reshape(start[-1] * a, len(langs))

    def _distributions(self, i: int, parts: list, n: np.ndarray, rows: list, start: np.ndarray) -> None:
        a = self.a
        counts = []
        for k in range(ORDER + 1):
            table = np.zeros((len(rows[k]), a))
            ok = np.all([parts[j] > 0 for j in range(1, k + 1)], axis=0) if k else np.ones(len(n), bool)
            key = sum(parts[j] * a ** (j - 1) for j in range(1, k + 1)) if k else np.zeros(len(n), np.int64)
            np.add.at(table, (np.searchsorted(rows[k], key[ok]), parts[0][ok]), n[ok])
            table[:, 0] = 0
            counts.append(table)
        for k in range(ORDER + 1):
            for lo in range(0, len(rows[k]), 4096):
                key = rows[k][lo:lo + 4096]
                p = np.zeros((len(key), a))
                mass, offered = np.ones(len(key)), np.zeros((len(key), a), bool)
                for j in range(k, -1, -1):
                    if j:
                        at = np.searchsorted(rows[j], key % a ** j)
                    else:
                        at = np.zeros(len(key), np.int64)
                    c = np.where(offered, 0, counts[j][at])
                    total, kinds = c.sum(1), (c > 0).sum(1)
                    some = total > 0
                    p[some] += c[some] * (mass[some] / (total + kinds)[some])[:, None]
                    mass[some] *= (kinds / np.maximum(total + kinds, 1))[some]
                    offered |= c > 0
                left = 256 - offered.sum(1)
                p += np.where(offered, 0, (mass / np.maximum(left, 1))[:, None])
                self.bits[start[k] + lo:start[k] + lo + len(key), :, i] = -np.log2(p)

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every text under every language (texts x languages)."""
        out = np.zeros((len(offsets) - 1, len(self.langs)))
        if not len(data):
            return out
        a = self.a
        s = self.symbol[data]
        cell = self.row[_before(s, offsets, 0, a)].astype(np.int64)  # at most 256 ** 3 contexts: 32 bits hold them
        cell *= a
        cell += s
        filled = np.flatnonzero(np.diff(offsets) > 0)
        out[filled] = np.add.reduceat(self.bits[cell], offsets[filled], axis=0, dtype=np.float64)
        return out


class Models:
    """Written counts (lang, gram, n), and the languages in groups."""

    def __init__(self, counts: DataFrame, groups: list[list[str]]):
        self.counts, self.groups = counts, groups
        self.langs = [x for g in groups for x in g]

    def group(self, i: int) -> Model:
        langs = self.groups[i]
        mine = self.counts if len(self.groups) == 1 else self.counts.filter((F.col("lang") >= langs[0]) & (F.col("lang") <= langs[-1]))
        got = mine.toArrow()
        code = pc.index_in(got["lang"], pa.array(langs, pa.string())).to_numpy()
        return Model(langs, code, got["gram"].to_numpy(), got["n"].to_numpy())


def grouped(sizes: list[tuple[str, int, int]], table_bytes: int = TABLE_BYTES) -> list[list[str]]:
    """Languages in order of name, as many together as surely stay under ``table_bytes``, of (language, contexts, bytes it uses)."""
    groups: list[list[str]] = []
    contexts = symbols = 0
    for lang, c, a in sizes:
        contexts, symbols = contexts + c, min(257, symbols + a)
        if not groups or 4 * contexts * symbols * (len(groups[-1]) + 1) > table_bytes:
            groups.append([])
            contexts, symbols = c, a
        groups[-1].append(lang)
    return groups


def train(docs: DataFrame, docs_per_lang: int = DOCS_PER_LANG, bytes_per_lang: int = BYTES_PER_LANG, table_bytes: int = TABLE_BYTES) -> Models:
    """Learn from (doc_id, text, lang); rows with a NULL in one of them teach nothing. No rows: no languages."""
    counts = keep(training_sample(docs, docs_per_lang, bytes_per_lang).mapInArrow(_grams, "lang string, gram long, n long")
                  .groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    context = F.shiftright("gram", 9)
    held = [F.count_distinct(F.col("context").bitwiseAND(F.lit((1 << 9 * k) - 1))) for k in range(1, ORDER + 1)]
    sizes = (counts.select("lang", context.alias("context"), F.col("gram").bitwiseAND(F.lit(511)).alias("symbol"))
             .groupBy("lang").agg(sum(held[1:], held[0] + 1).alias("contexts"), (F.count_distinct("symbol") + 1).alias("symbols")))
    # the names sort by their bytes in Spark and by their code points here, which is the same order
    return Models(counts, grouped([(r["lang"], r["contexts"], r["symbols"]) for r in sizes.orderBy("lang").collect()], table_bytes))


def predict(docs: DataFrame, models: Models) -> DataFrame:
    """docs' columns but ``text``, and lang_pred, score, bits_per_byte, of each whole text.

    lang_pred is the language of the least code length (ties: the first by name), score its posterior probability
    under equal priors. A NULL text, a text without a letter, or a model without languages: ``und``, score 0.
    Rows are neither joined nor dealt out, so repeated rows give repeated results. A column of docs named like a result gives way.
    """
    spark = docs.sparkSession
    new = ["lang_pred", "score", "bits_per_byte"]
    carried = [c for c in docs.columns if c not in ("text", *new)]
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    mark = "__"
    while any(c.endswith(mark) for c in carried):  # names that no column of the caller has
        mark += "_"
    best, least, total = (F.col(n + mark) for n in ("best", "least", "sum"))
    unread = [F.lit(None).cast(kind).alias(n + mark) for n, kind in (("best", T.StringType()), ("least", T.DoubleType()), ("sum", T.DoubleType()))]
    rows = docs.select("text", letters.alias("letters" + mark), *carried, *unread)
    schema = rows.schema

    def scan(model: Model):
        shared = spark.sparkContext.broadcast(model)  # a group's table, bounded by TABLE_BYTES or one language

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            m = shared.value
            names = np.array(m.langs, object)
            for batch in batches:
                for part in slices(batch):
                    data, offsets = utf8(pc.utf8_lower(part.column(0)))
                    bits = m.code_lengths(data, offsets)
                    best, least = names[bits.argmin(1)], bits.min(1)
                    with np.errstate(over="ignore", under="ignore", invalid="ignore"):
                        total = np.exp2(least[:, None] - bits).sum(1)
                        old = part.column(part.num_columns - 2)
                        if old.null_count < len(old):  # the sum of powers moves to the lesser of the two least lengths
                            held, before = old.to_numpy(), part.column(part.num_columns - 1).to_numpy()
                            low = np.minimum(held, least)
                            total = before * np.exp2(low - held) + total * np.exp2(low - least)
                            best = np.where(held <= least, np.array(part.column(part.num_columns - 3).to_pylist(), object), best)
                            least = low
                    yield pa.RecordBatch.from_arrays([*part.columns[:-3], pa.array(best, pa.string()), pa.array(least), pa.array(total)], names=schema.names)
        return run

    for i in range(len(models.groups)):
        if i:  # one group's table in a worker at a time
            rows = keep(rows, "languages")
        rows = rows.mapInArrow(scan(models.group(i)), schema)
    told = F.col("letters" + mark) & best.isNotNull()
    length = F.greatest(F.octet_length(F.lower("text")), F.lit(1))
    return rows.select(*carried, F.when(told, best).otherwise("und").alias("lang_pred"), F.when(told, 1 / total).otherwise(0.0).alias("score"),
                       F.when(told, least / length).otherwise(0.0).alias("bits_per_byte"))


def identify(docs: DataFrame, labelled: DataFrame, docs_per_lang: int = DOCS_PER_LANG) -> DataFrame:
    """Train on ``labelled`` and predict ``docs``."""
    return predict(docs, train(labelled, docs_per_lang))

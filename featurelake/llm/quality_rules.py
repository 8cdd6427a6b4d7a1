"""Operator 6, quality rules: cross-document line frequency, in DataFrame functions only.

A line's normal form is its words, lower-cased, joined by one space. For each host (the ``source`` column) and normal
form the distinct documents are counted. A line is boilerplate where that count is above
``max(limit_docs, limit_share * documents of the host)``; it is removed from every document of the host but the one
with the smallest id, so no content is lost with all its places. A document that loses more than ``depleted`` of its words
is rejected, as is one that fails the base rules.

Counting is two aggregates (distinct documents of a line, then their number), both combined before their shuffle; only
lines above their limit are joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from featurelake.llm.common import WORD

LIMIT_DOCS, LIMIT_SHARE, DEPLETED = 20, 0.02, 0.5
WINDOW, MIN_WORDS, MAX_REPEATED = 8, 20, 0.30
GAP = r"[\x20\x09-\x0D]+"


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, GAP), lambda w: w != "")


def line_hashes(text: Column) -> Column:
    """One (h, words) per line of the text: a hash of the normal form and the number of words; h is NULL for a line without words."""
    def one(line: Column) -> Column:
        words = F.trim(F.regexp_replace(F.lower(line), GAP, " "))
        return bind(words, lambda w: F.struct(F.when(w != "", F.xxhash64(w)).alias("h"),
                                              F.when(w != "", F.length(w) - F.length(F.replace(w, F.lit(" "), F.lit(""))) + 1).otherwise(0).alias("words")))
    return F.transform(F.split(text, "\n", -1), one)


def n_repeat_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in a run of ``window`` words found twice or more in the text, first places included."""
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (window - 1)), lambda i: F.xxhash64(F.slice(words, i, window)))

    def covered(h: Column) -> Column:
        placed = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = bind(placed, lambda s: F.transform(F.filter(
            F.transform(s, lambda x, k: F.struct(x["i"].alias("i"), (
                ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False))).alias("twice"))),
            lambda x: x["twice"]), lambda x: x["i"]))
        return bind(F.sort_array(twice), lambda p: F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - x, F.lit(window)))), F.lit(0), lambda a, x: a + x))

    return F.when(F.size(words) <= window, F.lit(0)).otherwise(
        bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))


def base(docs: DataFrame) -> DataFrame:
    """docs' columns and n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed of each whole ``text``.

    NULL counts as empty: all counts 0, base_failed true. Columns of docs with those names give way.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    repeated = bind(F.filter(F.transform(F.split(text, "\n", -1), lambda x: F.when(x.rlike(WORD), x)), lambda x: x.isNotNull()),
                    lambda x: F.size(x) - F.size(F.array_distinct(x)))
    stats = bind(words_of(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), n_repeat_words(w).cast("long").alias("n_repeat_words")))
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    carried = [c for c in docs.columns if c not in new]
    got = docs.select(*carried, stats.alias("stats__"),
                      F.length(F.regexp_replace(text, GAP, "")).cast("long").alias("word_chars"),
                      (F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
                      repeated.cast("long").alias("n_dup_lines"))
    n, r = F.col("stats__.n_words"), F.col("stats__.n_repeat_words")
    return got.select(*carried, n.alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", r.alias("n_repeat_words"),
                      ((n < MIN_WORDS) | (100 * r > int(100 * MAX_REPEATED) * n)).alias("base_failed"))


def frequent_lines(docs: DataFrame, limit_docs: int = LIMIT_DOCS, limit_share: float = LIMIT_SHARE) -> DataFrame:
    """(host, h, n_docs, first_doc): the lines above their host's limit. A NULL source counts as an empty one."""
    host = F.coalesce(F.col("source"), F.lit("")).alias("host")
    lines = docs.select(host, "doc_id", F.explode(F.array_distinct(F.transform(line_hashes(F.col("text")), lambda x: x["h"]))).alias("h")).filter("h IS NOT NULL")
    counts = lines.distinct().groupBy("host", "h").agg(F.count(F.lit(1)).alias("n_docs"), F.min("doc_id").alias("first_doc")).filter(F.col("n_docs") > limit_docs)
    hosts = docs.select(host, "doc_id").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    return counts.join(hosts, "host").filter(F.col("n_docs") > F.col("host_docs") * limit_share).drop("host_docs")


def verdicts(docs: DataFrame, limit_docs: int = LIMIT_DOCS, limit_share: float = LIMIT_SHARE, depleted: float = DEPLETED) -> DataFrame:
    """One row per distinct (doc_id, text, source) of docs: doc_id, the base counts, base_failed, n_removed_words, kept.

    Rows equal in all three are one document and give one row each with the same verdict. A document of a NULL doc_id
    is judged as any other. NULL and empty texts fail the base rules. No rows: no rows.
    """
    docs = docs.select("doc_id", "text", "source")
    host = F.coalesce(F.col("source"), F.lit("")).alias("host")
    frequent = frequent_lines(docs, limit_docs, limit_share).select(F.col("host"), F.col("h"), "first_doc")
    lines = (docs.select("doc_id", host, F.explode(line_hashes(F.col("text"))).alias("line")).select("doc_id", "host", "line.*").filter("h IS NOT NULL")
             .groupBy("doc_id", "host", "h").agg(F.sum("words").alias("words")))
    removed = (lines.join(frequent, ["host", "h"]).filter(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
               .groupBy(F.col("doc_id").alias("id__"), F.col("host").alias("host__")).agg(F.sum("words").alias("n_removed_words")))
    judged = base(docs).drop("text").withColumn("host__", host)
    gone = F.coalesce("n_removed_words", F.lit(0)).cast("long")
    return (judged.join(removed, F.col("doc_id").eqNullSafe(F.col("id__")) & (judged["host__"] == removed["host__"]), "left")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                    gone.alias("n_removed_words"), (~F.col("base_failed") & (gone <= depleted * F.col("n_words"))).alias("kept")))

"""The corpus pipeline: language ID, line dedup, near-duplicate removal, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which ``run`` writes as Parquet to the shared folder
and rereads as the next stage's docs. All stages but the last return the columns of documents, and further columns of their
input as they are, whatever their names. Rows with a NULL doc_id, repeated rows and rows of one doc_id with different texts
are documents like any other. NULL and empty texts: no language (stage 1 rejects them), nothing to cut, no near duplicate, no
benchmark item, one piece of the end mark alone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from featurelake.llm import common, decontaminate, language_id, line_dedup, ngram_join, packing

#: Documents whose best language has less than this posterior probability are rejected.
MIN_SCORE = 0.5


def _own(docs: DataFrame) -> list[Column]:
    """All columns under private names, which no operator's results clash with."""
    return [F.col(f"`{c}`").alias(f"own__{i}") for i, c in enumerate(docs.columns)]


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1. Rejects documents without a letter and those that no language explains better than the others together.

    The model learns from the labelled documents of the stage's input; all columns stay as they are. Where none is labelled,
    only documents without a letter are rejected.
    """
    model = language_id.train(docs)
    if not model.langs:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    marked = language_id.predict(docs.select("text", *_own(docs)), model)
    kept = marked.filter((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE))
    return kept.select(*[F.col(f"own__{i}").alias(c) for i, c in enumerate(docs.columns)])


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4. Later repeats of runs of 50 words or more are cut out; n_chars follows; a document cut to nothing goes."""
    done = line_dedup.dedup(docs.select("doc_id", "text", *[c for c, name in zip(_own(docs), docs.columns) if name != "text"]))
    own = {c: F.col(f"own__{i}") for i, c in enumerate(docs.columns) if c != "text"}
    n_chars = F.when(F.col("n_removed") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(own["n_chars"])
    new = own | {"text": F.col("text"), "n_chars": n_chars}
    return done.filter((F.col("n_removed") == 0) | F.col("text").rlike(r"\S")).select(*[new[c].alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2. Of each group of linked documents the first stays: the smallest doc_id (NULL last), then the smallest hash of the text.

    Its repeated rows, equal in both, stay with it. The operator knows a document by a hash of its id and text, so neither NULL ids
    nor two texts of one id are taken for each other.
    """
    name, unnamed = F.xxhash64("doc_id", "text"), F.col("doc_id").isNull()
    groups = ngram_join.components(docs.select(name.alias("doc_id"), "text")).select(F.col("doc_id").alias("name"), "component_id").distinct()
    ids = docs.select(name.alias("name"), F.struct(unnamed.alias("unnamed"), "doc_id", name.alias("name")).alias("place")).distinct()
    firsts = groups.join(ids, "name").groupBy("component_id").agg(F.min("place").alias("place")).select(F.col("place.name").alias("name__"))
    return docs.join(firsts, name == F.col("name__"), "left_semi")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9. Documents that hold a benchmark item go."""
    return decontaminate.remove(docs, common.table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8. One row per piece, with its sequence and offset."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


def _shipped(stage: Callable) -> Callable:
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.ship_package(spark)
        return stage(spark, docs, sf_dir)

    run_stage.__doc__ = stage.__doc__
    return run_stage


STAGES = [(name, _shipped(stage)) for name, stage in (
    ("language_id", language_stage), ("line_dedup", line_stage), ("ngram_join", near_duplicate_stage),
    ("decontamination", decontamination_stage), ("packing", packing_stage))]

#: Language models and code lengths are not SQL's; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = common.keep(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs

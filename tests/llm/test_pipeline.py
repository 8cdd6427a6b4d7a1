"""The pipeline's stages on small data, each held against a plain version; the registered queries' oracles."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
import corpus_pipeline
from featurelake.llm import common, queries
from tests.conftest import SF_SMALL
from tests.llm.test_operators import components_by_hand, dedup_by_hand, low
from tests.oracle_check import canon, duck


def test_stages(spark):
    docs = common.documents(spark, SF_SMALL)
    columns = docs.columns
    bench = [low(" ".join(r["text"].split())) for r in common.table(spark, SF_SMALL, "benchmark").collect()]
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_join", "decontamination", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r for r in docs.collect()}
        docs = common.keep(stage(spark, docs, SF_SMALL), name)
        if name == "packing":
            assert {r["doc_id"] for r in docs.collect()} == set(before)
            break
        assert docs.columns == columns
        after = {r["doc_id"]: r for r in docs.collect()}
        if name == "language_id":
            assert after == {i: r for i, r in before.items() if any(c.isalpha() for c in r["text"] or "")}
        if name == "line_dedup":
            want = dedup_by_hand([(i, r["text"]) for i, r in before.items()])
            assert {i: r["text"] for i, r in after.items()} == {i: t for i, t in want.items() if t.strip() or t == before[i]["text"]}
        if name == "ngram_join":
            groups = components_by_hand([(i, r["text"]) for i, r in before.items()])
            assert set(after) == {i for i, (_, c) in groups.items() if c == i}
        if name == "decontamination":
            holds = {i for i, r in before.items() if any(b in low(" ".join(r["text"].split())) for b in bench)}
            assert set(after) == set(before) - holds


def test_stages_take_empty_tables(spark):
    docs = common.documents(spark, SF_SMALL).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = common.keep(stage(spark, docs, SF_SMALL), name)
        assert docs.count() == 0


def test_language_stage_without_labels_rejects_only_texts_without_a_letter(spark, docs):
    rows = docs([(1, "some words", None), (2, "12 34", None), (3, None, None), (4, "日本語", None), (4, "日本語", None), (5, "", None)])
    got = corpus_pipeline.language_stage(spark, rows, SF_SMALL)
    assert got.columns == rows.columns and sorted(r["doc_id"] for r in got.collect()) == [1, 4, 4]


def test_stages_keep_clashing_columns(spark):
    docs = common.documents(spark, SF_SMALL)
    own = {"score": 7.5, "lang_pred": "mine", "bits_per_byte": 1.5, "n_lines": 77, "n_removed": 9, "doc_tokens": 3, "component_id": 4, "similarity": 0.5, "removed": 1}
    for name, stage in corpus_pipeline.STAGES[:4]:
        given = docs.select("*", *[F.lit(v).alias(c) for c, v in own.items()])
        got = stage(spark, given, SF_SMALL)
        assert got.columns == given.columns
        rows = got.collect()
        assert rows and all(r[c] == v for r in rows for c, v in own.items())
        plain = common.keep(stage(spark, docs, SF_SMALL), name)
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in plain.collect())
        docs = plain


def test_near_duplicates_with_null_and_repeated_ids(spark, docs):
    a, b, c, d = (" ".join(f"{k}{i}" for i in range(40)) for k in "abcd")
    rows = [(20, a), (None, a), (None, b), (None, b), (None, "x"), (None, None), (5, c), (5, d), (5, d), (9, d + " more"), (8, c), (3, None), (3, ""), (None, "x")]
    got = corpus_pipeline.near_duplicate_stage(spark, docs(rows), SF_SMALL)
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    want = [(20, a), (None, b), (None, b), (None, "x"), (None, "x"), (None, None), (5, c), (5, d), (5, d), (3, None), (3, "")]
    assert kept == sorted(want, key=str)


def test_other_stages_with_null_and_repeated_ids(spark, docs):
    line = " ".join(f"w{i}" for i in range(60))
    item = common.table(spark, SF_SMALL, "benchmark").first()["text"]
    rows = docs([(None, line), (1, f"{line}\nown words"), (1, "other words"), (1, "other words"), (2, item), (None, item), (None, None)])
    cut = {(r["doc_id"], r["text"], r["n_chars"]) for r in corpus_pipeline.line_stage(spark, rows, SF_SMALL).collect()}
    assert (None, line, len(line)) in cut and (1, "own words", 9) in cut and (1, "other words", 11) in cut and (None, None, 0) in cut
    assert sorted(str(r["text"]) for r in corpus_pipeline.decontamination_stage(spark, rows, SF_SMALL).collect()) == sorted(
        [line, f"{line}\nown words", "other words", "other words", "None"])
    assert corpus_pipeline.packing_stage(spark, rows, SF_SMALL).count() == 7


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_oracle(spark, name):
    got = queries.QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck(SF_SMALL).execute(queries.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and canon(got) == canon(want)


def test_registered():
    names = se.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}

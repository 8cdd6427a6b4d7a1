"""Operator 12 against zlib, a plain resampler, and its SQL."""

import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as se
from featurelake.llm import importance
from featurelake.llm.common import utf8
from tests.conftest import SF_SMALL
from tests.oracle_check import canon, duck

WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))


def grams(text, n):
    ws = words(text)
    return [zlib.crc32(b" ".join(ws[i:i + k])) for k in range(1, n + 1) for i in range(len(ws) - k + 1)]


def by_hand(docs, target, share=(10, 100), buckets=10_000, n=1, seed=2024, min_words=20):
    """Plain rows of (doc_id, n_features, n_words, weight, score, rank)."""
    count = lambda texts: np.bincount([g % buckets for t in texts for g in grams(t, n)], minlength=buckets)
    s, t = count([d[1] for d in docs]), count(target)
    gain = [math.floor(1000 * math.log((t[b] + 1.0) * (float(s.sum()) + buckets) / ((s[b] + 1.0) * (float(t.sum()) + buckets)))) for b in range(buckets)]
    rows = []
    for doc_id, text in docs:
        g = grams(text, n)
        weight = sum(gain[x % buckets] for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(g), len(words(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    able = sorted((r for r in rows if r[2] >= min_words), key=lambda r: (-r[4], r[0] is not None, r[0] or 0, r[3], r[1], r[2]))
    drawn = able[:share[0] * len(able) // share[1]]
    rest = able[len(drawn):] + [r for r in rows if r[2] < min_words]
    return sorted([(*r, i + 1) for i, r in enumerate(drawn)] + [(*r, None) for r in rest], key=str)


@settings(max_examples=400, deadline=None)
@given(st.binary(min_size=1, max_size=600), st.data())
def test_stretches_equal_zlib(data, draw):
    at = [draw.draw(st.tuples(st.integers(0, len(data) - 1), st.integers(1, len(data)))) for _ in range(5)]
    at = [(a, b) if a < b else (a, a + 1) for a, b in at]
    got = importance.PrefixCrc(np.frombuffer(data, np.uint8)).stretches(*np.array(at).T)
    assert got.tolist() == [zlib.crc32(data[a:b]) for a, b in at]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB0 .\n-é漢\x7f{`/:@["), st.text()), min_size=1, max_size=5), st.integers(1, 4))
def test_features_equal_spelled_out_runs(texts, n):
    found, whose, counts = importance.features(*utf8(pa.array(texts, pa.string())), 1 << 32 - 1, n)
    for i, text in enumerate(texts):
        assert sorted(found[whose == i]) == sorted(g % (1 << 32 - 1) for g in grams(text, n))
        assert counts[i] == len(words(text))


def test_long_words_and_texts():
    text = "x" * 300_000 + " " + "word " * 100_000 + "é" * 70_000
    found, _, _ = importance.features(*utf8(pa.array([text, "b"])), 1 << 32 - 1, 2)
    assert sorted(found) == sorted(g % (1 << 32 - 1) for t in (text, "b") for g in grams(t, 2))


def test_resampling_equals_plain_rows(spark, docs):
    rng = np.random.default_rng(5)
    vocabulary = ["alpha", "Beta", "gamma", "42", "été", "of", "the"]
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 60)))) for i in range(150)]
    rows += [(7, rows[7][1])] * 40 + [(None, "the of " * 15)] * 3 + [(None, None), (200, ""), (201, "?!"), (202, "of " * 20), (202, "the " * 30)]
    target = ["alpha beta alpha", None, "", "été 42"]
    frame = spark.createDataFrame([(t,) for t in target], "text string")
    for n, share in ((1, (10, 100)), (3, (50, 100)), (1, (100, 100)), (1, (0, 100))):
        got = importance.resample(docs(rows, rank="own", score="own"), frame, share, max_gram=n).collect()
        assert sorted(map(tuple, got), key=str) == by_hand(rows, target, share, n=n)


def test_empty_tables(spark, docs):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(docs([]), none).collect() == []
    rows = [(1, "one two " * 10), (2, "three " * 25)]
    got = importance.resample(docs(rows), none, (50, 100)).collect()
    assert sorted(map(tuple, got), key=str) == by_hand(rows, [], (50, 100))


def test_an_id_with_a_third_of_all_rows_is_one_row_of_the_ranking(spark):
    rows = spark.range(9_000).select(F.when(F.col("id") < 3_000, 5).otherwise(F.col("id")).alias("doc_id"), F.lit(20).cast("long").alias("n_features"),
                                     F.lit(20).cast("long").alias("n_words"), F.lit(0).cast("long").alias("weight"))
    got = importance.draw(rows.withColumn("score", importance.gumbel(F.col("doc_id"))), (100, 100))
    ranks = sorted(r["rank"] for r in got.collect())
    assert ranks == list(range(1, 9_001))


def test_query_equals_its_sql(spark):
    got = se.queries()["op12_importance"](spark, SF_SMALL).toPandas()
    assert canon(got) == canon(duck(SF_SMALL).sql(se.oracle_sql()["op12_importance"]).df())

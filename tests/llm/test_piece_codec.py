"""Operator 11 against the library itself: whole tables, hostile texts, random ids."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from featurelake.llm import piece_codec
from featurelake.llm import queries as llm
from tests.conftest import SF_SMALL

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def coder():
    return piece_codec.codec(piece_codec.Vocabulary(MODEL))


TEXT = st.one_of(st.text(), st.text(alphabet=" ▁\n\taeinrst<>/s0x"), st.text(alphabet="a =-_▁"),
                 st.builds(lambda s, n: s * n, st.sampled_from([" ", "a", "=", "  ", "\n", "ab", "é", "▁"]), st.integers(0, 400)))


def test_encoding_and_decoding_equal_the_library(library, coder):
    @settings(max_examples=1500, deadline=None)
    @given(st.lists(TEXT, min_size=1, max_size=4))
    def check(texts):
        ids, first = coder.encode(texts)
        said, at = coder.decode(ids, first)
        for i, text in enumerate(texts):
            want = library.encode(text)
            assert ids[first[i]:first[i + 1]].tolist() == want
            assert said[at[i]:at[i + 1]].tobytes().decode() == library.decode(want)
    check()


def test_decoding_any_ids_equals_the_library(library, coder):
    @settings(max_examples=1500, deadline=None)
    @given(st.lists(st.one_of(st.integers(0, 258), st.integers(0, 31999), st.sampled_from([259, 28705])), max_size=12))
    def check(ids):
        said, at = coder.decode(np.array(ids, np.int32), np.array([0, len(ids)]))
        assert said.tobytes().decode() == library.decode(ids)
    check()


def test_each_prefix_has_one_last_token(coder):
    """At every end exactly one match of the automaton is compatible with the prefix before it."""
    for text in ("▁internationalisation", "▁▁▁▁▁▁▁a", "aaaaaaaaa", "▁the▁quick", "==========="):
        last = {}
        for end in range(1, len(text) + 1):
            found = [p for at, p in coder.automaton.iter(text) if at == end - 1
                     and (end == len(p) or coder.compatible(last[end - len(p)], p))]
            assert len(found) == 1
            last[end] = found[0]
            assert coder.tokens(text[:end]) == coder.merged(text[:end])


def test_a_cutting_of_a_million_characters_takes_linear_time(library, coder):
    text = "a" * 1_000_000
    ids, first = coder.encode([text])
    assert ids.tolist() == library.encode(text)


def test_memory_starts_anew(monkeypatch, library):
    monkeypatch.setattr(piece_codec, "MEMORY_CHARS", 20)
    monkeypatch.setattr(piece_codec, "MEMORY_PAIRS", 5)
    own = piece_codec.Codec(piece_codec.Vocabulary(MODEL))
    for text in ("some words here", "and further words", "some words here"):
        assert own.encode([text])[0].tolist() == library.encode(text)


@pytest.mark.parametrize("step", [1, 2, 7])
def test_steps_change_nothing(monkeypatch, library, coder, step):
    monkeypatch.setattr(piece_codec, "STEP", step)
    texts = ["some  words, here\n", "", "é漢😀 x", "a" * 50]
    ids, first = coder.encode(texts)
    said, at = coder.decode(ids, first)
    for i, text in enumerate(texts):
        assert ids[first[i]:first[i + 1]].tolist() == library.encode(text) and said[at[i]:at[i + 1]].tobytes().decode() == text


def test_rows_and_columns_stay(docs, library):
    rows = [(1, "one two"), (1, "one two"), (2, None), (3, ""), (None, "no id"), (4, "word " * 30_000)]
    done = piece_codec.decode(piece_codec.encode(docs(rows, ids="x", decoded="y", extra=7), MODEL), MODEL)
    assert done.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra", "ids", "decoded"]
    got = done.collect()
    assert len(got) == 6 and all(r.extra == 7 for r in got)
    for r in got:
        assert r.ids == library.encode(r.text or "") and r.decoded == (r.text or "")
    assert piece_codec.decode(piece_codec.encode(docs([]), MODEL), MODEL).collect() == []


def test_bad_ids_and_models_raise(spark, docs, tmp_path):
    with pytest.raises(Exception, match="outside the vocabulary"):
        piece_codec.decode(docs([(1, "a")]).withColumn("ids", F.array(F.lit(40_000))), MODEL).collect()
    from sentencepiece import sentencepiece_model_pb2

    other = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as f:
        other.ParseFromString(f.read())
    other.normalizer_spec.remove_extra_whitespaces = True
    (tmp_path / "other.model").write_bytes(other.SerializeToString())
    with pytest.raises(ValueError, match="merge-type"):
        piece_codec.Vocabulary(str(tmp_path / "other.model"))


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = llm.QUERIES["op11_sentencepiece"](spark, SF_SMALL).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = library.encode(texts[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())

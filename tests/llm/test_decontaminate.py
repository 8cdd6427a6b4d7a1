"""Operator 9 against every window of every document, in one block and in many."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from featurelake.llm import common, decontaminate
from tests.conftest import SF_SMALL
from tests.llm.test_operators import WORDS, low, prose

IN_WORD = __import__("re").compile(r"[0-9a-z\x80-\U0010ffff]+")


def _words(text):
    return IN_WORD.findall(low(text or "").lower())


def _grams(words, k=5):
    return Counter([tuple(words[i:i + k]) for i in range(len(words) - k + 1)] or ([tuple(words)] if words else []))


def by_hand(docs, items):
    """{(doc, item): the highest weighted similarity of all windows as long as the item}, where it is 0.8 or more."""
    grams = {i: _grams(_words(t)) for i, t in items if _words(t)}
    have, n = Counter(g for c in grams.values() for g in c), len(grams)
    out = {}
    for d, text in docs:
        words = _words(text)
        for i, t in items:
            if i not in grams or not words:
                continue
            m = min(len(_words(t)), len(words))
            weight = lambda g: 1 + np.log((n + 1) / (have[g] + 1)) if g in grams[i] else 1 + np.log(n + 1)  # noqa: B023, E731
            mass = sum(c * weight(g) for g, c in grams[i].items())
            for s in range(len(words) - m + 1):
                window = _grams(words[s:s + m])
                both = sum(min(c, window[g]) * weight(g) for g, c in grams[i].items())
                if not both:
                    continue
                similar = both / (sum(c * weight(g) for g, c in window.items()) + mass - both)
                if similar >= 0.8 - 1e-9 and similar > out.get((d, i), (0,))[0] + 1e-12:
                    out[d, i] = (similar, s)
    return out


@pytest.fixture()
def case():
    r = random.Random(3)
    prompt = prose(12, 99)
    items = [(i, f"{prompt} " * (i % 3 == 0) + prose(r.randint(6, 60), i)) for i in range(24)] + [(100, prompt), (101, prompt), (102, ""), (103, None), (104, "two words")]
    docs = []
    for d in range(60):
        said = (r.choice(items[:24])[1]).split()
        for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
            said[r.randrange(len(said))] = r.choice(WORDS)
        docs.append((d, f"{prose(r.randint(0, 40), 500 + d)} {' '.join(said)} {prose(r.randint(0, 40), 900 + d)}"))
    return docs + [(70, prompt), (71, None), (72, ""), (73, "Two, words!"), (74, prompt * 2)], items


@pytest.mark.parametrize("block_items", [5_000, 4, 2])
def test_all_windows_of_enough_similarity_are_found_in_any_blocks(spark, docs, case, block_items):
    rows, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(x["doc_id"], x["item_id"]): x["similarity"] for x in decontaminate.find(docs(rows), bench, block_items).collect()}
    want = by_hand(rows, items)
    assert set(got) <= set(want) and len(got) >= 0.9 * len(want) and len(want) > 40
    assert set(want) - set(got) <= {p for p, (s, _) in want.items() if s < 0.85}  # the radius may only miss near its border
    assert all(got[p] == pytest.approx(want[p][0], abs=1e-9) for p in got)


def test_blocks_do_not_change_a_similarity(spark, docs, case):
    rows, items = case
    bench = spark.createDataFrame(items, "item_id long, text string")
    one, many = (sorted(map(tuple, decontaminate.find(docs(rows), bench, n).collect())) for n in (5_000, 2))
    assert [x[:4] for x in one] == [x[:4] for x in many] and [x[4] for x in one] == pytest.approx([x[4] for x in many], abs=1e-12)
    assert sorted(r["doc_id"] for r in decontaminate.remove(docs(rows), bench).collect()) == sorted({d for d, _ in rows} - {x[0] for x in one})


def test_a_prompt_that_all_items_share_anchors_none_of_them():
    prompt = prose(30, 7)
    index = decontaminate.Index(list(range(500)), pa.array([f"{prompt} {prose(40, i)}" for i in range(500)]))
    assert index.have.max() < 50
    found = list(index.hits(pa.array([prompt * 200, f"x {prompt} {prose(40, 3)}"])))
    assert [(row, item) for row, item, *_ in found] == [(1, 3)]


def test_hits_are_met_in_bounded_steps(monkeypatch, case):
    rows, items = case
    index = decontaminate.Index([i for i, _ in items], pa.array([t for _, t in items]))
    texts = pa.array([t for _, t in rows])
    whole = list(index.hits(texts))
    monkeypatch.setattr(decontaminate, "HITS", 3)
    assert list(index.hits(texts)) == whole


def test_recall_on_the_given_tables(spark):
    """Every document that holds a window of similarity 0.8 or more of an item is found on the small tables."""
    docs = [(r["doc_id"], r["text"]) for r in common.documents(spark, SF_SMALL).collect() if len(r["text"] or "") < 3000]
    items = [(r["item_id"], r["text"]) for r in common.table(spark, SF_SMALL, "benchmark").collect()]
    got = {(x["doc_id"], x["item_id"]) for x in decontaminate.find(common.documents(spark, SF_SMALL), common.table(spark, SF_SMALL, "benchmark")).collect()}
    short = {d for d, _ in docs}
    known = {g for _, t in items for g in _grams(_words(t))}
    want = set(by_hand([(d, t) for d, t in docs if known & set(_grams(_words(t)))], items))
    assert len(want & got) >= 0.9 * len(want) and {p for p in got if p[0] in short} <= want

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessellar.llm import leakage as L


def brute(docs, items, w=24, k=2):
    out = set()
    for i, a in docs:
        for j, b in items:
            x, y = L.words(a or ""), L.words(b or "")
            if i is not None and j is not None and any(sum(p == q for p, q in zip(x[s : s + w], y[t : t + w])) >= w - k for s in range(len(x) - w + 1) for t in range(len(y) - w + 1)):
                out.add((i, j))
    return out


def run(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, "clash", 1) for i, t in docs], "doc_id bigint, text string, hash string, item_id int")
    h = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    return set(map(tuple, L.leaked(d, h, **kw).collect()))


@settings(max_examples=60, deadline=None)
@given(st.sets(st.integers(0, 23), max_size=2))
def test_masks_miss_nothing(bad):
    ok = [i not in bad for i in range(24)]
    assert any(all(ok[s + o] for o in m) for m in L.masks(24, 2) for s in range(24 - m[-1]))


@pytest.mark.parametrize("w,k", [(24, 2), (10, 1), (12, 0), (25, 3)])
def test_masks_exist(w, k):
    rng = random.Random(1)
    for _ in range(200):
        bad = set(rng.sample(range(w), k))
        assert any(all(s + o not in bad for o in m) for m in L.masks(w, k) for s in range(w - m[-1]))


def test_words_ignore_form():
    plain = L.words("The cross-reference café fills two foot notes")
    assert plain == L.words("THE “cross-\n> reference” café  fills, two\tfo­ot​ — notes!") and plain[1] == "crossreference"


def test_against_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(60)]
    text = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(i, text(60)) for i in range(12)] + [(50, text(23)), (51, [])]
    docs = []
    for i in range(80):
        own = text(rng.randrange(0, 120))
        _, it = rng.choice(items[:12])
        s, n = rng.randrange(30), rng.choice([20, 23, 24, 30])
        part = list(it[s : s + n])
        for p in rng.sample(range(len(part)), rng.choice([0, 1, 2, 3, 5])):
            part[p] = "odd"
        docs.append((i, own + part + text(5)))
    docs = [(i, " ".join(t).upper() if i % 2 else ", ".join(t)) for i, t in docs] + [(90, None), (91, ""), (None, " ".join(items[0][1])), (92, "x " * 3000), (0, docs[0][1][0])]
    items = [(i, " ".join(t)) for i, t in items] + [(None, " ".join(items[0][1])), (60, None), (3, " ".join(items[3][1]))]
    want = brute(docs, items)
    assert len(want) > 15
    assert run(spark, docs, items) == want
    assert run(spark, docs, items, max_rows=0) == want


def test_very_long_text_and_empty_tables(spark):
    item = " ".join(f"v{i}" for i in range(40))
    long = " ".join(f"u{i % 977}" for i in range(200_000)) + " " + item
    assert run(spark, [(1, long)], [(1, item)]) == {(1, 1)}
    assert run(spark, [], [(1, item)]) == set() and run(spark, [(1, item)], []) == set()


def test_items_report(spark):
    items = spark.createDataFrame([(1,), (2,)], "item_id bigint")
    pairs = spark.createDataFrame([(7, 1), (8, 1)], "doc_id bigint, item_id bigint")
    assert {r.item_id: r.n_documents for r in L.leaked_items(pairs, items).collect()} == {1: 2, 2: 0}


def test_chunks_cover():
    texts = ["a" * n for n in (3, 0, 9, 2, 2)] + [None]
    got = list(L._chunks(texts, 8))
    assert got[0][0] == 0 and got[-1][1] == 6 and all(a[1] == b[0] for a, b in zip(got, got[1:]))
    assert np.array_equal(L.masks(24, 2)[2], np.r_[0:6, 18:24])

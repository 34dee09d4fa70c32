import collections
import math
import random
import re

import pytest

from textlode.llm import mask_search
from textlode.llm.mask_search import search
from tests.llm.brute import LOWER

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(text.translate(LOWER))


def plain(items, docs, k):
    """(item_id, rank, doc_id, score) by scoring every document."""
    counted = [(i, collections.Counter(terms(t))) for i, t in docs if t is not None]
    counted = [(i, c) for i, c in counted if c]
    total = sum(c.total() for _, c in counted)
    df = collections.Counter(t for _, c in counted for t in c)
    asked = collections.defaultdict(collections.Counter)
    for i, t in set(items):
        if i is not None and t is not None:
            asked[i].update(terms(t))
    out = []
    for item, query in asked.items():
        scored = []
        for i, c in counted:
            m = 25 + 75 * c.total() * len(counted) // total
            score = sum(
                n * math.floor(1000 * math.log((2 * len(counted) + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m))
                for t, n in query.items() if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i))
        for rank, (score, _, i) in enumerate(sorted(scored, key=lambda s: (s[0], s[1], s[2] or 0))[:k], 1):
            out.append((item, rank, i, -score))
    return out


def found(spark, items, docs, k):
    items = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS term", "2 AS n")
    docs = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS block", "'x' AS rank", "2 AS `a``b`")
    return sorted(map(tuple, search(items, docs, k).collect()), key=repr)


def test_every_document_scored(spark, monkeypatch):
    rng = random.Random(1)
    vocabulary = [f"w{i}" for i in range(150)] + ["É", "ß", "straße", "Ünder", "X"]
    weights = [1 / (i + 1) for i in range(len(vocabulary))]

    def text(most):
        gaps = [" ", "-", "\n", "_", ", "]
        return "".join(w + rng.choice(gaps) for w in rng.choices(vocabulary, weights, k=rng.randrange(most)))

    docs = [(i, text(80)) for i in range(600)]
    docs += [(1000 + i, docs[i % 7][1]) for i in range(200)]
    # One item has more than 64 different terms, so that its masks take two numbers.
    items = [(i, text(30)) for i in range(12)] + [(50, " ".join(vocabulary)), (51, "w0 w0 w0 w1"), (51, "w2"), (52, "nowhere")]
    want = sorted(plain(items, docs, 10), key=repr)
    for size in (mask_search.DOCS, 64):
        monkeypatch.setattr(mask_search, "DOCS", size)
        monkeypatch.setattr(mask_search, "FIRST", 2)
        assert found(spark, items, docs, 10) == want
    monkeypatch.setattr(mask_search, "TERMS", 40)
    assert found(spark, items, docs, 10) == want


def test_groups_are_left_out_safely():
    import pickle

    import numpy as np

    rng = np.random.default_rng(2)
    n, v = 3000, 40
    key = np.unique(rng.integers(0, n * v, 20_000))
    doc, term = (key // v).astype(np.int32), (key % v).astype(np.int32)
    raw = pickle.dumps((np.arange(n), np.ones(n, bool), np.full(n, 30), doc, term, rng.integers(1, 5, len(key))))
    block = mask_search.Block(raw, rng.integers(1, 9000, v), n, 30 * n)
    item = mask_search.Item(1, np.arange(0, v, 2), np.ones(v // 2, np.int64))
    repeats = np.zeros(v, np.int64)
    repeats[item.terms] = 1
    every = block.scores(np.arange(n), repeats)
    best, score = block.best(item, repeats, 10, 0)
    assert sorted(score.tolist())[-10:] == sorted(every.tolist())[-10:]
    assert len(best) < n // 4
    floor = int(np.sort(every)[-5])
    best, score = block.best(item, repeats, 10, floor)
    assert sorted(best.tolist()) == np.flatnonzero(every >= floor).tolist()


def test_long_texts_are_cut_between_words(spark, monkeypatch):
    monkeypatch.setattr(mask_search, "CHUNK", 16)
    import numpy as np

    import pyarrow as pa

    texts = ["one two three four five six seven eight nine ten " * 9, "", "y" * 100 + " one", "éé " * 30]
    whole = collections.Counter()
    for hashes, text in mask_search._terms(pa.array(texts)):
        whole.update(zip(text.tolist(), hashes.tolist()))
    names = {w: h for w in {w for t in texts for w in t.split()} for h in np.concatenate([h for h, _ in mask_search._terms(pa.array([w]))])}
    assert whole == collections.Counter((n, int(names[w])) for n, t in enumerate(texts) for w in t.split())


@pytest.mark.parametrize(
    "items,docs",
    [
        ([(1, "a b"), (2, None), (None, "a"), (3, ""), (4, "...")], [(1, "a"), (2, None), (3, ""), (None, "A b"), (None, "b"), (4, "-")]),
        ([(1, "a b"), (1, "a b"), (2, "A")], [(7, "a b a")] * 3 + [(7, "b"), (5, "a b a"), (9, "x " * 70_000 + "a")]),
        ([], [(1, "a")]),
        ([(1, "a")], []),
    ],
)
def test_edges(spark, items, docs):
    assert found(spark, items, docs, 4) == sorted(plain(items, docs, 4), key=repr)

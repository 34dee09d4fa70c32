import collections
import math
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textlode.llm.decontamination import RADIUS, MultiIndex, find_leaks, simhash, without_leaks
from textlode.llm.queries import QUERIES

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return re.findall(r"[^\x00-/:-@\[-`{-\x7f]+", (text or "").translate(LOWER))


def shingles(words, k=5):
    if len(words) < k:
        return collections.Counter([tuple(words)] if words else [])
    return collections.Counter(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def brute(docs, items, k=5, least=0.8):
    """(doc_id, item_id, best similarity) over every window of every item's size."""
    items = [(i, split(t)) for i, t in items if split(t)]
    own = [shingles(w, k) for _, w in items]
    df = collections.Counter(s for c in own for s in c)
    unknown = math.log(1 + len(items))
    found = []
    for doc_id, text in docs:
        words = split(text)
        for (item_id, item), theirs in zip(items, own):
            size = min(len(item), len(words))
            n = min(k, len(item))
            if not {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} & theirs.keys():
                continue
            best = 0.0
            for start in range(len(words) - size + 1):
                window = shingles(words[start : start + size], k)
                weight = {s: math.log(1 + len(items) / df[s]) for s in theirs}
                common = sum(min(c, window[s]) * weight[s] for s, c in theirs.items())
                union = sum(max(c, window[s]) * weight[s] for s, c in theirs.items())
                union += sum(c * unknown for s, c in window.items() if s not in theirs)
                best = max(best, common / union)
            if best >= least - 1e-9:
                found.append((doc_id, item_id, round(best, 9)))
    return sorted(found, key=repr)


def got(leaks):
    return sorted(((r.doc_id, r.item_id, round(r.similarity, 9)) for r in leaks.collect()), key=repr)


def frames(spark, docs, items):
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()
    found = got(QUERIES["op3_decontaminate"](spark, sf_dir))
    assert found == brute([tuple(r) for r in docs], [tuple(r) for r in items]) and found


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("abcdefgh") * rng.randint(1, 5) + str(rng.randint(0, 60))
    items = [(i, " ".join(word() for _ in range(rng.randint(3, 60)))) for i in range(25)]
    docs = []
    for d in range(60):
        text = [word() for _ in range(rng.randint(0, 150))]
        passage = split(rng.choice(items)[1])
        for _ in range(rng.choice([0, 0, 1, 2])):
            at = rng.randrange(len(passage))
            passage[at : at + rng.randint(0, 1)] = [word()]
        at = rng.randint(0, len(text))
        docs.append((d, " ".join(text[:at] + passage * (d % 4 > 0) + text[at:])))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_changed_passages(spark, seed):
    docs, items = corpus(seed)
    want = brute(docs, items)
    found = got(find_leaks(*frames(spark, docs, items)))
    assert found == want and len(found) >= 20


def test_slices_change_nothing(spark):
    docs, items = corpus(3)
    frame = frames(spark, docs, items)
    assert got(find_leaks(*frame, slice_bytes=2000)) == got(find_leaks(*frame))


def test_edges(spark):
    item = "the quick brown fox jumps over the lazy dog and runs home"
    items = [(1, item), (1, item), (None, "some other words that are in the test set"), (3, None), (4, ""), (5, " ,;"), (6, "tiny")]
    docs = [
        (1, None),
        (2, ""),
        (3, "x, " * 30_000 + item.upper() + "! " + "y " * 30_000),
        (None, f"({item})"),
        (3, "Tiny."),
        (4, "clean text that holds nothing of it at all"),
        (5, "some other words that are in the test"),
    ]
    frame = frames(spark, docs, items)
    assert got(find_leaks(*frame)) == brute(docs, items)
    assert {(r.doc_id, r.item_id) for r in find_leaks(*frame).collect()} == {(3, 1), (None, 1), (3, 6), (5, None)}
    assert find_leaks(frame[0].limit(0), frame[1]).count() == 0 == find_leaks(frame[0], frame[1].limit(0)).count()
    kept = sorted(((r.doc_id, r.text) for r in without_leaks(*frame).collect()), key=repr)
    assert kept == sorted([docs[0], docs[1], docs[5]], key=repr)
    assert without_leaks(frame[0], frame[1].limit(0)).count() == len(docs)
    extra = spark.createDataFrame([(9, item, 3, "s")], "doc_id long, text string, copy int, similarity string")
    assert {r.doc_id for r in find_leaks(extra, frame[1]).collect()} == {9}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), min_size=1, max_size=30), st.integers(0, 30), st.data())
def test_the_index_finds_all_within_the_radius(values, radius, data):
    prints = np.array(values, np.uint64)
    query = data.draw(st.sampled_from(values))
    for bit in data.draw(st.lists(st.integers(0, 63), max_size=32)):
        query ^= 1 << bit
    want = {n for n, v in enumerate(values) if (v ^ query).bit_count() <= radius}
    assert MultiIndex(prints, radius).within(query) == want


def test_similar_windows_lie_within_the_radius():
    rng = np.random.default_rng(4)
    far = 0
    for _ in range(400):
        n = int(rng.integers(20, 60))
        a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
        b = a.copy()
        changed = rng.permutation(n)[: n // 9]
        b[changed] = rng.integers(0, 1 << 63, len(changed), dtype=np.uint64)
        far += (simhash(a) ^ simhash(b)).bit_count() > RADIUS
    assert far <= 2


def test_pairs_of_weighted_similarity_lie_within_the_radius():
    rng = np.random.default_rng(5)
    draw = lambda n: rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, n, dtype=np.uint64)
    far = [0, 0, 0]
    for _ in range(1000):
        # 30 rare shingles and those all of 40 items share; only the rare ones, or all but some rare or shared ones, are met.
        features, weights = draw(70), np.repeat([math.log(41), math.log(2)], [30, 40])
        for kind, kept in enumerate((np.arange(70) < 30 + rng.integers(0, 11), np.arange(70) >= 5, np.arange(70) % 6 > 0)):
            assert weights[kept].sum() / weights.sum() >= 0.8
            far[kind] += (simhash(features, weights) ^ simhash(features[kept], weights[kept])).bit_count() > RADIUS
    assert max(far) <= 4


def test_documents_without_the_shared_instruction(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    shared = " ".join(word() for _ in range(38))
    own = [" ".join(word() for _ in range(45)) for _ in range(60)]
    items = [(i, f"{shared} {t}") for i, t in enumerate(own)]
    want = brute(list(enumerate(own)), items)
    assert len(want) == 60 and got(find_leaks(*frames(spark, list(enumerate(own)), items))) == want

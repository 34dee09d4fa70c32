import random
import re

import numpy as np
import pytest
from brute import components as brute_components
from brute import shingle_set
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textlode.llm import partenum
from textlode.llm.components import components
from textlode.llm.partenum import Bands, jaccard_components, one_per_group, signatures
from textlode.llm.queries import QUERIES
from textlode.llm.shingles import shingle_sets, words

key = lambda r: tuple((x is None, x or 0) for x in r)


def check(spark, rows, k=4, num=85, den=100):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = jaccard_components(docs.repartition(5), k, num, den).collect()
    assert sorted(map(tuple, found), key=key) == sorted(brute_components(rows, k, num, den), key=key)
    return found


@pytest.mark.parametrize("num,den", [(85, 100), (4, 5)])
def test_similar_sets_share_a_signature(num, den):
    rng = np.random.default_rng(5)
    bands = Bands(num, den)
    for size in [*range(1, 60), 75, 100, 140, 300, 900, 2500]:
        for _ in range(12):
            a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64) * np.uint64(2))
            # as many changes as the similarity allows, in any mix of removed and added
            most = int((den - num) / num * len(a)) + 1
            removed, added = rng.integers(0, most + 1), rng.integers(0, most + 1)
            b = np.concatenate([rng.permutation(a)[removed:], rng.integers(0, 1 << 63, added, dtype=np.uint64) * np.uint64(2) + np.uint64(1)])
            b = np.unique(b)
            common = len(np.intersect1d(a, b))
            if len(b) and den * common >= num * (len(a) + len(b) - common):
                assert np.intersect1d(signatures(a, bands), signatures(b, bands)).size


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aAbB \t\né  \U0001F600", max_size=30), max_size=8), st.integers(1, 5))
def test_shingles_equal_plain_ones(texts, k):
    raw = [t.encode() for t in texts]
    buffer = np.frombuffer(b"".join(raw), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    found = list(shingle_sets(buffer, starts, k))
    want = [shingle_set(t, k) for t in texts]
    assert [len(f) for f in found] == [len(w) for w in want]
    names = {}
    for f, w in zip(found, want):
        assert names.setdefault(w, f.tobytes()) == f.tobytes()
    assert len(set(names.values())) == len(names)
    hashes, bounds = words(buffer, starts)
    assert len(hashes) == bounds[-1] == sum(len(re.findall(r"[^\x20\x09-\x0D]+", t)) for t in texts)


def variants(rng, bases, copies, edits, tail=()):
    rows = []
    for base in range(bases):
        words_ = [rng.choice("abcdefghij") * rng.randint(1, 6) + str(rng.randint(0, 99)) for _ in range(rng.randint(5, 130))]
        for _ in range(copies):
            own = list(words_)
            for _ in range(rng.randint(0, edits)):
                own[rng.randrange(len(own))] = f"new{rng.randint(0, 10**6)}"
            rows.append(" ".join(own + list(tail)))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_groups_of_near_copies(spark):
    rows = variants(random.Random(1), 12, 25, 4)
    found = check(spark, rows)
    assert len({r.component_id for r in found}) < len(rows) - 50


def test_a_common_passage_links_nothing_by_itself(spark):
    rng = random.Random(2)
    rows = variants(rng, 150, 1, 0, [f"common{i}" for i in range(60)])
    check(spark, rows, 5, 4, 5)


def test_hot_signatures_and_small_flushes(spark, monkeypatch):
    monkeypatch.setattr(partenum, "HOT", 3)
    monkeypatch.setattr(partenum, "FLUSH", 2000)
    monkeypatch.setattr(partenum, "BLOCK", 5)
    rows = variants(random.Random(3), 4, 80, 3)
    check(spark, rows)


def test_a_large_lookup_of_components_is_merged(spark, monkeypatch, plan):
    monkeypatch.setattr(partenum, "fits", lambda *_: False)
    rows = variants(random.Random(4), 4, 6, 2)
    check(spark, rows)
    text = plan(jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")))
    assert "_salt" in text and "Broadcast" not in text


def test_a_large_lookup_of_copies_is_merged(spark, monkeypatch, plan):
    rows = variants(random.Random(6), 4, 6, 2)
    docs = spark.createDataFrame([*rows, rows[0]], "doc_id long, text string")
    want = sorted(map(tuple, one_per_group(docs).collect()))
    monkeypatch.setattr(partenum, "fits", lambda *_: False)
    kept = one_per_group(docs)
    assert "_salt" in plan(kept) and "Broadcast" not in plan(kept)
    assert len(want) < len(rows) and sorted(map(tuple, kept.collect())) == want


def test_edges(spark):
    long = " ".join(f"w{i % 7001}" for i in range(60_000))
    texts = [None, "", " \n\t", "one", "ONE", "one two three", "One  two\nthree", "a b c d", "a b c d e", long, long + " end", long]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "one"), (3, "one"), (None, None), (None, "alone here"), (7, "other words than before")]
    check(spark, rows)
    extra = spark.createDataFrame([(1, "a b c d", 5, 6)], "doc_id long, text string, n long, node long")
    assert [tuple(r) for r in jaccard_components(extra).collect()] == [(1, 1, 1)]
    assert jaccard_components(extra.limit(0)).count() == 0


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op7_partenum"](spark, sf_dir).collect()
    assert sorted(map(tuple, found)) == sorted(brute_components([tuple(r) for r in docs], 4, 85, 100))


def test_components_of_chains_and_stars(spark):
    chain = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(400).select(F.lit(5000).alias("a"), (F.col("id") + 1000).alias("b"))
    loops = spark.createDataFrame([(9000, 9000), (9001, 9002), (9002, 9001)], "a long, b long")
    roots = {r.node: r.root for r in components(chain.unionAll(star).unionAll(loops)).collect()}
    assert {roots[i] for i in range(301)} == {0} and {roots[i] for i in [*range(1000, 1400), 5000]} == {1000}
    assert roots[9001] == roots[9002] == 9001 and 9000 not in roots


def test_bitmaps_never_differ_more_than_the_sets(spark):
    rng = np.random.default_rng(8)
    rows, want = [], []
    for size in (1, 5, 31, 32, 33, 64, 70, 200, 500):
        for _ in range(4):
            a = np.unique(rng.integers(0, 1 << 62, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[rng.random(len(a)) < 0.9], rng.integers(0, 1 << 62, size // 5, dtype=np.uint64)]))
            if len(b) and min(len(a), len(b)) >= 0.7 * max(len(a), len(b)):
                rows.append((len(rows), partenum.parities(a).tolist(), partenum.parities(b).tolist()))
                want.append(len(np.setxor1d(a, b)))
    frame = spark.createDataFrame(rows, "i long, x array<long>, y array<long>")
    found = {r.i: r.d for r in frame.select("i", partenum._differing(F.col("x"), F.col("y")).alias("d")).collect()}
    assert len(found) > 20 and all(found[i] <= w and found[i] % 2 == w % 2 for i, w in enumerate(want))
    assert all(found[i] >= 0.6 * w for i, w in enumerate(want))


def test_words_of_long_buffers_are_those_of_short_ones(monkeypatch):
    import random

    from textlode.llm import shingles

    rng = random.Random(8)
    texts = ["".join(rng.choice("abC \t\né.") for _ in range(rng.choice([0, 1, 5, 900]))) for _ in range(60)] + ["x" * 2_000, "", "q"]
    raw = [t.encode() for t in texts]
    buffer = np.frombuffer(b"".join(raw), np.uint8)
    starts = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    for between in (shingles.SPACE, shingles.MARKS):
        whole = shingles.words(buffer, starts, between)
        with monkeypatch.context() as patch:
            patch.setattr(shingles, "CHUNK", 40)
            cut = shingles.words(buffer, starts, between)
        assert all((a == b).all() for a, b in zip(whole, cut))
        assert whole[1][-1] == sum(len([w for w in "".join(c if not between[ord(c)] else " " for c in t.replace("é", "\xe9")).split(" ") if w]) for t in texts)

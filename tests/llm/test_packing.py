import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textlode.llm.packing import best_fit, fitted_counts, pack_documents, pack_plan, patterns_for, piece_lengths, places
from textlode.llm.queries import QUERIES

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def verify(rows, docs, tokenizer, width=1024):
    """Every token of every document once, in place; sequences without gaps."""
    want = []
    for doc_id, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        at = 0
        for piece, length in enumerate(piece_lengths(len(ids), width)):
            want.append((doc_id, piece, at, length, zlib.crc32(ids[at : at + length].tobytes())))
            at += length
        assert at == len(ids)
    key = lambda r: (r[0] is None, *[x or 0 for x in r])
    assert sorted((tuple(r[:5]) for r in rows), key=key) == sorted(want, key=key)
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= width
    return len(by), sum(r.length for r in rows)


def test_whole_table(spark, sf_dir, tokenizer):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    rows = QUERIES["op10_pattern_packing"](spark, sf_dir).collect()
    sequences, tokens = verify(rows, docs, tokenizer)
    assert sequences <= 1.02 * tokens / 1024 + 2


def test_edges(spark, tokenizer):
    texts = [None, "", "x", "<|endoftext|> a <|endoftext|>", " " * 5000 + "y", "a" * 30_000, "é😀\n" * 3000, "word " * 1023]
    rows = [(i, t, "k") for i, t in enumerate(texts)] + [(None, "null id", "k"), (2, "x", "k"), (2, "x", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    verify(pack_documents(docs, RANKS, PATTERN).collect(), [r[:2] for r in rows], tokenizer)
    assert pack_documents(docs.limit(0), RANKS, PATTERN).count() == 0


def test_many_copies(spark, tokenizer):
    rows = [(i, "same text again" if i % 3 else "other " * (i % 200)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    sequences, tokens = verify(pack_documents(docs, RANKS, PATTERN).collect(), rows, tokenizer)
    assert sequences <= tokens / 1024 + 2


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 63), st.integers(1, 5000), max_size=20))
def test_plan_places_every_piece_once(counts):
    width, histogram = 64, np.zeros(65, np.int64)
    for length, n in counts.items():
        histogram[length] = n
    groups = pack_plan(histogram, width)
    used = np.zeros(65, np.int64)
    for count, runs in groups:
        assert count > 0 and sum(n * k for n, k in runs) <= width
        for n, k in runs:
            used[n] += count * k
    assert (used == histogram).all()
    table = places(groups)
    assert table.shape[1] == sum(len(runs) for _, runs in groups)
    least = -(-int((histogram * np.arange(65)).sum()) // width)
    large = int(histogram[33:].sum())
    assert sum(count for count, _ in groups) <= 1.7 * max(least, large) + 3


def test_fit_finds_a_mix_of_patterns():
    counts = np.zeros(65)
    counts[[16, 48, 20, 44, 32]] = [500, 500, 300, 300, 800]
    patterns = patterns_for(counts.astype(int), 64)
    x = fitted_counts(counts, patterns)
    got = np.zeros(65)
    for p, n in zip(patterns, x, strict=True):
        for length in p[p > 0]:
            got[length] += n
    assert np.abs(got - counts).max() < 1


def test_best_fit_merges_equal_sequences():
    left = np.zeros(1025, np.int64)
    left[1], left[700] = 10**9, 10**8
    groups = best_fit(left, 1024)
    assert len(groups) < 10 and sum(n for n, _ in groups) == 10**8

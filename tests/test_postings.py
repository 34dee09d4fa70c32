"""The stored index against plain computations."""

import random

import pytest
from pyspark.sql import functions as F

from textlode.functions.cleaning import clear_text
from textlode.operators import bm25, postings
from textlode.session import fresh_dir
from textlode.sources.store import settle

WORDS = [f"w{chr(97 + i)}" for i in range(20)]


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(5)
    weights = [1 / (i + 1) for i in range(len(WORDS))]
    rows = [(i, ", ".join(rng.choices(WORDS, weights, k=rng.randrange(1, 40)))) for i in range(400)]
    # Few short documents with a rare word, a row twice, rows without words.
    rows += [(1000 + i, "Rare " * (i + 1)) for i in range(5)] + [rows[3]] + [(2000, None), (2001, "... 12"), (None, "Rare wa wb")]
    return rows


@pytest.fixture(scope="module")
def index(spark, corpus):
    kept = postings.BLOCK_BITS
    postings.BLOCK_BITS = 3
    try:
        docs = spark.createDataFrame(corpus, "doc_id long, text string").selectExpr("*", "1 AS block", "2 AS term", "3 AS no")
        return postings.write_index(docs, fresh_dir(spark, "index"))
    finally:
        postings.BLOCK_BITS = kept


def terms_of(spark, *queries):
    rows = [(n, w) for n, q in enumerate(queries) for w in q.split()]
    return bm25.query_terms(spark.createDataFrame(rows, "query_id int, term string"))


def test_scores_equal_those_of_all_documents(spark, corpus, index):
    terms = settle(terms_of(spark, "rare", "wa wb wa", "ws wt nowhere", "nowhere", "rare wa wq", " ".join(WORDS)))
    docs = spark.createDataFrame([r for i, r in enumerate(corpus) if r not in corpus[:i]], "doc_id long, text string")
    rows = bm25.term_rows(docs.select("doc_id", clear_text(F.col("text")).alias("clean")))
    found = postings.search_index(terms, index, 7)
    assert found.filter("query_id = 3").count() == 0
    twice = corpus[3][0]
    assert index.n_docs == len(corpus) and abs(index.avgdl - sum(len((t or "").replace("12", "").replace(".", "").split()) for _, t in corpus) / len(corpus)) < 1e-9
    # The plain computation groups rows of one id, so it sees the repeated row once, and its statistics differ by it.
    weighted = postings.weights(terms, index)
    every = weighted.select("query_id").distinct().join(index.postings.select("block").distinct())
    plain = postings._scored(every, weighted, index, 6)
    best = postings.top_per_group(plain, ["query_id"], [F.desc("score"), F.asc("doc_id")], 7)
    key = lambda r: (r.query_id, r.rank, str(r.doc_id), r.score)
    assert sorted(map(key, found.collect())) == sorted(map(key, best.collect()))
    assert plain.filter(F.col("doc_id") == twice).groupBy("query_id").count().filter("count = 2").count() > 0
    alone = bm25.bm25_scores(terms, rows).filter("query_id = 0").select("doc_id").collect()
    assert {r.doc_id for r in alone} == {r.doc_id for r in plain.filter("query_id = 0").collect()}


def test_blocks_below_the_list_are_left_out(spark, index, monkeypatch):
    met = []
    plain = postings._scored
    monkeypatch.setattr(postings, "_scored", lambda pairs, *rest: met.append(pairs.count()) or plain(pairs, *rest))
    terms = settle(terms_of(spark, "rare wa"))
    postings.search_index(terms, index, 3).collect()
    bounds = postings.block_bounds(postings.weights(terms, index), index)
    assert sum(met) < bounds.count() / 4


def test_a_search_scans_the_folders_of_its_terms(spark, index, plan):
    asked = terms_of(spark, "rare wb").select("term")
    part = postings.of_terms(index.postings, asked)
    folders = {f.split("bucket=")[1].split("/")[0] for f in part.inputFiles()}
    every = {f.split("bucket=")[1].split("/")[0] for f in index.postings.inputFiles()}
    text = plan(part.select("term", "block"))
    assert len(every) > 2 and "PartitionFilters: [isnotnull(bucket" in text or "PartitionFilters: [bucket" in text
    assert "PushedFilters: [In(term" in text and "codes" not in text.split("ReadSchema")[1]
    assert {r.term for r in part.select("term").distinct().collect()} == {"rare", "wb"}
    assert folders <= every


def places(corpus, phrase):
    """Word by word, as the cleaning sees these texts."""
    out = []
    want = phrase.split(" ")
    for i, text in corpus:
        low = (text or "").lower()
        words, at = [], 0
        for part in low.replace(",", " ").replace(".", " ").replace("1", " ").replace("2", " ").split():
            at = low.index(part, at)
            words.append((part, at, at + len(part)))
            at += len(part)
        for k in range(len(words) - len(want) + 1):
            if [w for w, _, _ in words[k : k + len(want)]] == want:
                out.append((phrase, i, words[k][1], words[k + len(want) - 1][2]))
    return out


def test_phrases_of_any_length(spark, corpus, index):
    rng = random.Random(6)
    asked = ["rare", "rare rare", "rare rare rare rare", "wa wa", "wa wb wa", "nowhere wa", "wt", "rare wa wb", "wb rare"]
    for _, text in rng.sample(corpus[:400], 12):
        words = text.split(", ")
        n = rng.randrange(1, 9)
        asked.append(" ".join(words[:n]))
        asked.append(" ".join(words[-n:]))
    frame = spark.createDataFrame([(p,) for p in [*asked, "", asked[0]]], "phrase string")
    found = postings.find_phrases(frame, index).drop("block")
    want = [p for phrase in dict.fromkeys(asked) for p in places(corpus, phrase)]
    assert sorted(map(tuple, found.collect()), key=str) == sorted(want, key=str)
    some = settle(index.postings.select("block").distinct().limit(3).withColumn("phrase", F.lit("wa wa")))
    limited = postings.find_phrases(frame, index, some)
    assert {r.phrase for r in limited.collect()} <= {"wa wa"}
    assert limited.join(some, "block", "left_anti").count() == 0


def test_empty_index(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    empty = postings.write_index(docs, fresh_dir(spark, "index"))
    assert postings.search_index(terms_of(spark, "rare"), empty, 3).count() == 0
    assert postings.find_phrases(spark.createDataFrame([("a b",)], "phrase string"), empty).count() == 0


def test_searches_beyond_the_broadcast_limit_send_no_copies(spark, index, monkeypatch, plan):
    import functools

    from textlode.operators import joins

    terms = settle(terms_of(spark, "rare wa", "wa wb wa", "ws wt", " ".join(WORDS)))
    phrases = settle(spark.createDataFrame([("wa wb",), ("wb wa wa",), ("rare rare",)], "phrase string"))
    key = lambda rows: sorted(map(str, rows))
    best, places = key(postings.search_index(terms, index, 3).collect()), key(postings.find_phrases(phrases, index).collect())
    monkeypatch.setattr(postings, "lookup_join", functools.partial(joins.lookup_join, max_rows=0))
    found, spots = postings.search_index(terms, index, 3), postings.find_phrases(phrases, index)
    assert not any("Broadcast" in line and "_salt" in line for line in (plan(found) + plan(spots)).splitlines())
    assert key(found.collect()) == best and key(spots.collect()) == places

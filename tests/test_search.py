import math
import random
import re
from collections import Counter
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from textlode.functions.cleaning import clean_social
from textlode.operators import bm25, joins, lexicon, ranking
from textlode.plans.queries import QUERIES
from textlode.plans import fixtures as X
from textlode.plans import search
from textlode.sources.store import settle


def okapi(corpus, query):
    """BM25 of every document, straight from the formula."""
    n = len(corpus)
    average = sum(map(len, corpus)) / n
    df = Counter(t for doc in corpus for t in set(doc))
    idf = {t: math.log(n - c + 0.5) - math.log(c + 0.5) for t, c in df.items()}
    floor = 0.25 * sum(idf.values()) / len(idf)
    idf = {t: floor if v < 0 else v for t, v in idf.items()}
    scores = []
    for doc in corpus:
        tf = Counter(doc)
        scores.append(
            sum(
                idf.get(t, 0) * tf[t] * 2.5 / (tf[t] + 1.5 * (0.25 + 0.75 * len(doc) / average))
                for t in query
            )
        )
    return scores


def test_bm25_counts_empty_documents_and_repeated_query_words(spark):
    pick = random.Random(2)
    corpus = [pick.choices("abcdefg", k=pick.randint(0, 9)) for _ in range(30)] + [[]]
    queries = ["a b a", "g", "z", "c z c"]
    docs = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(corpus)], "doc_id long, clean string")
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id long, text string")
    terms = bm25.query_terms(search.words_as_terms(asked))
    found = {(r.query_id, r.doc_id): r.score for r in bm25.bm25_scores(terms, bm25.term_rows(docs)).collect()}
    for q, query in enumerate(queries):
        for d, score in enumerate(okapi(corpus, query.split())):
            matches = set(query.split()) & set(corpus[d])
            assert ((q, d) in found) == bool(matches)
            if matches:
                assert found[q, d] == pytest.approx(score, abs=2e-6)


def test_bm25_is_the_same_with_the_salted_joins(spark, monkeypatch, sf_dir):
    docs = X.turns(spark, sf_dir).select("doc_id", F.lower("text").alias("clean"))
    terms = bm25.query_terms(search.words_as_terms(X.benchmark_queries(spark, sf_dir)))
    broadcast = sorted(bm25.bm25_scores(terms, bm25.term_rows(docs)).collect())
    monkeypatch.setattr(bm25, "BROADCAST_ROWS", 10)
    salted = sorted(bm25.bm25_scores(terms, bm25.term_rows(docs)).collect())
    assert [r[:3] for r in salted] == [r[:3] for r in broadcast]
    assert [r[3] for r in salted] == pytest.approx([r[3] for r in broadcast], abs=2e-6)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_lookup_equals_the_plain_join(spark, how):
    big = spark.range(300).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 40).cast("string")).alias("k"))
    small = spark.createDataFrame([("hot", 1), ("7", 2), ("11", 3), ("99", 4)], "k string, v int")
    plain = sorted(map(str, big.join(small, ["k"], how).collect()))
    salted = joins.lookup_join(big, small, ["k"], how, max_rows=2, salts=4)
    assert sorted(map(str, salted.collect())) == plain


def test_lookup_of_checked_size_is_broadcast(spark, plan):
    big = spark.range(100).withColumn("k", F.col("id") % 5)
    small = spark.range(5).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in plan(joins.lookup_join(big, small, ["k"]))


def test_copies_of_a_large_lookup_are_not_broadcast(spark, plan):
    big = spark.range(100).withColumn("k", F.col("id") % 5)
    small = settle(spark.range(5).withColumnRenamed("id", "k"))
    assert "Broadcast" not in plan(joins.lookup_join(big, small, ["k"], max_rows=2))


def test_scores_are_added_up_without_moving_pairs_of_query_and_document(spark, plan):
    docs = spark.createDataFrame([(1, "a b"), (2, "b c"), (None, "a"), (2, "b d")], "doc_id long, clean string")
    terms = bm25.query_terms(spark.createDataFrame([(1, "b"), (1, "a"), (2, "b")], "query_id int, term string"))
    scores = bm25.bm25_scores(terms, settle(bm25.term_rows(docs)))
    assert not re.search(r"hashpartitioning\(query_id#\d+L?, doc_id", plan(scores))
    assert sorted((r.query_id, r.doc_id or 0) for r in scores.collect()) == [(1, 0), (1, 1), (1, 2), (2, 1), (2, 2)]


def corpus_of_fragments(spark):
    pick = random.Random(9)
    words = ["alpha", "beta", "gamma", "delta", "eps", "a", "ab"]
    texts = [" ".join(pick.choices(words, k=pick.randint(1, 30))) for _ in range(60)] + ["hot words here"] * 40
    fragments = sorted({" ".join(pick.choices(words, k=pick.randint(1, 4))) for _ in range(50)} | {"words here", "x"})
    rows = [(None, texts[0]), (None, "x"), (500, None), *enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    expected = {f: min((i for i, t in enumerate(texts) if f in t), default=None) for f in fragments}
    return docs, spark.createDataFrame([(f,) for f in [*fragments, None, "", fragments[0]]], "fragment string"), expected


@pytest.mark.parametrize("few", [True, False])
def test_containing_doc_is_the_first_by_brute_force(spark, monkeypatch, few):
    docs, fragments, expected = corpus_of_fragments(spark)
    if not few:
        monkeypatch.setattr(ranking, "PATTERN_ROWS", 20)
    found = {r.fragment: r.doc_id for r in ranking.containing_doc(fragments, docs).collect()}
    assert found == {f: d for f, d in expected.items() if d is not None}


def test_fragments_of_plain_and_odd_posts(spark):
    """only posts with links or odd characters are cleaned sentence by sentence a second time."""
    from textlode.functions.cleaning import clean_social
    from textlode.functions.tokens import sentences

    texts = ["one two three. four five six! no", "a ht@xtp://b c d e. www@yww.u f g h", "\u0130a b c d. e f g h", "short", "", "x y z. x y z. . ! a b c"]
    posts = spark.createDataFrame([(t,) for t in texts], "t string").select(clean_social(F.col("t")).alias("text"))
    long = F.filter(F.transform(sentences(F.col("text")), clean_social), lambda f: F.size(F.filter(F.split(f, " "), lambda w: w != "")) >= 3)
    told = posts.filter("length(text) > 10").select(F.explode(long).alias("fragment")).distinct()
    made = search.fragments_of(posts)
    assert sorted(made.collect()) == sorted(told.collect()) and made.count() == 8
    # The posts are asked for links and odd characters.
    assert "contains(" in made._jdf.queryExecution().analyzed().toString().lower()


def test_fragment_search_by_brute_force(spark):
    texts = ["The cat sat here. A dog ran off there!", "Other cat sat here. The cat sat here.",
             "Nothing in common at all? The dog ran far away today."]
    queries = ["the cat sat", "dog ran off", "!!!"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    asked = spark.createDataFrame(list(enumerate(queries)), "query_id long, text string")
    hits = search.fragment_search(asked, docs, top_k=2, min_score=0.3, dim=512).collect()
    best = {r.query_id: r for r in hits if r["rank"] == 1}
    assert set(best) == {0, 1}
    assert best[0].fragment == "the cat sat here." and best[1].fragment == "a dog ran off there!"
    # Three of the fragment's four words: cosine 3 / sqrt(3 * 4).
    ratio = SequenceMatcher(None, "the cat sat", "the cat sat here.").ratio()
    assert best[0].similarity == pytest.approx(0.6 * 3 / math.sqrt(12) + 0.4 * ratio, abs=1e-5)
    assert best[0].full_text.startswith("the cat sat here. a dog")
    assert best[0].context == "the cat sat here. a dog ran off there!"


def test_string_ratio_is_the_library_one(spark):
    pairs = [("abc", "abd"), ("", ""), ("x" * 300, "x" * 250 + "y")]
    frame = spark.createDataFrame(pairs, "a string, b string")
    found = [r.r for r in frame.select(ranking.string_ratio("a", "b").alias("r")).collect()]
    assert found == [SequenceMatcher(None, a, b).ratio() for a, b in pairs]


def test_capped_synonyms(spark):
    listed = {}
    for r in lexicon.capped_synonyms(spark.sql(X.SYNONYMS)).orderBy("word", "rank").collect():
        listed.setdefault(r.word, []).append(r.sense)
    # 'That' stands in two synsets and counts once; the word itself never does.
    assert listed["the"] == ["That", "this", "these"]
    assert listed["of"] == ["from", "for", "by"]


def test_blank_query_has_no_hits(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, clean string")
    asked = spark.createDataFrame([(1, " !! "), (2, None), (3, "b")], "query_id long, text string")
    assert [r.query_id for r in search.bm25_search(asked, docs, 3).collect()] == [3]


def test_first_and_short_documents_win_ties(spark):
    docs = spark.createDataFrame([(9, "a b"), (3, "a b"), (5, "c d"), (6, "e f"), (7, "g")], "doc_id long, clean string")
    asked = spark.createDataFrame([(1, "a")], "query_id long, text string")
    assert [r.doc_id for r in search.bm25_search(asked, docs, 5).orderBy("rank").collect()] == [3, 9]


def test_social_fragments_are_distinct_and_long_enough(spark):
    docs = spark.createDataFrame(
        [(1, "One two three. Short one. One two three."), (2, "tiny"), (3, "One two three. #x")], "doc_id long, text string"
    )
    assert [r.fragment for r in search.social_fragments(docs).collect()] == ["one two three."]
    assert docs.select(clean_social(F.col("text"))).count() == 3


def test_ratio_bound_and_the_candidates_it_leaves_out(spark, monkeypatch):
    import difflib
    import random

    from textlode.operators import ranking as R

    rng = random.Random(7)
    texts = ["", "a", "abc" * 90, "é😀 b", "tide", "diet"] + ["".join(rng.choices("abcd é", k=rng.randrange(1, 60))) for _ in range(60)]
    pairs = [(n, q, i, rng.choice(texts), texts[-q - 1], rng.random()) for n in range(1) for q in range(4) for i in range(60)]
    frame = spark.createDataFrame([p[1:] for p in pairs], "query_id int, n int, fragment string, asked string, score double")
    plain = {}
    for row in frame.select("*", R.ratio_bound(F.col("asked"), F.col("fragment")).alias("most")).collect():
        ratio = difflib.SequenceMatcher(None, row.asked, row.fragment).ratio()
        assert row.most >= ratio - 1e-12
        plain.setdefault(row.query_id, []).append((-round(0.6 * row.score + 0.4 * ratio, 6), row.n))
    none = spark.createDataFrame([(None, "a"), (None, None)], "x string, y string")
    assert [r[0] for r in none.select(R.ratio_bound(F.col("x"), F.col("y"))).collect()] == [0.0, 1.0]
    found = R.most_relevant(frame, 5, "n").collect()
    want = [(q, n, r + 1) for q, hits in plain.items() for r, (_, n) in enumerate(sorted(hits)[:5])]
    assert sorted((r.query_id, r.n, r["rank"]) for r in found) == sorted(want)


def test_relevance_ratio_by_brute_force(spark, sf_dir):
    import difflib

    import numpy as np

    from textlode.functions.cleaning import clear_text as clean
    from textlode.functions.vectors import hash_embedding, l2_normalize
    from textlode.plans import fixtures as X

    def rows(df, key):
        vec = l2_normalize(hash_embedding(F.col("c"))).cast("array<float>")
        return [(r[0], r.c, r.v) for r in df.select(key, clean(F.col("text")).alias("c")).select(key, "c", vec.alias("v")).collect()]

    docs = [r for r in rows(X.turns(spark, sf_dir), "doc_id") if r[2] is not None]
    matrix = np.array([r[2] for r in docs])
    want = []
    for q, text, vec in rows(X.benchmark_queries(spark, sf_dir), "query_id"):
        scores = np.round(matrix @ np.array(vec), 6) + 0.0
        near = sorted(range(len(docs)), key=lambda i: (-scores[i], docs[i][0]))[:50]
        hits = sorted((-round(0.6 * scores[i] + 0.4 * difflib.SequenceMatcher(None, text, docs[i][1]).ratio(), 6), docs[i][0]) for i in near)[:5]
        want += [(q, r + 1, d) for r, (_, d) in enumerate(hits)]
    found = QUERIES["relevance_ratio"](spark, sf_dir).collect()
    assert sorted((r.query_id, r["rank"], r.doc_id) for r in found) == sorted(want)


def test_ranked_documents_move_as_words_and_not_as_pairs(spark, sf_dir, plan):
    ranked = plan(QUERIES["dedup_ranked"](spark, sf_dir))
    assert "REPARTITION_BY_NUM" in ranked and not re.search(r"hashpartitioning\(query_id#\d+L?, doc_id", ranked)

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlode.functions import vectors as V
from textlode.operators import vectors as E


def frame(spark, matrix, key):
    rows = [(i, [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame(rows, f"{key} long, embedding array<float>")


def brute_force(queries, vectors, k, metric):
    q, v = queries.astype(np.float32).astype(float), vectors.astype(np.float32).astype(float)
    found = []
    for i, row in enumerate(q):
        score = v @ row if metric == "ip" else ((v - row) ** 2).sum(1)
        score = np.round(score, 6)
        order = sorted(range(len(v)), key=lambda j: (-score[j] if metric == "ip" else score[j], j))
        found += [(i, j, rank + 1) for rank, j in enumerate(order[:k])]
    return found


@pytest.mark.parametrize("metric", ["ip", "l2"])
@pytest.mark.parametrize("blocks", [False, True])
def test_top_k_is_exact_with_a_third_of_equal_vectors(spark, monkeypatch, metric, blocks):
    random = np.random.default_rng(3)
    vectors = random.integers(-3, 4, (900, 6)).astype(float)
    vectors[::3] = vectors[0]
    queries = random.integers(-3, 4, (40, 6)).astype(float)
    if blocks:
        monkeypatch.setattr(E, "QUERY_ROWS", 16)
        monkeypatch.setattr(E, "BLOCK_VECTORS", 60)
        monkeypatch.setattr(E, "CELL_VECTORS", 100)
    monkeypatch.setattr(E, "SCORE_VALUES", 2_000)
    hits = E.top_k_vectors(
        frame(spark, queries, "query_id"), frame(spark, vectors, "doc_id").repartition(5), 7, metric
    )
    found = sorted((r.query_id, r.doc_id, r["rank"]) for r in hits.collect())
    assert found == sorted(brute_force(queries, vectors, 7, metric))


@pytest.mark.parametrize("metric", ["ip", "l2"])
def test_cells_that_cannot_reach_a_list_are_not_met(spark, metric, monkeypatch):
    random = np.random.default_rng(6)
    centres = 10 * random.normal(size=(12, 5))
    vectors = np.round(np.repeat(centres, 70, axis=0) + random.normal(size=(840, 5)), 3)
    queries = np.round(np.repeat(centres, 4, axis=0) + random.normal(size=(48, 5)), 3)
    monkeypatch.setattr(E, "CELL_VECTORS", 40)
    # A cell that stays empty has nothing to tell.
    divide = E.divide

    def with_empty_cell(*of):
        blocks, cells = divide(*of)
        return blocks, E.Cells(np.concatenate([cells.centre, cells.centre[:1]]), *(np.append(x, y) for x, y in ((cells.radius, 50.0), (cells.size, 0), (cells.pieces, 2))))

    monkeypatch.setattr(E, "divide", with_empty_cell)
    hits = E.top_k_pruned(frame(spark, queries, "query_id"), frame(spark, vectors, "doc_id").repartition(3), 5, metric)
    monkeypatch.undo()
    monkeypatch.setattr(E, "CELL_VECTORS", 40)
    found = sorted((r.query_id, r.doc_id, r["rank"]) for r in hits.collect())
    assert found == sorted(brute_force(queries, vectors, 5, metric))
    # The pairs of queries and cells that meet, as the tasks choose them.
    blocks, cells = E.divide(frame(spark, vectors, "doc_id"), 5)
    bound = cells.bounds(queries, metric)
    scores = queries @ vectors.T if metric == "ip" else -((queries[:, None, :] - vectors[None, :, :]) ** 2).sum(2)
    fifth = np.sort(scores, axis=1)[:, -5]
    assert (bound.max(1) >= scores.max(1) - 1e-9).all()
    assert (bound >= fifth[:, None]).mean() < 0.5
    assert blocks.count() == int((cells.size > 0).sum()) > 10


def test_pruned_search_of_odd_rows(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0]), ("c", None), ("d", [2.0, 1.0])], "name string, embedding array<float>")
    queries = spark.createDataFrame([("q", [1.0, 1.0]), ("r", None)], "query_id string, embedding array<float>")
    hits = E.top_k_pruned(queries, vectors, 5, key="name").orderBy("rank").collect()
    assert [(r.query_id, r.name, r.score) for r in hits] == [("q", "d", 3.0), ("q", "a", 1.0)]
    assert E.top_k_pruned(queries, vectors.limit(0), 5, key="name").count() == 0
    assert E.top_k_pruned(queries.limit(0), vectors, 5, key="name").count() == 0


def test_smaller_k_is_a_prefix(spark):
    random = np.random.default_rng(4)
    queries, vectors = frame(spark, random.random((5, 4)), "query_id"), frame(spark, random.random((50, 4)), "doc_id")
    three = E.top_k_vectors(queries, vectors, 3)
    four = E.top_k_vectors(queries, vectors, 4).filter("rank <= 3")
    assert sorted(three.collect()) == sorted(four.collect())


def test_top_k_with_text_keys_and_other_widths(spark):
    vectors = spark.createDataFrame(
        [("b", [1.0, 0.0]), ("a", [1.0, 0.0]), ("c", [1.0]), ("d", None)], "name string, embedding array<float>"
    )
    queries = spark.createDataFrame([(1, [1.0, 1.0])], "query_id long, embedding array<float>")
    hits = E.top_k_vectors(queries, vectors, 5, key="name").orderBy("rank").collect()
    assert [(r.name, r.score) for r in hits] == [("a", 1.0), ("b", 1.0)]


def test_no_queries_give_no_hits(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0])], "doc_id long, embedding array<float>")
    none = spark.createDataFrame([], "query_id long, embedding array<float>")
    assert E.top_k_vectors(none, vectors, 3).count() == 0


def test_queries_of_two_widths_are_an_error(spark):
    vectors = spark.createDataFrame([(1, [1.0, 0.0])], "doc_id long, embedding array<float>")
    mixed = spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "query_id long, embedding array<float>")
    with pytest.raises(ValueError, match="width"):
        E.top_k_vectors(mixed, vectors, 3)


@pytest.mark.parametrize("scale", [1.0, 1e-20, 1e-3, 1e16])
@pytest.mark.parametrize("metric", ["l2", "ip"])
def test_pairs_ruled_out_in_single_precision_lose_nothing(metric, scale):
    """with a known score to reach, only pairs that single precision cannot rule out are computed exactly."""
    draw = np.random.default_rng(1)
    vectors = np.round(draw.normal(size=(3000, 16)), 2) * scale
    vectors[:500] = vectors[500:1000]
    queries = np.vstack([vectors[:200], draw.normal(size=(100, 16)) * scale])
    ids = draw.permutation(3000)
    told = E._batch_best(None, queries, ids, vectors, 5, metric, 6)
    least = np.array([told[2][told[0] == i].min() for i in range(len(queries))])
    if scale in (1.0, 1e-3):
        assert len(E._reaching(queries, least, vectors, metric, 6)[0]) < len(queries) * len(vectors) * (0.02 if scale == 1 else 2)
    least[::3] = np.nan
    found = E._block_best(queries, least, ids, vectors, 5, metric, 6)
    assert sorted(zip(*[x.tolist() for x in found])) == sorted(zip(*[x.tolist() for x in told]))
    # A score that no vector reaches gives no row.
    if scale == 1:
        none = E._block_best(queries, np.full(len(queries), 1e6), ids, vectors, 5, metric, 6)
        assert len(none[0]) == 0


def test_hashed_words_of_a_batch(spark, plan):
    """each different word of a batch is hashed once, and the vectors are those of each text by itself."""
    from hashlib import md5

    texts = ["a b a", "", None, "b", " a", "x  y", "ü ж 😀", "c " * 50]
    frame = spark.createDataFrame([(t,) for t in texts * 400], "t string").coalesce(1).select("t", V.hash_embedding(F.col("t"), 8).alias("v"))
    assert "ArrowEvalPython" in plan(frame)
    for row in frame.distinct().collect():
        told = [0.0] * 8
        for word in (row.t or "").split(" "):
            told[int(md5(word.encode()).hexdigest()[:8], 16) % 8] += 1
        assert row.v == (told if row.t else None)


def test_hash_embedding_counts_words_per_bucket(spark):
    texts = ["a b a c", "", "solo", "x y z " * 40 + "end"]
    data = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    found = {r.id: r.v for r in data.select("id", V.hash_embedding(F.trim("t"), 16).alias("v")).collect()}
    for i, text in enumerate(texts):
        expected = [0.0] * 16
        for word in text.split():
            expected[int(hashlib.md5(word.encode()).hexdigest()[:8], 16) % 16] += 1
        assert found[i] == (expected if text else None)


def test_plugged_encoder_keeps_rows_aligned(spark):
    def encode(texts):
        return np.array([[len(t), 1.0] for t in texts])

    data = spark.createDataFrame([(0, "abc"), (1, " "), (2, None), (3, " xy ")], "id int, t string")
    found = {r.id: r.embedding for r in E.embed_with(data, "t", encode).collect()}
    assert found == {0: [3.0, 1.0], 1: None, 2: None, 3: [2.0, 1.0]}


def test_mean_pool_without_unmasked_vectors_is_zero(spark):
    data = spark.createDataFrame(
        [("a", [1.0, 2.0], 1), ("a", [3.0, 4.0], 1), ("a", [9.0, 9.0], 0), ("b", [5.0, 5.0], 0)],
        "k string, v array<float>, m int",
    )
    found = {r.k: r.embedding for r in E.mean_pool(data, "k", "v", F.col("m")).collect()}
    assert found == {"a": [2.0, 3.0], "b": [0.0, 0.0]}


def test_zero_vectors(spark):
    data = spark.createDataFrame([([0.0, 0.0], [3.0, 4.0])], "z array<float>, v array<float>")
    row = data.select(
        V.l2_normalize(F.col("z")).alias("z"),
        V.l2_normalize(F.col("v")).alias("v"),
        V.cosine(F.col("z"), F.col("v")).alias("c"),
    ).head()
    assert (row.z, row.v, row.c) == ([0.0, 0.0], [0.6, 0.8], 0.0)


def test_tfidf_keeps_rows_and_weighs_rare_words(spark):
    import math

    from textlode.functions.vectors import term_bucket

    docs = spark.createDataFrame([(1, "a b b"), (1, "a"), (2, ""), (None, "a c"), (3, None)], "doc_id long, clean string").selectExpr("*", "1 AS uid")
    found = [(r.doc_id, r.embedding) for r in E.embed_tfidf(docs, 8).collect()]
    assert sorted((d, v is None) for d, v in found if d) == [(1, False), (1, False), (2, True), (3, True)]
    at = {w: spark.range(1).select(term_bucket(F.lit(w), 8)).head()[0] for w in "abc"}
    idf = {w: math.log(6 / (1 + n)) + 1 for w, n in (("a", 3), ("b", 1), ("c", 1))}

    def plain(text):
        out = [0.0] * 8
        for w in text.split():
            out[at[w]] += idf[w]
        return out

    vectors = [v for d, v in found if v and d is None] + sorted((v for d, v in found if v and d == 1), key=sum)
    for v, text in zip(vectors, ["a c", "a", "a b b"]):
        assert np.allclose(v, plain(text))


def test_tfidf_moves_rare_words_only(spark, plan):
    rows = spark.createDataFrame([(i, t, 1) for i in range(30) for t in ("hot", f"w{i % 7}", f"v{i}")], "uid long, term string, tf int")
    idf = rows.groupBy("term").agg(F.count("*").alias("df")).withColumn("idf", F.col("df") * 0.5)
    plain = sorted(map(tuple, rows.join(idf.drop("df"), "term").collect()))
    assert sorted(map(tuple, E._with_idf(rows, idf).collect())) == plain
    for most in (1, 9, 30):
        # Terms of more than 90, 10 and 3 rows are broadcast.
        found = E._with_idf(rows, idf, most)
        assert sorted(map(tuple, found.collect())) == plain
        assert "SortMergeJoin" in plan(found)

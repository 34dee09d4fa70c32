import math
from fractions import Fraction

import numpy as np
import pytest

from textlode.llm.queries import QUERIES
from textlode.llm.vp_tree import Tree, build_trees, nearest, valid_vectors


def product(a, b):
    total = sum(Fraction(x) * Fraction(y) for x, y in zip(a, b))
    try:
        # Products are rounded, as long as they are finite.
        plain = math.fsum(x * y for x, y in zip(a, b))
        return plain if math.isfinite(plain) else float(total)
    except (OverflowError, ValueError):
        return math.inf if total > 2**1023 else -math.inf if total < -(2**1023) else float(total)


def brute(rows, chosen, k):
    """(query_id, rank, vec_id, score) by comparing all."""
    ok = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for q in dict.fromkeys(i for i, _ in ok if chosen(i)):
        best = {}
        for own in (v for i, v in ok if i == q):
            for i, v in ok:
                if i != q and len(v) == len(own):
                    best[i] = max(best.get(i, -math.inf), product(own, v))
        hits = sorted((-s, i) for i, s in best.items())[:k]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(hits)]
    return out


def single(x):
    return [None if y is None else float(np.float32(y)) for y in x]


def test_whole_table(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    found = QUERIES["op5_vp_tree"](spark, sf_dir).collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows, lambda i: i % 20 == 0, 20))


def search(spark, rows, k, shard=40, block=3, factor=1.0):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    vectors = valid_vectors(frame)
    return nearest(vectors.filter("vec_id % 5 = 0"), build_trees(vectors, k, shard), k, factor, block)


def test_ties_copies_and_lengths(spark):
    rng = np.random.default_rng(1)
    rows = [(i, single(rng.integers(-1, 2, 6) * rng.choice([0.5, 1, 3]))) for i in range(250)]
    rows += [(300 + i, [1.0, 1.0, 0.0, 0.0, 0.0, 2.0]) for i in range(120)]
    found = search(spark, rows, 7).collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows, lambda i: i % 5 == 0, 7))


def test_repeated_rows_and_ids_hide_no_neighbour(spark):
    rng = np.random.default_rng(3)
    rows = [(i, single(rng.normal(size=6))) for i in range(300)] * 2
    # Ids with many vectors, among the best of all queries; and ids met many times with one vector.
    rows += [(1000 + i % 3, single(4 + rng.normal(size=6))) for i in range(120)]
    rows += [(2000, [5.0] * 6)] * 30 + [(2000 + i, [5.0] * 6) for i in range(12)]
    for shard in (4_096, 40):
        found = search(spark, rows, 20, shard).collect()
        assert sorted(map(tuple, found)) == sorted(brute(rows, lambda i: i % 5 == 0, 20))


def test_ties_beyond_the_first_search(spark):
    # Many different vectors with the same product; the smaller ids count.
    rows = [(5, [1.0, 0.0, 0.0])] + [(1000 - i, [1.0, float(i), float(i * i % 7)]) for i in range(400)]
    found = search(spark, rows, 5, 4_096).filter("query_id = 5").collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows, lambda i: i == 5, 5))


def test_edges(spark):
    rows = [
        (0, [1.0, 0.0]), (5, [0.0, 0.0]), (10, [1.0, None]), (15, [float("nan"), 1.0]), (20, [float("inf"), 1.0]),
        (25, None), (30, []), (35, [1.0, 2.0, 3.0]), (40, [3.0, 2.0, 1.0]), (None, [9.0, 9.0]), (1, [2.0, 1.0]),
        (0, [0.5, 0.5]), (1, [1.0, 7.0]), (45, [4.0]),
    ]
    found = search(spark, rows, 3).collect()
    assert sorted(map(tuple, found)) == sorted(brute(rows, lambda i: i % 5 == 0, 3))
    assert {r.query_id for r in found} == {0, 35, 40}
    assert search(spark, [(5, [0.0])], 3).count() == 0
    extra = spark.createDataFrame([(0, [1.0], 1, 2), (1, [2.0], 1, 2)], "vec_id long, embedding array<float>, width int, rank int")
    vectors = valid_vectors(extra)
    assert [tuple(r) for r in nearest(vectors.filter("vec_id = 0"), build_trees(vectors, 2), 2).collect()] == [(0, 1, 1, 2.0)]


def search_wide(spark, rows, k, shard=4_096):
    vectors = valid_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    return sorted(map(tuple, nearest(vectors.filter("vec_id % 5 = 0"), build_trees(vectors, k, shard), k).collect()))


def test_no_huge_or_tiny_vector_hides_a_neighbour(spark):
    rng = np.random.default_rng(4)
    plain = [(i, rng.normal(size=5).tolist()) for i in range(300)]
    for scale in (1e160, 1e300, 1e-200, 1e-310):
        rows = plain + [(1000, (rng.normal(size=5) * scale).tolist()), (1005, (rng.normal(size=5) * scale).tolist())]
        assert search_wide(spark, rows, 6) == sorted(brute(rows, lambda i: i % 5 == 0, 6)), scale


def test_all_magnitudes_at_once(spark):
    rng = np.random.default_rng(5)
    scales = [1e-320, 1e-250, 1e-160, 1e-20, 1.0, 1e20, 1e155, 1e200, 1e308]
    rows = [(i, (rng.uniform(-1, 1, size=4) * scales[i % 9]).tolist()) for i in range(270)]
    # Components of unlike size in one vector.
    rows += [(300, [1e160, 1e-200, 0.0, 0.0]), (305, [0.0, 1e200, 0.0, 0.0]), (306, [0.0, 2e-200, 0.0, 1e-9]), (307, [1.0, 2.0]), (310, [1e300, 1.0])]
    want = sorted(brute(rows, lambda i: i % 5 == 0, 4))
    assert search_wide(spark, rows, 4, 20) == want
    assert any(math.isinf(s) for *_, s in want)


@pytest.mark.parametrize("factor,least", [(1.0, 1.0), (1.5, 0.9)])
def test_recall(factor, least):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 16))
    points = centres[rng.integers(0, 30, 3000)] + 0.2 * rng.normal(size=(3000, 16))
    queries = points[::50]
    tree = Tree(points)
    _, found = tree.search(queries, 20, factor)
    want = np.argsort(-(queries @ points.T), axis=1, kind="stable")[:, :20]
    recall = np.mean([len(set(a) & set(b)) / 20 for a, b in zip(found.tolist(), want.tolist())])
    assert recall >= least

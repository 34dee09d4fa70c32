import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textlode.llm import hard_negatives
from textlode.llm.hard_negatives import Centres, Members, Points, mine, whole_vectors


def brute(rows, chosen, positives=5, negatives=3):
    """All rows against every anchor, by exact whole numbers."""
    ok = {
        (i, label, tuple(max(-(2**63) + 1, min(2**63 - 1, math.floor(256 * x))) for x in v))
        for i, label, v in rows
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    out = []
    for i, label, v in ok:
        if not chosen(i):
            continue
        scored = []
        for j, other, w in ok:
            if j != i and len(w) == len(v):
                s = max(-(2**63) + 1, min(2**63 - 1, sum(a * b for a, b in zip(v, w))))
                scored.append((-s, j, other))
        scored.sort()
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            hard = [(n, j) for n, j, other in scored if other != label and -50 * s <= -100 * n <= -95 * s][:negatives]
            out += [(i, p, r, j, -s, -n) for r, (n, j) in enumerate(hard, 1)]
    return sorted(out)


def mined(spark, rows, chosen=5, **limits):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", "1 AS width", "2 AS ids", "3 AS cluster")
    ready = whole_vectors(frame)
    return sorted(map(tuple, mine(ready, ready.filter(F.col("vec_id") % chosen == 0), **limits).collect()))


def told(rows):
    return [(i, label, v) for i, v, label in rows]


@pytest.fixture
def small(monkeypatch):
    for name, size in (("BLOCK", 16), ("SHARD", 60), ("STEP", 8), ("SAMPLE", 100), ("PER_CLUSTER", 10)):
        monkeypatch.setattr(hard_negatives, name, size)


def test_clusters_shards_and_copies(spark, small):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 8))
    rows = []
    for i in range(500):
        c = int(rng.integers(6))
        rows.append((i, (centres[c] + 0.4 * rng.normal(size=8)).tolist(), c if i % 7 else (c + 1) % 6))
    rows += [(1000 + i, rows[3][1], rows[3][2]) for i in range(60)] + [(2000 + i, rows[3][1], 9) for i in range(60)]
    rows += [(3000 + i, [0.0] * 8, i % 2) for i in range(12)]
    assert mined(spark, rows) == brute(told(rows), lambda i: i % 5 == 0)


def test_a_list_is_left_early():
    rng = np.random.default_rng(2)
    matrix = rng.normal(size=(4000, 6))
    matrix = (1000 * np.concatenate([matrix, matrix[:1] + 0.05 * rng.normal(size=(200, 6))])).astype(np.int64)
    label = (np.arange(len(matrix)) % 2).astype(np.int64)
    centres = Centres({6: matrix[:1]}, 1)
    cluster, angle = centres.nearest(matrix[4000:4020])
    centres.reach = {(6, 0): float(angle.max())}
    bound = centres.bounds(matrix, 0)
    order = np.argsort(-bound, kind="stable")
    points = Points(label, matrix, np.arange(len(matrix) + 1), np.arange(len(matrix))).turned(order)
    asks = np.full((20, 1), hard_negatives.NONE + 1), np.full((20, 1), 2**63 - 1)
    block = Members(np.arange(20), np.arange(4000, 4020), label[4000:4020], matrix[4000:4020], *asks)
    seen = []
    product = hard_negatives._products
    try:
        hard_negatives._products = lambda a, b: seen.append(len(b)) or product(a, b)
        ask, ids, score = block.walk(points, bound[order], 5, True)
    finally:
        hard_negatives._products = product
    assert sum(seen) < len(matrix) / 2
    exact = matrix[4000:4020] @ matrix.T
    assert (bound[None, :] * np.sqrt((matrix[4000:4020].astype(float) ** 2).sum(1))[:, None] >= exact).all()
    for n in range(20):
        want = sorted((-int(s), j) for j, s in enumerate(exact[n]) if label[j] == label[4000 + n] and j != 4000 + n)[:5]
        assert [(-int(s), int(j)) for a, j, s in zip(ask, ids, score) if a == n] == want


def test_edges(spark, small):
    rows = [
        (0, [1.0, 0.0], 1), (1, [0.9, 0.1], 1), (2, [0.6, 0.3], 2), (3, [0.7, 0.0], None), (4, None, 1), (5, [1.0, None], 1),
        (10, [float("nan"), 1.0], 1), (15, [float("inf"), 1.0], 2), (None, [1.0, 1.0], 2), (20, [], 1), (21, [], 1), (22, [], 2),
        (25, [1.0, 2.0, 3.0], 1), (26, [1.0, 2.0, 3.5], 1), (27, [1.0, 1.5, 2.5], 0), (30, [0.0, 0.0], 1), (0, [1.0, 0.0], 1),
        (0, [0.5, 0.5], 2), (2, [0.8, 0.2], 2), (2, [0.8, 0.2], 2), (35, [-1.0, -1.0], 1), (40, [0.001, -0.004], 2),
        (45, [1e300, 3.0], 1), (46, [1e300, -1e300], 1), (47, [7e15, 1.0], 3), (50, [3e9, 1.0], 1), (51, [3.1e9, 2.0], 1), (52, [2.2e9, 0.5], 2),
    ]
    assert mined(spark, rows) == brute(told(rows), lambda i: i % 5 == 0)
    assert mined(spark, []) == []
    assert mined(spark, [(5, [1.0], 1)]) == []
    assert mined(spark, rows, positives=1, negatives=1, low=0, high=100) is not None

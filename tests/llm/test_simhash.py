import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from textlode.llm.common import spread_join
from textlode.llm.queries import QUERIES
from textlode.llm.simhash import covering_masks, fingerprint, near_duplicates, near_links
from textlode.sources.store import settle
from tests.llm.brute import LOWER


def plain_fingerprint(text, k=3):
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in (text or "").translate(LOWER)).split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(rows):
    """(doc_id, fingerprint, component_id) by comparing all fingerprints."""
    fps = [plain_fingerprint(t) for _, t in rows]
    distinct = sorted(set(fps))
    array = np.array(distinct, np.uint64)
    parent = list(range(len(distinct)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(distinct)):
        for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= 3).tolist():
            parent[find(i)] = find(i + 1 + j)
    place = {f: n for n, f in enumerate(distinct)}
    least = {}
    for (i, _), f in zip(rows, fps):
        if i is not None:
            root = find(place[f])
            least[root] = min(least.get(root, i), i)
    return [(i, f"{f:016x}", least.get(find(place[f]))) for (i, _), f in zip(rows, fps)]


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


def test_whole_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    found = QUERIES["op13_covering_simhash"](spark, sf_dir).collect()
    assert ordered(found) == ordered(plain(rows))
    assert len({r.component_id for r in found}) < len(rows)


def test_fingerprint_in_pieces(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("aB é\t\n\v.ß ") for _ in range(rng.randrange(120))) for _ in range(150)]
    texts += ["", " \n", "One", "one  TWO", "x" * 500, "a\x1cb c\x85d e\xa0f g"]
    for size in (1 << 20, 7):
        monkeypatch.setattr("textlode.llm.simhash.PIECE", 64 * size)
        for text in texts:
            assert int.from_bytes(fingerprint(text.encode())) == plain_fingerprint(text), text


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_some_mask_covers_every_pair(radius):
    masks = covering_masks(radius)
    assert len(masks) == 2 ** (radius + 1) - 1
    for places in itertools.combinations(range(64), radius):
        differ = sum(1 << p for p in places)
        assert any(not m & differ for m in masks)
    inner = covering_masks(radius, masks[0])
    free = [b for b in range(64) if not masks[0] >> b & 1]
    for places in itertools.combinations(free, radius):
        differ = sum(1 << p for p in places)
        assert any(not m & differ for m in inner)
    assert all(m & masks[0] == masks[0] for m in inner)


def test_large_buckets_are_dealt_out_again(spark):
    rng = random.Random(2)
    fps = {rng.getrandbits(64) for _ in range(300)}
    for base in list(fps)[:3]:
        fps |= {base ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(5))) & (1 << 64) - 1 for _ in range(300)}
        fps |= {base ^ rng.getrandbits(12) for _ in range(300)}
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")

    def classes(pairs):
        parent = {f: f for f in fps}

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in pairs:
            parent[max(find(a), find(b))] = min(find(a), find(b))
        return [find(f) for f in fps]

    array = np.array(fps).view(np.uint64)
    want = [(fps[i], fps[i + 1 + j]) for i in range(len(fps)) for j in np.flatnonzero(np.bitwise_count(array[i + 1 :] ^ array[i]) <= 3)]
    for bucket in (20, 1_024):
        found = [tuple(r) for r in near_links(frame, 3, bucket).collect()]
        assert classes(found) == classes(want), bucket


def test_edges(spark):
    rows = [
        (1, None), (2, ""), (3, " \t"), (4, "One two"), (4, "one  TWO"), (5, "a b c d"), (None, "a b c d"), (None, "only here now"),
        (6, "x" * 200_000), (7, " ".join(map(str, range(60_000)))), (8, "one\x1ctwo"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 fp", "2 a", "3 root", "4 _salt", "5 fixed")
    assert ordered(near_duplicates(frame).collect()) == ordered(plain(rows))
    assert near_duplicates(frame.limit(0)).collect() == []


def test_copies_of_a_lookup_that_does_not_fit_are_never_broadcast(spark, plan):
    rows = spark.range(400).select(F.col("id").alias("doc_id"), (F.col("id") % 3).alias("fp"))
    named = settle(spark.createDataFrame([(0, 7), (1, 8)], "fp long, component_id long"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        joined = spread_join(rows, named, "fp", how, False)
        # Spark takes the copies for as few bytes as the stored table.
        assert "Broadcast" not in plan(joined) and "SortMergeJoin" in plan(joined)
        assert ordered(joined.collect()) == ordered(spread_join(rows, named, "fp", how, True).collect())

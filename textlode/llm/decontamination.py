"""Benchmark decontamination by SimHash windows.

Windows as long as a benchmark item slide over the words of a document where
the two share a shingle.  A window's SimHash is looked up among the items'
through the blocks of a multi-index: with radius + 1 blocks, any fingerprint
within the radius equals it in one of them.  What is found is verified by an
exact weighted similarity of shingles.  Words are runs of letters, digits and
characters beyond ASCII.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlode.llm.common import small_batches
from textlode.llm.shingles import MARKS, pieces, shingles, words
from textlode.llm.trigrams import text_buffer
from textlode.operators.joins import numbered
from textlode.sources.store import settle

WORDS, SIMILARITY = 5, 0.8
# Bits in which a window's fingerprint may differ from an item's.
RADIUS = 20
# Bytes of item texts that are sent to all tasks at once; a larger benchmark is compared slice by slice.
SLICE = 8 << 20


class Items(NamedTuple):
    """A slice of the benchmark: per item its id, length in words, shingles and their weights, and fingerprint."""

    ids: list[int]
    lengths: list[int]
    features: list[np.ndarray]
    weights: list[np.ndarray]
    prints: np.ndarray
    unknown: float  # weight of a shingle that an item lacks


def simhash(features: np.ndarray, weights: np.ndarray | None = None) -> int:
    """64 bits: the sign of the sum over the shingles of ± the root of their weight, bit by bit.

    Bits differ by the angle of the two sums, in which squares count: with
    roots that is the share of weight in common, as in the similarity.
    """
    bits = np.unpackbits(features.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1)
    # Whole numbers, so that the order of the shingles changes nothing.
    roots = np.ones(len(features), np.int64) if weights is None else np.rint(np.sqrt(weights) * (1 << 20)).astype(np.int64)
    return int.from_bytes(np.packbits(2 * (roots @ bits) > roots.sum()).tobytes(), "big")


class MultiIndex:
    """Fingerprints by the value of each of radius + 1 blocks of bits."""

    def __init__(self, prints: np.ndarray, radius: int):
        self.prints, self.radius = prints, radius
        cuts = [64 * i // (radius + 1) for i in range(radius + 2)]
        self.blocks = [(low, (1 << high - low) - 1) for low, high in zip(cuts, cuts[1:])]
        self.tables: list[dict[int, list[int]]] = []
        for low, mask in self.blocks:
            table: dict[int, list[int]] = {}
            for number, value in enumerate(prints.tolist()):
                table.setdefault(value >> low & mask, []).append(number)
            self.tables.append(table)

    def within(self, value: int) -> set[int]:
        """Numbers of all fingerprints that differ in at most `radius` bits."""
        found = set()
        for (low, mask), table in zip(self.blocks, self.tables):
            found.update(table.get(value >> low & mask, ()))
        return {n for n in found if (int(self.prints[n]) ^ value).bit_count() <= self.radius}


def similarity(window: np.ndarray, item: np.ndarray, weights: np.ndarray, unknown: float) -> float:
    """Weighted Jaccard similarity of two multisets of shingles.

    A shingle of the item weighs by its rarity in the benchmark; one that only the window has weighs `unknown`.
    """
    names, own = np.unique(window, return_counts=True)
    theirs, first, count = np.unique(item, return_index=True, return_counts=True)
    at = np.searchsorted(names, theirs)
    at[at == len(names)] = 0
    met = np.where(names[at] == theirs, own[at], 0) if len(names) else np.zeros(len(theirs))
    w = weights[first]
    common = (np.minimum(met, count) * w).sum()
    union = (np.maximum(met, count) * w).sum() + (own.sum() - met.sum()) * unknown
    return float(common / union) if union > 0 else 0.0


def _features(hashes: np.ndarray, k: int) -> np.ndarray:
    return shingles(hashes, np.array([0, len(hashes)]), k)[0]


def benchmark_items(benchmark: DataFrame, k: int = WORDS, slice_bytes: int = SLICE) -> list[DataFrame]:
    """The benchmark in slices of bounded size: `(item_id, length, features, weights, unknown)`.

    Null, empty and blank texts are no items.  Repeated ids are items of their own under that id.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buffer, starts = text_buffer(batch.column(2))
            rows = []
            for i in range(batch.num_rows):
                hashes, _ = words(buffer[starts[i] : starts[i + 1]], np.array([0, starts[i + 1] - starts[i]]), MARKS)
                rows.append((len(hashes), _features(hashes, k).view(np.int64).tolist()))
            columns = [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["item", "item_id", "length", "features"])

    texts = benchmark.filter(F.col("text").isNotNull()).select(
        F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long").alias("item_id"), "text"
    )
    rows = texts.mapInArrow(run, "item long, item_id long, length long, features array<long>")
    rows = settle(rows.filter("length > 0"))
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.size("features")), F.lit(0)).alias("b")).first()
    slices = max(1, math.ceil(size.b * 16 / slice_bytes))
    unknown = math.log(1 + size.n)
    places = rows.select("item", F.posexplode("features").alias("place", "feature"))
    spread = places.select("item", "feature").distinct().groupBy("feature").agg(F.count("*").alias("df"))
    weighted = (
        places.join(spread, "feature")
        .groupBy("item")
        .agg(F.sort_array(F.collect_list(F.struct("place", "df"))).alias("d"))
        .select("item", F.transform("d", lambda d: F.log(1 + F.lit(size.n) / d["df"])).alias("weights"))
    )
    whole = rows.join(weighted, "item").withColumn("unknown", F.lit(unknown))
    whole = settle(whole.withColumn("slice", F.pmod(F.xxhash64("item"), F.lit(slices))))
    return [whole.filter(F.col("slice") == s) for s in range(slices)]


def _collected(part: DataFrame) -> Items | None:
    """One slice, whose size is bounded, on the driver."""
    rows = part.orderBy("item").collect()
    if not rows:
        return None
    features = [np.array(r.features, np.int64).view(np.uint64) for r in rows]
    weights = [np.array(r.weights, float) for r in rows]
    return Items(
        [r.item_id for r in rows],
        [r.length for r in rows],
        features,
        weights,
        np.array([simhash(f, w) for f, w in zip(features, weights)], np.uint64),
        rows[0].unknown,
    )


class Anchors:
    """Where a document shares shingles with items, and the windows that follow from it."""

    def __init__(self, items: Items, k: int):
        self.items, self.k = items, k
        # One index for each number of words a shingle has: k, or all words of a shorter item.
        self.by_words: dict[int, tuple] = {}
        lists: dict[int, list] = {}
        for number, (length, features) in enumerate(zip(items.lengths, items.features)):
            own = lists.setdefault(min(k, length), [])
            own += [(int(f), number, place) for place, f in enumerate(features.tolist())]
        for n, own in lists.items():
            own.sort()
            name = np.array([o[0] for o in own], np.uint64)
            bitmap = np.zeros(1 << 20, bool)
            bitmap[(name & np.uint64((1 << 20) - 1)).astype(np.int64)] = True
            rest = np.array([o[1:] for o in own], np.int64)
            self.by_words[n] = (bitmap, name, rest[:, 0], rest[:, 1])
        self.known, first = np.unique(np.concatenate(items.features), return_index=True)
        self.weights = np.concatenate(items.weights)[first]

    def weigh(self, window: np.ndarray) -> np.ndarray:
        """Weights of a window's shingles: as in the items, `unknown` for those that none has."""
        at = np.searchsorted(self.known, window)
        at[at == len(self.known)] = 0
        return np.where(self.known[at] == window, self.weights[at], self.items.unknown)

    def hits(self, found: np.ndarray, n: int) -> np.ndarray:
        """Places of the shingles that some item has."""
        bitmap, name, _, _ = self.by_words[n]
        at = np.flatnonzero(bitmap[(found & np.uint64((1 << 20) - 1)).astype(np.int64)])
        spot = np.searchsorted(name, found[at])
        spot[spot == len(name)] = 0
        return at[name[spot] == found[at]]

    def windows(self, found: np.ndarray, places: np.ndarray, n: int, count: int) -> set[tuple[int, int]]:
        """(start, words) of the windows in which a shared shingle lies where an item has it.

        Between two such starts of an item that are close, every start counts:
        the best window of a passage with words put in may lie there.
        """
        _, name, number, offset = self.by_words[n]
        low, high = np.searchsorted(name, found[places]), np.searchsorted(name, found[places], side="right")
        starts: dict[int, set[int]] = {}
        for place, a, b in zip(places.tolist(), low.tolist(), high.tolist()):
            for i in range(a, b):
                item = int(number[i])
                length = min(self.items.lengths[item], count)
                starts.setdefault(item, set()).add(min(max(0, place - int(offset[i])), count - length))
        out = set()
        for item, own in starts.items():
            length = min(self.items.lengths[item], count)
            ordered = sorted(own)
            out.update((s, length) for s in ordered)
            for s, t in zip(ordered, ordered[1:]):
                if t - s <= length // 4:
                    out.update((x, length) for x in range(s + 1, t))
        return out


def document_leaks(
    hashes: np.ndarray, places: dict[int, np.ndarray], found: dict[int, np.ndarray], anchors: Anchors, index: MultiIndex, least: float
) -> list[tuple[int, int, int, float]]:
    """(item number, start, words, similarity) of the best window of each item in one document."""
    items, k = anchors.items, anchors.k
    best: dict[int, tuple[float, int, int]] = {}
    for n, own in places.items():
        for start, length in sorted(anchors.windows(found[n], own, n, len(hashes))):
            window = _features(hashes[start : start + length], k)
            for item in index.within(simhash(window, anchors.weigh(window))):
                # Windows are the item's size, or the whole of a shorter document.
                if length != min(items.lengths[item], len(hashes)):
                    continue
                value = similarity(window, items.features[item], items.weights[item], items.unknown)
                # The sums are rounded.
                if value >= least - 1e-9 and value > best.get(item, (0.0,))[0]:
                    best[item] = (value, start, length)
    return [(item, start, length, value) for item, (value, start, length) in sorted(best.items())]


def batch_leaks(texts, anchors: Anchors, index: MultiIndex, least: float) -> list[tuple[int, int, int, int, float]]:
    """(row, item number, start, words, similarity) for an Arrow column of texts without nulls."""
    buffer, starts = text_buffer(texts)
    rows = []
    for low, high in pieces(starts):
        part = starts[low : high + 1]
        hashes, bounds = words(buffer[part[0] : part[-1]], part - part[0], MARKS)
        found, first, hits = {}, {}, {}
        for n in anchors.by_words:
            found[n], first[n] = shingles(hashes, bounds, n)
            hits[n] = anchors.hits(found[n], n)
        holders = np.unique(np.concatenate([np.searchsorted(first[n], hits[n], side="right") - 1 for n in hits]))
        for i in holders.tolist():
            own = {n: found[n][first[n][i] : first[n][i + 1]] for n in found}
            at = {n: hits[n][slice(*np.searchsorted(hits[n], first[n][i : i + 2]))] - first[n][i] for n in hits}
            leaks = document_leaks(hashes[bounds[i] : bounds[i + 1]], at, own, anchors, index, least)
            rows += [(low + i, *leak) for leak in leaks]
    return rows


def _slices(benchmark: DataFrame, k: int, slice_bytes: int) -> Iterator[Items]:
    small_batches(benchmark.sparkSession)
    for part in benchmark_items(benchmark, k, slice_bytes):
        if (items := _collected(part)) is not None:
            yield items


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    k: int = WORDS,
    least: float = SIMILARITY,
    radius: int = RADIUS,
    slice_bytes: int = SLICE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`(doc_id, item_id, start_word, n_words, similarity)`: the best window per document row and item.

    Only pairs with a similarity of `least` or more are returned.  Null and
    empty texts hold nothing; null and repeated ids are kept; an empty
    benchmark gives no rows.
    """
    import pyarrow as pa

    schema = "doc_id long, item_id long, start_word long, n_words long, similarity double"
    names = ["doc_id", "item_id", "start_word", "n_words", "similarity"]
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def scan(items: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors, index = Anchors(items, k), MultiIndex(items.prints, radius)
            for batch in batches:
                rows = batch_leaks(batch.column(1), anchors, index, least)
                if rows:
                    at, item, start, length, value = zip(*rows)
                    numbers = [pa.array(c, pa.int64()) for c in ([items.ids[i] for i in item], start, length)]
                    columns = [batch.column(0).take(pa.array(at)), *numbers, pa.array(value, pa.float64())]
                    yield pa.RecordBatch.from_arrays(columns, names)

        return run

    out = docs.sparkSession.createDataFrame([], schema)
    for items in _slices(benchmark, k, slice_bytes):
        out = out.unionByName(source.mapInArrow(scan(items), schema))
    return out


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    k: int = WORDS,
    least: float = SIMILARITY,
    radius: int = RADIUS,
    slice_bytes: int = SLICE,
    text_col: str = "text",
) -> DataFrame:
    """The rows of `docs` in which `find_leaks` finds no item; all columns stay."""
    import pyarrow as pa

    at = docs.columns.index(text_col)

    def scan(items: Items):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            anchors, index = Anchors(items, k), MultiIndex(items.prints, radius)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[row for row, *_ in batch_leaks(batch.column(at).fill_null(""), anchors, index, least)]] = False
                yield batch.filter(pa.array(clean))

        return run

    plain = numbered(docs)
    for items in _slices(benchmark, k, slice_bytes):
        plain = plain.mapInArrow(scan(items), plain.schema)
    return plain.toDF(*docs.columns)

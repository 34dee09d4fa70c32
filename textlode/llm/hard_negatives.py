"""Hard negatives by lists that clusters of anchors share.

Anchors are clustered by direction.  For a cluster whose members lie within an angle of its centre, a
candidate's inner product with any member is at most its length times the cosine of its own angle to the
centre less that angle (times the member's length).  Each shard of candidates is sorted by that bound once
for a cluster; every member walks the list until the bound falls below what it still needs.  Shards whose
first bound is too low for a block of members do not meet it.  Results are exact.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlode.operators.joins import lookup_join, top_per_group
from textlode.sources.store import settle

# Rows of the samples that centres and first bounds come from; they decide the work, never the result.
SAMPLE = 4_096
CLUSTERS, PER_CLUSTER = 64, 256
# Members of a block, candidates of a shard, and candidates of a list that are walked at a time.
BLOCK, SHARD, STEP = 512, 4_096, 512
# Share of the lengths that covers the rounding of angles and cosines.
SLACK = 1e-7
NONE = np.iinfo(np.int64).min


def whole_vectors(vectors: DataFrame, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding", label: Column | str = "label") -> DataFrame:
    """`(vec_id, label, vec)` with components floor(scale * x) as 64-bit numbers, from the rows that take part.

    Rows with a null id, label or vector, or with a null or non-finite component take no part.  Equal rows count once.
    """
    rows = vectors.select(
        F.col(id_col).cast("long").alias("vec_id"), (F.col(label) if isinstance(label, str) else label).alias("label"), F.col(vec_col).cast("array<double>").alias("vec")
    )
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    # Beyond 64 bits the nearest such number.
    number = lambda x: F.greatest(F.least(F.floor(x * float(scale)), F.lit(2**63 - 1)), F.lit(-(2**63) + 1)).cast("long")
    return kept.select("vec_id", "label", F.transform("vec", number).alias("vec")).distinct()


def _matrix(column, width: int) -> np.ndarray:
    import pyarrow as pa

    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return lists.flatten().to_numpy().reshape(len(lists), width)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows; beyond 64 bits the nearest such number."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    exact = a.astype(object) @ b.astype(object).T
    return np.clip(exact, NONE + 1, (1 << 63) - 1).astype(np.int64)


def _units(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    plain = matrix.astype(np.float64)
    norm = np.sqrt((plain * plain).sum(1))
    return plain / np.where(norm > 0, norm, 1)[:, None], norm


class Centres:
    """Centres of the anchors of each width, and the largest angle of a member to its centre."""

    def __init__(self, samples: dict[int, np.ndarray], clusters: int):
        self.of: dict[int, np.ndarray] = {}
        self.reach: dict[tuple[int, int], float] = {}
        for width, matrix in samples.items():
            unit, _ = _units(matrix)
            n = max(1, min(len(unit), clusters * len(unit) // max(1, sum(map(len, samples.values())))))
            centres = unit[np.linspace(0, len(unit) - 1, n).astype(int)]
            for _ in range(8):
                nearest = (unit @ centres.T).argmax(1)
                sums = np.zeros_like(centres)
                np.add.at(sums, nearest, unit)
                norm = np.sqrt((sums * sums).sum(1))
                centres = np.where(norm[:, None] > 0, sums / np.where(norm > 0, norm, 1)[:, None], centres)
            self.of[width] = centres

    def count(self, width: int) -> int:
        return len(self.of.get(width, [None]))

    def nearest(self, matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cluster and angle of every row; a width without centres is one cluster all around."""
        centres = self.of.get(matrix.shape[1])
        if centres is None:
            return np.zeros(len(matrix), np.int32), np.full(len(matrix), math.pi)
        cosines = np.clip(_units(matrix)[0] @ centres.T, -1, 1)
        own = cosines.argmax(1)
        return own.astype(np.int32), np.arccos(cosines[np.arange(len(own)), own])

    def bounds(self, matrix: np.ndarray, cluster: int) -> np.ndarray:
        """What no inner product with a member of length one exceeds."""
        unit, norm = _units(matrix)
        wide = self.reach.get((matrix.shape[1], cluster), math.pi)
        if matrix.shape[1] not in self.of:
            return norm * (1 + SLACK)
        angle = np.arccos(np.clip(unit @ self.of[matrix.shape[1]][cluster], -1, 1))
        return norm * (np.cos(np.maximum(0, angle - wide)) + SLACK)


class Points(NamedTuple):
    """Candidates: a label, a vector and the smallest ids of each; ids of point i are ids[first[i]:first[i + 1]]."""

    label: np.ndarray
    matrix: np.ndarray
    first: np.ndarray
    ids: np.ndarray

    def turned(self, order: np.ndarray) -> Points:
        size = np.diff(self.first)[order]
        first = np.concatenate([[0], np.cumsum(size)])
        at = np.repeat(self.first[order] - first[:-1], size) + np.arange(first[-1])
        return Points(self.label[order], self.matrix[order], first, self.ids[at])


def _points(table, width: int) -> Points:
    ids = table.column("ids").combine_chunks()
    size = ids.value_lengths().to_numpy()
    return Points(table.column("label").to_numpy(), _matrix(table.column("vec"), width), np.concatenate([[0], np.cumsum(size)]), ids.flatten().to_numpy())


class Members(NamedTuple):
    """Anchors of a block and, per anchor, what it asks for: scores from low to high, and the k-th best found so far."""

    anchor: np.ndarray
    ids: np.ndarray
    label: np.ndarray
    matrix: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def walk(self, points: Points, bound: np.ndarray, k: int, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ask (anchor * asks + number), id and score of the k best candidates of every ask on the list, and below none that is missed.

        `bound` descends along the list.  An anchor leaves it once the bound, for its length, is below all it still needs.
        """
        length = np.sqrt((self.matrix.astype(np.float64) ** 2).sum(1))
        asks = self.low.shape[1]
        need = self.low.copy()
        found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
        for low in range(0, len(bound), STEP):
            open_ = np.flatnonzero((bound[low] * length >= need.min(1)) & (self.low <= self.high).any(1))
            if not len(open_):
                break
            here = slice(low, low + STEP)
            score = _products(self.matrix[open_], points.matrix[here])
            fitting = (self.label[open_][:, None] == points.label[here][None, :]) == same
            new = [found]
            for ask in range(asks):
                hit = fitting & (score >= need[open_, ask][:, None]) & (score <= self.high[open_, ask][:, None])
                row, col = np.nonzero(hit)
                size = np.diff(points.first)[low + col]
                at = np.repeat(points.first[low + col] - np.cumsum(size) + size, size) + np.arange(size.sum())
                who, ids = np.repeat(open_[row], size), points.ids[at]
                other = ids != self.ids[who]
                new.append((who[other] * asks + ask, ids[other], np.repeat(score[row, col], size)[other]))
            if sum(len(x[0]) for x in new[1:]):
                ask_, ids, score = (np.concatenate(part) for part in zip(*new))
                order = np.lexsort((ids, -score, ask_))
                ask_, ids, score = ask_[order], ids[order], score[order]
                place = np.arange(len(ask_)) - np.searchsorted(ask_, ask_)
                kept = place < k
                found = (ask_[kept], ids[kept], score[kept])
                last = place == k - 1
                need.reshape(-1)[ask_[last]] = np.maximum(need.reshape(-1)[ask_[last]], score[last])
        return found


def _first_needs(members: Members, sample: Points | None, k: int, same: bool) -> Members:
    """Members whose lows are raised to the k-th best score that a sample already gives."""
    if sample is None or not len(sample.label):
        return members
    score = _products(members.matrix, sample.matrix)
    one = np.diff(sample.first) == 1
    own = one[None, :] & (sample.ids[sample.first[:-1]][None, :] == members.ids[:, None])
    fitting = ((members.label[:, None] == sample.label[None, :]) == same) & ~own
    low = members.low.copy()
    for ask in range(low.shape[1]):
        fit = fitting & (score >= low[:, [ask]]) & (score <= members.high[:, [ask]])
        if fit.shape[1] >= k:
            best = np.partition(np.where(fit, score, NONE), fit.shape[1] - k, axis=1)[:, fit.shape[1] - k]
            low[:, ask] = np.maximum(low[:, ask], best)
    return members._replace(low=low)


def _walked(members: DataFrame, shards: DataFrame, centres: Centres, samples: dict[int, Points], k: int, same: bool) -> DataFrame:
    """`(anchor, ask, found_id, score)`: for every ask of every anchor the k best of each shard that may have some.

    `members(width, cluster, part, anchor, vec_id, label, vec, low, high)`, low and high being lists of as many asks.
    """
    import pyarrow as pa

    spark = members.sparkSession
    shared = spark.sparkContext.broadcast((centres, samples))

    def pack(table):
        width = table.column("width")[0].as_py()
        low = table.column("low").to_pylist()
        asks = max(map(len, low))
        # An ask that an anchor lacks can't be met.
        fill = lambda lists, x: np.array([own + [x] * (asks - len(own)) for own in lists], np.int64).reshape(len(lists), asks)
        block = Members(
            table.column("anchor").to_numpy(), table.column("vec_id").to_numpy(), table.column("label").to_numpy(), _matrix(table.column("vec"), width),
            fill(low, (1 << 63) - 1), fill(table.column("high").to_pylist(), NONE + 1),
        )
        block = _first_needs(block, shared.value[1].get(width), k, same)
        length = np.sqrt((block.matrix.astype(np.float64) ** 2).sum(1))
        least = np.where(length > 0, block.low.min(1) / np.where(length > 0, length, 1), -np.inf)
        keys = [table.column(c)[:1].cast(t) for c, t in (("width", pa.int32()), ("cluster", pa.int32()), ("part", pa.int64()))]
        return pa.table([*keys, pa.array([float(least.min())]), pa.array([pickle.dumps(tuple(block))], pa.binary())], ["width", "cluster", "part", "need", "blob"])

    blocks = settle(members.groupBy("width", "cluster", "part").applyInArrow(pack, "width int, cluster int, part long, need double, blob binary"))
    reach = shards.select("width", "shard", F.posexplode("reach").alias("cluster", "most"))
    pairs = settle(
        blocks.select("width", "cluster", "part", "need").join(reach, ["width", "cluster"]).filter("most >= need").select("width", "cluster", "part", "shard")
    )
    lists = pairs.select("width", "cluster", "shard").distinct()
    rows = shards.join(lists, ["width", "shard"]).select("width", "cluster", "shard", F.lit(0).alias("kind"), "blob")
    rows = rows.unionByName(blocks.join(pairs, ["width", "cluster", "part"]).select("width", "cluster", "shard", F.lit(1).alias("kind"), "blob"))
    n = max(1, min(lists.count(), 10_000))
    # A list is made once, then the blocks of its cluster pass by.
    dealt = rows.repartition(n, "width", "cluster", "shard").sortWithinPartitions("width", "cluster", "shard", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres, points, bound = shared.value[0], None, None
        for batch in batches:
            for cluster, kind, raw in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist(), batch.column(4)):
                if kind == 0:
                    points = Points(*pickle.loads(raw.as_py()))
                    bound = centres.bounds(points.matrix, cluster)
                    order = np.argsort(-bound, kind="stable")
                    points, bound = points.turned(order), bound[order]
                    continue
                block = Members(*pickle.loads(raw.as_py()))
                ask, ids, score = block.walk(points, bound, k, same)
                asks = block.low.shape[1]
                arrays = [pa.array(block.anchor[ask // asks]), pa.array((ask % asks).astype(np.int32)), pa.array(ids), pa.array(score)]
                yield pa.RecordBatch.from_arrays(arrays, ["anchor", "ask", "found_id", "score"])

    found = dealt.mapInArrow(run, "anchor long, ask int, found_id long, score long")
    return top_per_group(found, ["anchor", "ask"], [F.desc("score"), F.col("found_id")], k)


def _model(anchors: DataFrame, points: DataFrame) -> tuple[Centres, dict[int, Points]]:
    """Centres from a sample of the anchors, and a sample of the candidates of each width."""

    def drawn(df: DataFrame) -> dict[int, object]:
        sample = df.orderBy(F.xxhash64("vec"), "vec", "label").limit(SAMPLE).toArrow()
        width = sample.column("width").to_numpy()
        return {int(w): sample.take(np.flatnonzero(width == w)) for w in np.unique(width)}

    clusters = max(1, min(CLUSTERS, math.ceil(anchors.count() / PER_CLUSTER)))
    centres = Centres({w: _matrix(t.column("vec"), w) for w, t in drawn(anchors.select("width", "label", "vec")).items() if w}, clusters)
    return centres, {w: _points(t, w) for w, t in drawn(points).items()}


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
) -> DataFrame:
    """`(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)` by exact inner products.

    `rows(vec_id, label, vec)` are the candidates and `anchors` of the same columns the anchors, vectors of 64-bit numbers.  An
    anchor's positives are the first `positives` other rows of its label; for each, its negatives are the first
    `negatives` rows of other labels with low * positive_score <= 100 * negative_score <= high * positive_score.
    Higher scores come first, ties go to the smaller id.  Rows with an anchor's id are none of its partners; rows of one id
    that differ otherwise are candidates, and anchors, in their own right.  Vectors of another width do not meet.
    Vectors without components or of zeros score 0.  A positive without negatives has no row.
    """
    import pyarrow as pa

    keep = max(positives, negatives) + 1
    # Rows alike in label and vector are one point, of which no anchor needs more than the first ids.
    first = top_per_group(rows.select("vec_id", "label", "vec"), ["label", "vec"], [F.col("vec_id")], keep)
    points = first.groupBy("label", "vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    points = settle(points.withColumn("width", F.size("vec")))
    named = anchors.select("vec_id", "label", "vec", F.size("vec").alias("width")).withColumn("anchor", F.monotonically_increasing_id())
    named = settle(named)
    centres, samples = _model(named, points)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.column(batch.schema.get_field_index("width")).to_numpy()
            cluster, angle = np.zeros(len(width), np.int32), np.zeros(len(width))
            for w in np.unique(width).tolist():
                at = np.flatnonzero(width == w)
                own = batch.column(batch.schema.get_field_index("vec")).take(pa.array(at))
                cluster[at], angle[at] = centres.nearest(_matrix(own, w))
            yield batch.append_column("cluster", pa.array(cluster)).append_column("angle", pa.array(angle))

    def assigned(df: DataFrame) -> DataFrame:
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
        return df.mapInArrow(assign, f"{schema}, cluster int, angle double")

    def parted(df: DataFrame, size: int, *key: str) -> DataFrame:
        """With `part`, so that the rows of a cluster and part are about `size`."""
        parts = df.groupBy("width", "cluster").agg(F.ceil(F.count("*") / F.lit(size)).alias("parts"))
        return lookup_join(df, parts, ["width", "cluster"]).withColumn("part", F.pmod(F.xxhash64(*key), F.col("parts"))).drop("parts")

    members = settle(parted(assigned(named), BLOCK, "anchor"))
    # At most CLUSTERS for each width that the sample holds.
    wide = members.filter(F.col("width").isin(sorted(centres.of))).groupBy("width", "cluster").agg(F.max("angle").alias("angle"))
    centres.reach = {(r.width, r.cluster): r.angle for r in wide.collect()}

    def pack(table):
        width, cluster, part = (table.column(c)[0].as_py() for c in ("width", "cluster", "part"))
        own = _points(table, width)
        most = [float(centres.bounds(own.matrix, c).max()) for c in range(centres.count(width))]
        reach, blob = pa.array([most], pa.list_(pa.float64())), pa.array([pickle.dumps(tuple(own))], pa.binary())
        return pa.table([pa.array([width], pa.int32()), pa.array([f"{cluster}-{part}"]), reach, blob], ["width", "shard", "reach", "blob"])

    dealt = parted(assigned(points), SHARD, "label", "vec")
    shards = settle(dealt.groupBy("width", "cluster", "part").applyInArrow(pack, "width int, shard string, reach array<double>, blob binary"))

    asked = members.select("*", F.array(F.lit(NONE + 1)).alias("low"), F.array(F.lit(2**63 - 1)).alias("high"))
    near = settle(_walked(asked, shards, centres, samples, positives, True).select("anchor", "rank", F.col("found_id").alias("positive_id"), "score"))

    score = F.col("score").cast("decimal(38, 0)")
    # The smallest whole number from low / 100 and the largest to high / 100 of the score.
    from_, to = F.ceil(score * low / 100).cast("long"), F.floor(score * high / 100).cast("long")
    windows = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("rank", from_.alias("low"), to.alias("high")))).alias("w"))
    asked = members.join(windows, "anchor").select(*members.columns, F.col("w.low").alias("low"), F.col("w.high").alias("high"))
    hard = _walked(asked, shards, centres, samples, negatives, False).withColumnsRenamed({"score": "negative_score", "rank": "nth"})
    both = hard.withColumn("rank", F.col("ask") + 1).join(near, ["anchor", "rank"]).join(named.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
    return both.select(
        "anchor_id", "positive_id", F.col("nth").cast("int").alias("rank"), F.col("found_id").alias("negative_id"), F.col("score").alias("positive_score"), "negative_score"
    )

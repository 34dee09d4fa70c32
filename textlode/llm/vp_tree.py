"""Nearest neighbours by inner product with one vantage-point tree per shard.

Vectors get one more component that makes all of one length, so that the
largest inner product is the smallest Euclidean distance.  A tree halves a
shard again and again by the distance from a vantage point; a branch whose
distance bound, times a relaxation factor, exceeds the k-th best distance so
far is pruned.  Factor one is exact; a larger one prunes more.

Trees hold vectors of like magnitude, scaled by a power of two, and queries are scaled as well, so that squares
neither overflow nor vanish, however large or small single vectors are.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlode.operators.joins import top_per_group
from textlode.sources.store import settle

SHARD = 4_096
BLOCK = 2_048
LEAF = 128
# Candidates searched beyond k at first; scores are then computed exactly.
SPARE = 12
# Vectors whose largest components lie within so many powers of two share trees.
MAGNITUDES = 32


def valid_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """`(vec_id, vec)` without null ids and without null, zero, or not wholly finite vectors."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(
        F.col("vec_id").isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists("vec", lambda x: x != 0)
    )


class Tree:
    """A vantage-point tree over the rows of `points`; children know the range of distances from the vantage point."""

    def __init__(self, points: np.ndarray):
        self.points, self.longest = points, float((points * points).sum(1).max(initial=0.0))
        longest = self.longest
        self.rest = np.sqrt(np.maximum(0.0, longest - (points * points).sum(1)))
        self.order = np.arange(len(points))
        self.nodes: list[tuple] = []
        if len(points):
            self._split(0, len(points))

    def _split(self, low: int, high: int) -> int:
        """Node over order[low:high]: (low, high, vantage point, [(child, nearest, farthest), ...])."""
        number = len(self.nodes)
        self.nodes.append(())
        own = self.order[low:high]
        if high - low <= LEAF:
            self.nodes[number] = (low, high, -1, ())
            return number
        vantage = int(own[len(own) // 2])
        d = 2 * (self.longest - self.points[own] @ self.points[vantage] - self.rest[own] * self.rest[vantage])
        d = np.sqrt(np.maximum(0.0, d))
        turn = np.argsort(d, kind="stable")
        self.order[low:high], d = own[turn], d[turn]
        middle = (high - low) // 2
        children = []
        for a, b in ((0, middle), (middle, high - low)):
            children.append((self._split(low + a, low + b), float(d[a]), float(d[b - 1])))
        self.nodes[number] = (low, high, vantage, tuple(children))
        return number

    def search(self, queries: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
        """Inner products and rows of the best k found for each query, best first; -1 for none."""
        n = len(queries)
        best, row = np.full((n, k), -np.inf), np.full((n, k), -1)
        base = (queries * queries).sum(1) + self.longest

        def visit(number: int, active: np.ndarray) -> None:
            low, high, vantage, children = self.nodes[number]
            if not children:
                own = self.order[low:high]
                found = queries[active] @ self.points[own].T
                keep = min(k, found.shape[1])
                top = np.argpartition(-found, keep - 1, axis=1)[:, :keep]
                value = np.concatenate([best[active], np.take_along_axis(found, top, 1)], 1)
                which = np.concatenate([row[active], own[top]], 1)
                turn = np.argsort(-value, axis=1, kind="stable")[:, :k]
                best[active], row[active] = np.take_along_axis(value, turn, 1), np.take_along_axis(which, turn, 1)
                return
            d = np.sqrt(np.maximum(0.0, base[active] - 2 * (queries[active] @ self.points[vantage])))
            bounds = np.stack([np.maximum(near - d, d - far) for _, near, far in children])
            first = bounds[1] < bounds[0]
            for side in (False, True):
                mine, bound = active[first == side], bounds[:, first == side]
                for child in (side, not side):
                    reach = np.sqrt(np.maximum(0.0, base[mine] - 2 * best[mine, -1]))
                    # A little more than the bound, for rounding.
                    open_ = bound[int(child)] * factor <= reach * (1 + 1e-9) + 1e-6
                    if open_.any():
                        visit(children[int(child)][0], mine[open_])

        if len(self.points) and n:
            visit(0, np.arange(n))
        return best, row


def build_trees(vectors: DataFrame, k: int, shard: int = SHARD) -> DataFrame:
    """`(width, magnitude, shard, tree)`: the index, each shard a pickled (points, tree, ids) of about `shard` different vectors.

    Equal vectors are one point with its k + 1 smallest different ids, reduced
    before the shuffle; a query can need no more of them.
    """
    once = vectors.select("vec_id", "vec").distinct()
    points = top_per_group(once, ["vec"], [F.col("vec_id")], k + 1).groupBy("vec").agg(
        F.sort_array(F.collect_list("vec_id")).alias("ids")
    )
    largest = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    magnitude = F.floor(F.log2(largest) / MAGNITUDES).cast("int")
    points = settle(points.withColumns({"width": F.size("vec"), "magnitude": magnitude}))
    shards = max(1, math.ceil(points.count() / shard))

    def build(table):
        import pyarrow as pa

        size, magnitude = table.column("width")[0].as_py(), table.column("magnitude")[0].as_py()
        vec = table.column("vec").combine_chunks()
        flat = (vec.combine_chunks() if isinstance(vec, pa.ChunkedArray) else vec).flatten().to_numpy()
        points = np.ascontiguousarray(flat).reshape(-1, size)
        tree = Tree(np.ldexp(points, _exponent(magnitude)))
        raw = pickle.dumps((points, tree.longest, tree.rest, tree.order, tree.nodes, table.column("ids").to_pylist()))
        keys = [table.column("width")[:1].cast(pa.int32()), table.column("magnitude")[:1].cast(pa.int32()), table.column("shard")[:1].cast(pa.int64())]
        return pa.table([*keys, pa.array([raw], pa.binary())], ["width", "magnitude", "shard", "tree"])

    dealt = points.withColumn("shard", F.pmod(F.xxhash64("vec"), F.lit(shards)))
    trees = dealt.groupBy("width", "magnitude", "shard").applyInArrow(build, "width int, magnitude int, shard long, tree binary")
    return settle(trees)


def _exponent(magnitude: int) -> int:
    """The power of two that scales vectors of a magnitude to components of one at most."""
    return -MAGNITUDES * (magnitude + 1)


def _exact(a: np.ndarray, b: np.ndarray) -> float:
    """The inner product, correctly rounded also where a product or a sum on the way is beyond double precision."""
    try:
        with np.errstate(over="ignore", invalid="ignore"):
            total = math.fsum((a * b).tolist())
        if math.isfinite(total):
            return total
    except (OverflowError, ValueError):
        pass
    total = sum(Fraction(x) * Fraction(y) for x, y in zip(a.tolist(), b.tolist()))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def _blocks(queries: DataFrame, block: int) -> DataFrame:
    """`(width, block, query)` with about `block` queries each."""
    blocks = max(1, math.ceil(queries.count() / block))

    def gather(table):
        import pyarrow as pa

        raw = pickle.dumps((table.column("vec_id").to_numpy(), np.array(table.column("vec").to_pylist(), float)))
        return pa.table({"width": table.column("width")[:1].cast(pa.int32()), "block": table.column("block")[:1],
                         "query": pa.array([raw], pa.binary())})

    dealt = queries.select("*", F.size("vec").alias("width"), F.pmod(F.xxhash64("vec_id", "vec"), F.lit(blocks)).alias("block"))
    return dealt.groupBy("width", "block").applyInArrow(gather, "width int, block long, query binary")


def _unscaled(x: float, power: int) -> float:
    try:
        return math.ldexp(x, power)
    except OverflowError:
        return math.copysign(math.inf, x)


def _hits(
    tree: Tree, points: np.ndarray, power: int, ids: list[list[int]], names: np.ndarray, matrix: np.ndarray, k: int, factor: float
) -> list[list[tuple]]:
    """(-score, id) of the k best different ids for each query; `points` are the tree's times 2 ** -power.

    Points that hold too few ids, or whose last one may tie with the k-th id, are not enough: twice as many are searched.
    """
    own = np.frexp(np.abs(matrix).max(1))[1]
    scaled = np.ldexp(matrix, -own[:, None])
    out: list[list[tuple]] = [[]] * len(names)
    open_, size = np.arange(len(names)), k + 1 + SPARE
    while len(open_):
        value, found = tree.search(scaled[open_], size, factor)
        # More than the rounding of a product.
        slack = 1e-15 * (matrix.shape[1] + 1) * np.sqrt((scaled[open_] ** 2).sum(1) * tree.longest)
        left = []
        for n, last, rows, eps in zip(open_.tolist(), value[:, -1].tolist(), found, slack.tolist()):
            rows = rows[rows >= 0]
            best: dict[int, float] = {}
            for r in rows.tolist():
                s = _exact(points[r], matrix[n])
                for i in ids[r]:
                    if i != names[n] and (i not in best or s > best[i]):
                        best[i] = s
            out[n] = sorted((-s, i) for i, s in best.items())[:k]
            beyond = _unscaled(last + eps, int(own[n]) - power)
            if size < len(points) and (len(out[n]) < k or -out[n][-1][0] <= beyond):
                left.append(n)
        open_, size = np.array(left, int), min(2 * size, len(points))
    return out


def nearest(
    queries: DataFrame, trees: DataFrame, k: int = 20, factor: float = 1.0, block: int = BLOCK
) -> DataFrame:
    """`(query_id, rank, vec_id, score)` from `queries(vec_id, vec)` and the index built for the same k.

    Score is the correctly rounded inner product, infinite beyond double precision.  Ties go to the smaller
    vec_id; a vector is no neighbour of a query with its id.  Rows that share an
    id count as one: its best score.  Vectors of another width do not meet.
    """
    blocks = _blocks(queries, block)
    keys = ["width", "magnitude", "shard"]
    # A tree moves once, and the blocks of its width pass by: a task holds one tree and one block at a time.
    rows = trees.select(*keys, F.lit(0).alias("kind"), F.col("tree").alias("raw"))
    met = trees.select(*keys).join(blocks, "width").select(*keys, F.lit(1).alias("kind"), F.col("query").alias("raw"))
    n = max(1, min(trees.count(), 10_000))
    dealt = rows.unionByName(met).repartition(n, *keys).sortWithinPartitions(*keys, "kind").select("magnitude", "kind", "raw")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tree, points, ids = None, None, None
        for batch in batches:
            for magnitude, kind, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if kind == 0:
                    tree = Tree.__new__(Tree)
                    points, tree.longest, tree.rest, tree.order, tree.nodes, ids = pickle.loads(raw.as_py())
                    tree.points = np.ldexp(points, _exponent(magnitude))
                    continue
                names, matrix = pickle.loads(raw.as_py())
                query_id, vec_id, score = [], [], []
                for name, hits in zip(names.tolist(), _hits(tree, points, _exponent(magnitude), ids, names, matrix, k, factor), strict=True):
                    query_id += [name] * len(hits)
                    score += [-s for s, _ in hits]
                    vec_id += [i for _, i in hits]
                arrays = [pa.array(query_id, pa.int64()), pa.array(vec_id, pa.int64()), pa.array(score, pa.float64())]
                yield pa.RecordBatch.from_arrays(arrays, ["query_id", "vec_id", "score"])

    hits = dealt.mapInArrow(run, "query_id long, vec_id long, score double")
    hits = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    best = top_per_group(hits, ["query_id"], [F.desc("score"), F.col("vec_id")], k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

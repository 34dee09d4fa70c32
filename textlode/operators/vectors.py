"""Embedding, pooling and exact nearest neighbours."""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from textlode.functions.cleaning import collapse_ends
from textlode.functions.vectors import cosine, rounded, term_bucket
from textlode.operators.bm25 import term_counts, term_rows
from textlode.operators.joins import BROADCAST_ROWS, lookup_join, top_per_group, within
from textlode.sources.store import settle

# Query tables of at most this many rows go to every task as one matrix.
QUERY_ROWS = 4_096
# Vectors of one block that queries pass by.
BLOCK_VECTORS = 20_000
# Cells at most, vectors that one is meant for, and vectors of the sample that gives their centres.
CELLS, CELL_VECTORS, SAMPLE_VECTORS = 1_024, 2_000, 16_384
# Cells that many vectors make at least, unless they would be larger than a block.
LEAST_CELLS = 48
# Scores computed at a time.
SCORE_VALUES = 4_000_000


Encoder = Callable[[list[str]], np.ndarray]


def embed_with(
    df: DataFrame,
    text: str,
    encode: Encoder | None = None,
    out: str = "embedding",
    factory: Callable[[], Encoder] | None = None,
    batch_size: int = 32,
) -> DataFrame:
    """Adds the vectors a batch encoder gives for the texts; a blank text gets null.

    The encoder is called with at most `batch_size` non-blank texts and returns
    one row per text; rows keep their alignment.  A model is not pickled: it
    comes from `factory`, which is called once in every task.
    """
    if (encode is None) == (factory is None):
        raise ValueError("either an encoder or a factory for one")

    @F.pandas_udf(T.ArrayType(T.FloatType()))
    def vectors(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = encode if factory is None else factory()
        for texts in batches:
            filled = [t for t in texts if t]
            parts = [filled[at : at + batch_size] for at in range(0, len(filled), batch_size)]
            made = (row for part in parts for row in np.asarray(model(part), dtype=np.float32))
            yield pd.Series([next(made) if t else None for t in texts])

    return df.withColumn(out, vectors(collapse_ends(F.col(text))))


def embed_tfidf(docs: DataFrame, dim: int = 64) -> DataFrame:
    """`(doc_id, embedding)` of `docs(doc_id, clean)`, one row per row: sums of tf * idf per hash bucket; no words give null.

    idf is ln((1 + N) / (1 + df)) + 1 over all rows.  Common words meet their idf where they are and move as sums of their
    buckets; of a vocabulary too large to broadcast, only rows of rare words move, by the word.
    """
    numbered = settle(docs.select("doc_id", "clean").withColumn("uid", F.monotonically_increasing_id()))
    rows = settle(term_rows(numbered, "clean", "uid").select(F.col("doc_id").alias("uid"), "dl", "term", "tf"))
    counts = term_counts(rows)
    n_docs = numbered.count()
    idf = settle(counts.filter("term is not null").select("term", "df", (F.log((1 + F.lit(n_docs)) / (1 + F.col("df"))) + 1).alias("idf")))
    weighted = _with_idf(rows.filter("term is not null"), idf)
    sums = weighted.groupBy("uid", term_bucket(F.col("term"), dim).alias("bucket")).agg(F.sum(F.col("tf") * F.col("idf")).alias("x"))
    lists = sums.groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct(F.col("bucket").cast("int").alias("b"), "x"))).alias("m"))
    places = F.sequence(F.lit(0), F.lit(dim - 1))
    dense = lists.select("uid", F.transform(places, lambda i: F.coalesce(F.element_at("m", i), F.lit(0.0))).alias("embedding"))
    return numbered.select("uid", "doc_id").join(dense, "uid", "left").select("doc_id", "embedding")


def _with_idf(rows: DataFrame, idf: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`rows(.., term, ..)` with the `idf` of their term, from `idf(term, df, idf)`.

    No more than `most` terms have more than one row in `most` of all rows.  These are broadcast; the others are no hot keys.
    """
    if within(idf, most):
        return rows.join(F.broadcast(idf.drop("df")), "term")
    least = idf.agg(F.sum("df")).head()[0] / most
    common, rare = idf.filter(F.col("df") > least).drop("df"), idf.filter(F.col("df") <= least).drop("df")
    left = rows.join(F.broadcast(common.select("term")), "term", "left_anti")
    return rows.join(F.broadcast(common), "term").unionByName(left.join(rare.hint("merge"), "term"))


def mean_pool(df: DataFrame, key: str, vec: str, mask: Column) -> DataFrame:
    """`(key, embedding)`: masked mean of the vectors of each key; nothing unmasked gives zeros.

    Every task adds whole vectors up, batch by batch, and hands on one sum per
    key, so one key holding most vectors is no hot spot and no component is a
    row before that.  Null vectors are left out; null components and masks add nothing.
    """
    kept = df.select(
        key, mask.cast("double").alias("mask"), F.col(vec).cast("array<double>").alias("vec")
    )
    schema = T.StructType(
        [
            T.StructField(key, df.schema[key].dataType),
            T.StructField("weight", T.DoubleType()),
            T.StructField("totals", T.ArrayType(T.DoubleType())),
        ]
    )
    parts = kept.mapInArrow(_partial_sums(to_arrow_schema(schema)), schema)
    sums = (
        parts.select(key, "weight", F.posexplode("totals").alias("dim", "total"))
        .groupBy(key, "dim")
        .agg(F.sum("total").alias("total"), F.sum("weight").alias("weight"))
    )
    mean = F.col("total") / F.greatest(F.col("weight"), F.lit(1e-9))
    ordered = F.array_sort(F.collect_list(F.struct("dim", mean.alias("x"))))
    return sums.groupBy(key).agg(F.transform(ordered, lambda p: p["x"]).alias("embedding"))


def _partial_sums(out: pa.Schema):
    """Adds up `(key, mask, vec)` per key and width; hands on when it holds many keys, and at the end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list] = {}

        def told() -> pa.RecordBatch:
            keys = [name for name, _ in held]
            columns = [keys, [w for w, _ in held.values()], [t for _, t in held.values()]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

        for batch in batches:
            batch = batch.filter(pc.is_valid(batch.column(2)))
            if not batch.num_rows:
                continue
            keys = batch.column(0).dictionary_encode(null_encoding="encode")
            place, names = keys.indices.to_numpy(), keys.dictionary.to_pylist()
            weight = pc.fill_null(batch.column(1), 0.0).to_numpy()
            widths = pc.list_value_length(batch.column(2)).to_numpy()
            for width in np.unique(widths).tolist():
                at = np.flatnonzero(widths == width)
                values = pc.fill_null(batch.column(2).take(pa.array(at)).flatten(), 0.0).to_numpy(zero_copy_only=False)
                values = values.reshape(len(at), width) * weight[at, None]
                totals = np.zeros((len(names), width))
                np.add.at(totals, place[at], values)
                weights = np.bincount(place[at], weight[at], len(names))
                for n in np.unique(place[at]).tolist():
                    seen = held.setdefault((names[n], width), [0.0, np.zeros(width)])
                    seen[0] += weights[n]
                    seen[1] += totals[n]
            if len(held) > 20_000:
                yield told()
                held.clear()
        if held:
            yield told()

    return run


def vector_count(vectors: DataFrame) -> DataFrame:
    return vectors.agg(F.count("*").alias("n"))


def cosine_pairs(
    vectors: DataFrame, anchors: DataFrame, on: str, vec: str = "embedding", anchor: str = "anchor"
) -> DataFrame:
    """Cosine of every vector with the anchor of its group; `anchors(on, anchor)` is unique on `on`."""
    joined = lookup_join(vectors, anchors, [on])
    return joined.withColumn("cosine", rounded(cosine(F.col(vec), F.col(anchor))))


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _scores(queries: np.ndarray, vectors: np.ndarray, metric: str, digits: int) -> np.ndarray:
    """Scores where larger is better, rounded so that summation order decides no rank."""
    products = queries @ vectors.T
    if metric == "l2":
        squares = (queries**2).sum(1)[:, None] + (vectors**2).sum(1)[None, :]
        products = -np.maximum(squares - 2 * products, 0.0)
    return np.round(products, digits) + 0.0


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k best rows of each query; ties go to the smaller id."""
    id_order = np.empty(len(ids), dtype=np.int64)
    id_order[np.argsort(ids, kind="stable")] = np.arange(len(ids))
    order = np.lexsort((id_order, -score, query))
    query = query[order]
    first = np.searchsorted(query, query, side="left")
    return order[np.arange(len(order)) - first < k]


def _batch_best(state, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k, metric, digits):
    """Merges a batch into the running best `(query row, id, score)` arrays, tile by tile."""
    step = max(1, SCORE_VALUES // max(len(queries), 1))
    for at in range(0, len(ids), step):
        scores = _scores(queries, vectors[at : at + step], metric, digits)
        names = ids[at : at + step]
        if scores.shape[1] > k:
            least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
            rows, cols = np.nonzero(scores >= least[:, None])
        else:
            rows, cols = np.indices(scores.shape).reshape(2, -1)
        found = (rows, names[cols], scores[rows, cols])
        if state is not None:
            found = tuple(np.concatenate(pair) for pair in zip(state, found))
        kept = _best(*found, k)
        state = tuple(part[kept] for part in found)
    return state


def _reaching(queries: np.ndarray, least: np.ndarray, vectors: np.ndarray, metric: str, digits: int):
    """`(query row, vector row, score)` of at least all pairs that score `least` of their query or more; None if single precision cannot tell.

    Products in single precision, with their greatest error allowed for, rule out almost all pairs; the others are computed exactly.
    """
    norms, sizes = np.sqrt((queries**2).sum(1)), (vectors**2).sum(1)
    most = max(norms.max(initial=0.0), np.sqrt(sizes.max(initial=0.0)))
    # Not numbers, or beyond what their squares can be in single precision.
    if not most < 1e15:
        return None
    width = queries.shape[1]
    half = 0.5 * sizes if metric == "l2" else np.zeros(len(vectors))
    left = np.hstack([queries, np.ones((len(queries), 1))]).astype(np.float32)
    right = np.hstack([vectors, -half[:, None]]).astype(np.float32)
    need = 0.5 * (least + norms**2) if metric == "l2" else least
    error = (width + 8) * 2.0**-22 * (norms * np.sqrt(sizes.max(initial=0.0)) + half.max(initial=0.0))
    # Also what is rounded off, and what the smallest single numbers lose.
    need = need - error - 10.0**-digits - 1e-9 * np.abs(need) - (width + 8) * 1e-37
    need = np.nextafter(need.astype(np.float32), np.float32(-np.inf))
    found = []
    step = max(1, SCORE_VALUES // max(len(queries), 1))
    for at in range(0, len(vectors), step):
        flat = np.flatnonzero((left @ right[at : at + step].T) >= need[:, None])
        if len(flat) > SCORE_VALUES // 8:
            return None
        width_here = len(right[at : at + step])
        rows, cols = flat // width_here, flat % width_here + at
        for low in range(0, len(rows), 50_000):
            r, c = rows[low : low + 50_000], cols[low : low + 50_000]
            score = np.einsum("ij,ij->i", queries[r], vectors[c])
            if metric == "l2":
                score = -np.maximum(norms[r] ** 2 + sizes[c] - 2 * score, 0.0)
            found.append((r, c, np.round(score, digits) + 0.0))
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
    return tuple(np.concatenate(parts) for parts in zip(none, *found))


def _block_best(queries: np.ndarray, least: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, metric: str, digits: int):
    """`(query row, id, score)` of the k best vectors of a block for each query, those below its `least` (if not NaN) left out as far as told apart."""
    known = np.flatnonzero(~np.isnan(least))
    parts = []
    told = _reaching(queries[known], least[known], vectors, metric, digits) if len(known) else None
    if told is not None:
        rows, cols, score = told
        best = _best(rows, ids[cols], score, k)
        parts.append((known[rows[best]], ids[cols[best]], score[best]))
    rest = np.arange(len(queries)) if told is None else np.flatnonzero(np.isnan(least))
    if len(rest):
        rows, found, score = _batch_best(None, queries[rest], ids, vectors, k, metric, digits)
        parts.append((rest[rows], found, score))
    return tuple(np.concatenate(part) for part in zip(*parts))


def top_k_vectors(
    queries: DataFrame,
    vectors: DataFrame,
    k: int,
    metric: str = "ip",
    key: str = "doc_id",
    vec: str = "embedding",
    digits: int = 6,
) -> DataFrame:
    """Exact top-k of every query: `(query_id, <key>, score, rank)`.

    `queries(query_id, <vec>)` against `vectors(<key>, <vec>)`; `metric` is
    "ip" (larger is better) or "l2" (squared distance, smaller is better).
    Queries of more than one width are an error, whatever their number;
    vectors of another width than the queries are left out.  Each task scores
    its Arrow batches with one matrix product and hands on k rows per query.

    A query matrix of checked size is sent to all tasks.  Beyond that, queries
    meet the cells of vectors that can reach their lists (`top_k_pruned`).
    """
    # Missing and odd vectors are left out inside the scan: as filters, the
    # conditions would be pushed down and compute every vector once more.
    queries = queries.select("query_id", vec)
    vectors = vectors.select(key, vec)
    schema = _hits_schema(queries, vectors, key)
    widths = queries.filter(F.col(vec).isNotNull()).select(F.size(vec).alias("width")).distinct().limit(2).collect()
    if len(widths) > 1:
        raise ValueError("query vectors differ in width")
    sample = queries.limit(QUERY_ROWS + 1).toArrow()
    if sample.num_rows <= QUERY_ROWS:
        best = _broadcast_top_k(sample, vectors, k, metric, digits, schema)
    else:
        best = _pruned_top_k(queries, vectors, k, metric, digits, schema)
    return _ranked(best, k, metric, key)


def _broadcast_top_k(queries: pa.Table, vectors, k, metric, digits, schema) -> DataFrame:
    queries = queries.filter(pc.is_valid(queries.column(1))).combine_chunks()
    query_ids = queries.column(0).to_numpy()
    matrix = _matrix(queries.column(1).chunk(0)) if queries.num_rows else np.empty((0, 0))
    shared = vectors.sparkSession.sparkContext.broadcast((query_ids, matrix))
    out = to_arrow_schema(schema)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, against = shared.value
        state = None
        for batch in batches:
            fitting = pc.equal(pc.list_value_length(batch.column(1)), against.shape[1])
            batch = batch.filter(fitting, null_selection_behavior="drop")
            if batch.num_rows == 0 or len(names) == 0:
                continue
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            state = _batch_best(state, against, ids, _matrix(batch.column(1)), k, metric, digits)
        if state is not None:
            rows, ids, score = state
            columns = [names[rows].tolist(), ids.tolist(), score]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, out)], schema=out
            )

    return vectors.mapInArrow(scan, schema)


class Cells(NamedTuple):
    """A division of the vectors: the centre, radius and number of vectors of each cell, and the pieces that it is cut into."""

    centre: np.ndarray
    radius: np.ndarray
    size: np.ndarray
    pieces: np.ndarray

    def bounds(self, queries: np.ndarray, metric: str) -> np.ndarray:
        """What no vector of a cell exceeds as a score with a query; one row per query."""
        if metric == "ip":
            return queries @ self.centre.T + np.sqrt((queries**2).sum(1))[:, None] * self.radius[None, :]
        squares = (queries**2).sum(1)[:, None] + (self.centre**2).sum(1)[None, :] - 2 * queries @ self.centre.T
        return -(np.maximum(0.0, np.sqrt(np.maximum(squares, 0.0)) - self.radius[None, :]) ** 2)


def _centres(sample: np.ndarray, cells: int) -> np.ndarray:
    """Means of a sample's groups, by a few rounds of moving them to what is nearest."""
    centres = sample[np.linspace(0, len(sample) - 1, min(cells, len(sample))).astype(int)]
    for _ in range(6):
        own = ((centres**2).sum(1)[None, :] - 2 * sample @ centres.T).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        count = np.bincount(own, minlength=len(centres))
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def divide(vectors: DataFrame, width: int) -> tuple[DataFrame, Cells]:
    """`(cell, piece, block)` of the vectors of this width, blocks being pickles of at most about BLOCK_VECTORS ids and vectors.

    Cells are the surroundings of at most CELLS centres, which a bounded sample gives; every vector lies in the cell of its nearest centre.
    """
    key, vec = vectors.columns
    fitting = vectors.filter(F.size(vec) == width)
    drawn = fitting.orderBy(F.xxhash64(vec), vec).limit(SAMPLE_VECTORS).toArrow()
    n = fitting.count()
    # Queries move once per cell that they reach, so cells grow with the vectors up to a block.
    cells = max(1, min(CELLS, math.ceil(n / min(BLOCK_VECTORS, max(CELL_VECTORS, n // LEAST_CELLS)))))
    centres = _centres(_matrix(drawn.column(1).combine_chunks()) if len(drawn) else np.zeros((1, width)), cells)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            matrix = _matrix(batch.column(1))
            far = (centres**2).sum(1)[None, :] - 2 * matrix @ centres.T
            own = far.argmin(1)
            off = np.sqrt(((matrix - centres[own]) ** 2).sum(1))
            yield batch.append_column("cell", pa.array(own.astype(np.int32))).append_column("off", pa.array(off))

    named = fitting.select(F.col(key).alias("id"), F.col(vec).cast("array<double>").alias("vec"))
    schema = T.StructType([*named.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("off", T.DoubleType())])
    dealt = settle(named.mapInArrow(assign, schema))
    # At most CELLS rows.
    found = {r.cell: r for r in dealt.groupBy("cell").agg(F.max("off").alias("radius"), F.count("*").alias("n")).collect()}
    size = np.array([found[c].n if c in found else 0 for c in range(len(centres))], np.int64)
    radius = np.array([found[c].radius if c in found else 0.0 for c in range(len(centres))])
    pieces = np.maximum(1, -(-size // BLOCK_VECTORS))
    kinds = F.array(*[F.lit(int(p)) for p in pieces])

    def pack(table: pa.Table) -> pa.Table:
        raw = pickle.dumps((table.column("id").to_pylist(), _matrix(table.column("vec").combine_chunks())))
        keys = [table.column(c)[:1] for c in ("cell", "piece")]
        return pa.table([keys[0].cast(pa.int32()), keys[1].cast(pa.int64()), pa.array([raw], pa.binary())], ["cell", "piece", "block"])

    cut = dealt.withColumn("piece", F.pmod(F.xxhash64("id", "vec"), F.get(kinds, F.col("cell"))).cast("long"))
    blocks = settle(cut.groupBy("cell", "piece").applyInArrow(pack, "cell int, piece long, block binary"))
    return blocks, Cells(centres, radius, size, pieces)


def _met(queries: DataFrame, blocks: DataFrame, cells: Cells, chosen, k: int, metric: str, digits: int, schema: T.StructType) -> DataFrame:
    """Best k of each block for the queries `(query_id, <vec>, least)` that `chosen` sends there, if they score `least`.

    A block is read once and the queries pass by.
    """
    out = to_arrow_schema(schema)
    kind = queries.schema["query_id"].dataType

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, cell = np.nonzero(chosen(batch, _matrix(batch.column(1))))
            times = cells.pieces[cell]
            row, cell = np.repeat(row, times), np.repeat(cell, times)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            for low in range(0, len(row), 4_096):
                own = slice(low, low + 4_096)
                at = pa.array(row[own])
                columns = [pa.array(cell[own].astype(np.int32)), pa.array(piece[own]), *[batch.column(i).take(at) for i in range(3)]]
                yield pa.RecordBatch.from_arrays(columns, ["cell", "piece", "query_id", "vec", "least"])

    sent = T.StructType([T.StructField("cell", T.IntegerType()), T.StructField("piece", T.LongType()), T.StructField("query_id", kind),
                         T.StructField("vec", T.ArrayType(T.DoubleType())), T.StructField("least", T.DoubleType())])
    asked = queries.mapInArrow(send, sent).select(
        "cell", "piece", F.lit(1).alias("kind"), "query_id", "vec", "least", F.lit(None).cast("binary").alias("block")
    )
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in sent.fields[2:]]
    rows = blocks.select("cell", "piece", F.lit(0).alias("kind"), *none, "block").unionByName(asked)
    n = int(cells.pieces.sum())
    dealt = rows.repartition(max(1, min(n, 10_000)), "cell", "piece").sortWithinPartitions("cell", "piece", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = matrix = here = None
        for batch in batches:
            cell, piece, kinds = (batch.column(i).to_numpy() for i in range(3))
            edges = [*np.flatnonzero(kinds == 0).tolist(), batch.num_rows]
            spans = [(0, edges[0])] + [(low + 1, high) for low, high in zip(edges, edges[1:])]
            for number, (low, high) in enumerate(spans):
                if number:
                    names, matrix = pickle.loads(batch.column(6)[edges[number - 1]].as_py())
                    ids = np.array(names, dtype=object if names and isinstance(names[0], str) else None)
                    here = (cell[low - 1], piece[low - 1])
                # A cell or piece without vectors has no block.
                own = np.zeros(0, int) if here is None else low + np.flatnonzero((cell[low:high] == here[0]) & (piece[low:high] == here[1]))
                if not len(own):
                    continue
                part = batch.take(pa.array(own))
                least = part.column(5).to_numpy(zero_copy_only=False).astype(float)
                who, found, score = _block_best(_matrix(part.column(4)), least, ids, matrix, k, metric, digits)
                columns = [part.column(3).take(pa.array(who)), pa.array(found.tolist(), out[1].type), pa.array(score)]
                yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, out)], schema=out)

    return dealt.mapInArrow(run, schema)


def top_k_pruned(
    queries: DataFrame, vectors: DataFrame, k: int, metric: str = "ip", key: str = "doc_id", vec: str = "embedding", digits: int = 6
) -> DataFrame:
    """`top_k_vectors` for any number of queries, all of one width, without comparing all with all.

    Vectors are dealt out by their nearest centre.  A query first meets the cells of the highest bounds that hold k vectors, then
    only cells whose bound reaches the k-th best score found there.  Vectors stay in their blocks; it is queries that move.
    """
    schema = _hits_schema(queries.select("query_id", vec), vectors.select(key, vec), key)
    return _ranked(_pruned_top_k(queries.select("query_id", vec), vectors.select(key, vec), k, metric, digits, schema), k, metric, key)


def _hits_schema(queries: DataFrame, vectors: DataFrame, key: str) -> T.StructType:
    kinds = {"query_id": queries.schema["query_id"].dataType, key: vectors.schema[key].dataType, "score": T.DoubleType()}
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _ranked(best: DataFrame, k: int, metric: str, key: str) -> DataFrame:
    top = top_per_group(best, ["query_id"], [F.desc("score"), F.asc(key)], k)
    if metric == "l2":
        top = top.withColumn("score", F.lit(0.0) - F.col("score"))
    return top.select("query_id", key, "score", "rank")


def _pruned_top_k(queries, vectors, k, metric, digits, schema) -> DataFrame:
    vec = queries.columns[1]
    queries = settle(queries.filter(F.col(vec).isNotNull()).select("query_id", F.col(vec).cast("array<double>").alias(vec)))
    first = queries.select(F.size(vec).alias("width")).limit(1).collect()
    blocks, cells = divide(vectors, first[0].width if first else 0)
    key = schema.fieldNames()[1]
    step = 0.5 * 10.0**-digits

    def ahead(matrix: np.ndarray) -> np.ndarray:
        """The cells of the highest bounds, as many as hold k vectors; the ones that every query meets first."""
        order = np.argsort(-cells.bounds(matrix, metric), axis=1, kind="stable")
        before = np.cumsum(cells.size[order], axis=1) - cells.size[order]
        chosen = np.zeros(order.shape, bool)
        np.put_along_axis(chosen, order, before < k, axis=1)
        return chosen

    unknown = queries.withColumn("least", F.lit(None).cast("double"))
    near = settle(_met(unknown, blocks, cells, lambda batch, matrix: ahead(matrix), k, metric, digits, schema))
    near = settle(top_per_group(near, ["query_id"], [F.desc("score"), F.asc(key)], k).drop("rank"))
    least = near.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("least"))
    open_ = queries.join(least, "query_id", "left").select("query_id", vec, "least")

    def reaching(batch: pa.RecordBatch, matrix: np.ndarray) -> np.ndarray:
        need = batch.column(2).to_numpy(zero_copy_only=False).astype(float)
        bound = cells.bounds(matrix, metric)
        # A little more than the rounding of scores and of the bound.
        spare = 2 * step + 1e-9 * (1 + np.abs(bound))
        return ~(bound + spare < np.where(np.isnan(need), -np.inf, need)[:, None]) & ~ahead(matrix)

    return near.unionByName(_met(open_, blocks, cells, reaching, k, metric, digits, schema))

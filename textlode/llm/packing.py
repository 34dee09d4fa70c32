"""Best-fit packing of documents by patterns of lengths.

The histogram of piece lengths, at most `width` numbers whatever the corpus,
is all that the driver sees.  Patterns of two or three lengths that fill a
sequence are enumerated, their repeat counts fitted to the histogram by
non-negative least squares and rounded down; what is left is packed best fit
decreasing, by counts as well.  Every piece then finds its place from its rank
among the pieces of its length.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textlode.llm.common import once_per_worker, small_batches
from textlode.sources.store import settle

WIDTH = 1024
# Patterns of three lengths that take part in the fit, those of the most pieces first.
TRIPLES = 8_192
ROUNDS = 400
# Token that ends every document, and the special token of the vocabulary.
END = 2
SPECIAL = {"<|endoftext|>": 50256}

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, task int, nth long"


def piece_lengths(total: int, width: int) -> list[int]:
    """Lengths of the pieces of a document: all full, but the first may be shorter."""
    first = (total - 1) % width + 1
    return [first] + [width] * ((total - first) // width)


def tokenised_pieces(
    docs: DataFrame, ranks_path: str, pattern: str, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece of at most `width` tokens; `nth` is its rank among its task's pieces of that length.

    `ranks_path` names the vocabulary as byte-level ranks; the driver reads it and hands it to the tasks.
    """
    import pyarrow as pa
    from pyspark import TaskContext

    small_batches(docs.sparkSession)
    with open(ranks_path, "rb") as file:
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())

    def encoder():
        import tiktoken

        pairs = (line.split() for line in ranks.value.splitlines())
        table = {base64.b64decode(token): int(rank) for token, rank in pairs}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens=SPECIAL)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = once_per_worker(f"encoder-{zlib.crc32(ranks.value)}-{pattern}", encoder).encode_to_numpy
        task, seen, special = TaskContext.get().partitionId(), np.zeros(width + 1, np.int64), set(SPECIAL)
        end = np.array([END], "<u4")
        for batch in batches:
            out: list[list[int]] = [[], [], [], [], [], []]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.concatenate([encode(text.as_py() or "", allowed_special=special).astype("<u4"), end])
                raw, at = ids.tobytes(), 0
                for piece, length in enumerate(piece_lengths(len(ids), width)):
                    crc = zlib.crc32(raw[4 * at : 4 * (at + length)])
                    for column, value in zip(out, (doc_id, piece, at, length, crc, int(seen[length])), strict=True):
                        column.append(value)
                    seen[length] += 1
                    at += length
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
            columns = [pa.array(c, k) for c, k in zip(out, kinds, strict=True)]
            columns.insert(5, pa.array([task] * len(out[0]), pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in PIECES.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, PIECES)


def patterns_for(counts: np.ndarray, width: int, triples: int = TRIPLES) -> np.ndarray:
    """Rows (a, b, c) of lengths with a + b + c = width; a is 0 in patterns of two."""
    here = np.flatnonzero(counts)
    here = here[(here > 0) & (here < width)]
    known = np.zeros(width + 1, bool)
    known[here] = True
    a = here[known[width - here] & (2 * here <= width)]
    pairs = np.stack([np.zeros_like(a), a, width - a], 1)
    grid = np.array(np.meshgrid(here, here, indexing="ij")).reshape(2, -1)
    third = width - grid.sum(0)
    fine = (grid[0] <= grid[1]) & (grid[1] <= third)
    fine[fine] &= known[third[fine]]
    found = np.stack([grid[0][fine], grid[1][fine], third[fine]], 1)
    weight = counts[found].min(1)
    keep = np.argsort(-weight, kind="stable")[:triples]
    return np.concatenate([pairs, found[keep]]).astype(np.int64).reshape(-1, 3)


def fitted_counts(counts: np.ndarray, patterns: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Repeat counts x >= 0 that minimise |A x - counts|², by accelerated projected gradients."""
    if not len(patterns):
        return np.zeros(0)
    slots = patterns > 0
    size = len(counts)

    def usage(x: np.ndarray) -> np.ndarray:
        return np.bincount(patterns[slots], np.repeat(x, slots.sum(1)), size)

    def back(r: np.ndarray) -> np.ndarray:
        return np.where(slots, r[patterns], 0.0).sum(1)

    v = np.ones(len(patterns))
    for _ in range(30):
        v = back(usage(v))
        norm = np.linalg.norm(v)
        v /= norm
    step = 1 / (1.05 * norm)
    x = y = np.zeros(len(patterns))
    t = 1.0
    for _ in range(rounds):
        new = np.maximum(0.0, y - step * back(usage(y) - counts))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


# A group: `count` equal sequences, each holding runs of (length, copies).
Group = tuple[int, tuple[tuple[int, int], ...]]


def _grouped(lengths: list[int]) -> tuple[tuple[int, int], ...]:
    runs: dict[int, int] = {}
    for length in sorted(lengths, reverse=True):
        runs[length] = runs.get(length, 0) + 1
    return tuple(runs.items())


def best_fit(left: np.ndarray, width: int) -> list[Group]:
    """Best fit decreasing over counts: equal sequences are filled together."""
    rooms: dict[int, list[Group]] = {}
    done: list[Group] = []
    for length in range(width, 0, -1):
        todo = int(left[length])
        while todo:
            room = min((r for r in rooms if r >= length), default=0)
            if room:
                count, runs = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room]
                copies = room // length
            else:
                room, count, runs, copies = width, todo, (), width // length
            if not runs:
                count = max(1, todo // copies)
            # As many sequences of the group as get the same number of copies.
            filled = min(count, todo)
            copies = min(copies, todo // filled)
            todo -= filled * copies
            if count > filled:
                rooms.setdefault(room, []).append((count - filled, runs))
            new = (filled, (*runs, (length, copies)))
            rest = room - copies * length
            if rest:
                rooms.setdefault(rest, []).append(new)
            else:
                done.append(new)
    return done + [g for groups in rooms.values() for g in groups]


def pack_plan(counts: np.ndarray, width: int = WIDTH) -> list[Group]:
    """Sequences for `counts[length]` pieces, lengths 1 to width - 1."""
    patterns = patterns_for(counts, width)
    wanted = np.floor(fitted_counts(counts.astype(float), patterns) + 1e-6).astype(np.int64)
    left = counts.astype(np.int64).copy()
    groups: list[Group] = []
    for i in np.argsort(-wanted, kind="stable"):
        if wanted[i] == 0:
            break
        runs = _grouped([int(n) for n in patterns[i] if n])
        repeat = min(int(wanted[i]), *(int(left[n]) // k for n, k in runs))
        if repeat > 0:
            for n, k in runs:
                left[n] -= repeat * k
            groups.append((repeat, runs))
    return groups + best_fit(left, width)


def places(groups: list[Group]) -> np.ndarray:
    """Columns: length, first rank, first sequence, copies per sequence, offset; by length and rank."""
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for count, runs in groups:
        offset = 0
        for length, copies in runs:
            first = used.get(length, 0)
            rows.append((length, first, sequence, copies, offset))
            used[length] = first + count * copies
            offset += length * copies
        sequence += count
    return np.array(sorted(rows), np.int64).reshape(-1, 5).T


def pack_documents(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    width: int = WIDTH,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`, one row per piece.

    A document is its tokens and the end token; only one longer than `width` is
    cut, and only its first piece may be short.  Null and empty texts are the
    end token alone.  Null and repeated ids are documents of their own.
    Full pieces are sequences of their own with negative numbers.
    """
    import pyarrow as pa

    pieces = settle(tokenised_pieces(docs, ranks_path, pattern, width, id_col, text_col))
    short = pieces.filter(F.col("length") < width)
    # One row per task and length, so that ranks need no shuffle of a whole length.
    by_task = settle(short.groupBy("length", "task").agg(F.count("*").alias("n")))
    counts = np.zeros(width + 1, np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[row.length] = row.n
    table = places(pack_plan(counts, width))
    order = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = by_task.select("length", "task", F.coalesce(F.sum("n").over(order), F.lit(0)).alias("first"))
    ranked = short.join(first, ["length", "task"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("first") + F.col("nth")).alias("rank")
    )
    shift = np.int64(44)
    keys = (table[0] << shift) + table[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            at = np.searchsorted(keys, (length << shift) + rank, side="right") - 1
            _, begin, sequence, copies, offset = table[:, at]
            nth = rank - begin
            new = [sequence + nth // copies, offset + nth % copies * length]
            names = [*batch.schema.names[:5], "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *map(pa.array, new)], names)

    schema = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    packed = ranked.mapInArrow(run, schema)
    full = pieces.filter(F.col("length") == width).select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (-1 - (F.col("task").cast("long") * F.lit(1 << 33) + F.col("nth"))).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    return packed.unionByName(full)

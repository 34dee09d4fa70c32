"""Ranked lexical search by presence masks.

Every block of documents keeps postings of the items' terms only.  For an item, the postings of its
terms set one bit each in the documents' masks; documents with one mask form a group, whose score is at
most the sum of its terms' largest contributions in the block.  Groups are evaluated by descending
bound until the next one cannot reach the item's list any more.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlode.llm.common import small_batches
from textlode.llm.shingles import CHUNK, MARKS, pieces, words
from textlode.llm.trigrams import text_buffer
from textlode.operators.joins import top_per_group
from textlode.sources.store import settle

# Documents of a block, and postings from which it is handed on.
DOCS, ENTRIES = 8_192, 500_000
# Terms of the items that are searched for at a time.
TERMS = 500_000
# Documents that the first groups of an item hold at least, for a first bound.
FIRST = 64
_FILTER = 1 << 20


def _cut(buffer: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of pieces of texts, and the text that each belongs to; a text of more than CHUNK bytes is cut between words."""
    cuts, owner = [], []
    for n, (low, high) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
        at = low
        while True:
            cuts.append(at)
            owner.append(n)
            after = at + CHUNK
            while after < high and not (gaps := np.flatnonzero(MARKS[buffer[after : min(high, after + CHUNK)]])).size:
                after += CHUNK
            if after >= high:
                break
            at = after + int(gaps[0])
    return np.array([*cuts, starts[-1]], np.int64), np.array(owner, np.int64)


def _terms(column) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Hashes of the terms of a column of texts, and the number of each one's text, some texts at a time."""
    buffer, starts = text_buffer(column)
    if not len(buffer):
        return
    starts, owner = _cut(buffer, starts)
    for low, high in pieces(starts):
        part = starts[low : high + 1]
        hashes, bounds = words(buffer[part[0] : part[-1]], part - part[0], MARKS)
        yield hashes, np.repeat(owner[low:high], np.diff(bounds))


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """`(item_id, term, n)`: the hashed terms of every item and how often they occur.

    Rows of one id are one item, equal rows counted once.  Rows without an id or a text give none.
    """
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, text in _terms(batch.column(1)):
                ids = batch.column(0).take(pa.array(text))
                yield pa.RecordBatch.from_arrays([ids, pa.array(hashes.view(np.int64))], ["item_id", "term"])

    rows = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    found = rows.dropna().distinct().mapInArrow(run, "item_id long, term long")
    return found.groupBy("item_id", "term").agg(F.count("*").alias("n"))


def _blocks(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """`(block, n_docs, n_terms, terms, counts)` from `docs(doc_id, text)`; terms are places in the ascending vocabulary.

    A block is a pickle of ids, whether they are given, lengths, and the postings (document, term, occurrences) by document.
    """
    import pyarrow as pa

    maybe = np.zeros(_FILTER, bool)
    maybe[(vocabulary % np.uint64(_FILTER)).astype(np.int64)] = True
    shared = docs.sparkSession.sparkContext.broadcast((vocabulary, maybe))
    names = ["block", "n_docs", "n_terms", "terms", "counts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, maybe = shared.value
        held: list[tuple] = []
        docs = entries = 0

        def told() -> pa.RecordBatch:
            ids, given, length = (np.concatenate([h[i] for h in held]) for i in range(3))
            first = np.cumsum([0, *[len(h[0]) for h in held[:-1]]])
            doc = np.concatenate([h[3] + f for h, f in zip(held, first.tolist())])
            term, tf = np.concatenate([h[4] for h in held]), np.concatenate([h[5] for h in held])
            terms, counts = np.unique(term, return_counts=True)
            raw = pickle.dumps((ids, given, length, doc.astype(np.int32), term.astype(np.int32), tf))
            columns = [pa.array([raw], pa.binary()), pa.array([int((length > 0).sum())]), pa.array([int(length.sum())]),
                       pa.array([terms], pa.list_(pa.int32())), pa.array([counts], pa.list_(pa.int64()))]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            length = np.zeros(batch.num_rows, np.int64)
            keys = []
            for hashes, text in _terms(batch.column(1)):
                length += np.bincount(text, minlength=len(length))
                near = np.flatnonzero(maybe[(hashes % np.uint64(_FILTER)).astype(np.int64)])
                place = np.searchsorted(vocabulary, hashes[near])
                place[place == len(vocabulary)] = 0
                hit = vocabulary[place] == hashes[near] if len(vocabulary) else np.zeros(len(near), bool)
                keys.append(text[near[hit]] * len(vocabulary) + place[hit])
            key, tf = np.unique(np.concatenate([*keys, np.empty(0, np.int64)]), return_counts=True)
            ids = batch.column(0)
            held.append((ids.fill_null(0).to_numpy(), ids.is_valid().to_numpy(zero_copy_only=False), length,
                         key // max(1, len(vocabulary)), key % max(1, len(vocabulary)), tf))
            docs, entries = docs + len(length), entries + len(key)
            if docs >= DOCS or entries >= ENTRIES:
                yield told()
                held, docs, entries = [], 0, 0
        if held:
            yield told()

    return docs.mapInArrow(run, "block binary, n_docs long, n_terms long, terms array<int>, counts array<long>")


class Item(NamedTuple):
    name: int
    terms: np.ndarray  # places in the vocabulary
    repeats: np.ndarray


def _groups(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One document of each group of equal masks, and the group of every document; `masks` has 64 bits a row."""
    code = np.zeros(masks.shape[1], np.int64)
    for row in masks:
        _, part = np.unique(row, return_inverse=True)
        _, first, code = np.unique(code * (part.max(initial=0) + 1) + part, return_index=True, return_inverse=True)
    return first, code


class Block:
    """A block of documents with the contribution of every posting."""

    def __init__(self, raw: bytes, weights: np.ndarray, n_docs: int, n_terms: int):
        self.ids, self.given, length, self.doc, self.term, tf = pickle.loads(raw)
        if 75 * int(length.max(initial=0)) * n_docs >= 1 << 63:
            share = np.array([75 * int(n) * n_docs // n_terms for n in length], np.int64)
        else:
            share = 75 * length * n_docs // max(1, n_terms)
        self.value = weights[self.term] * (1_000_000_000 * tf // (1000 * tf + 8 * (25 + share[self.doc])))
        self.first = np.searchsorted(self.doc, np.arange(len(self.ids) + 1))
        order = np.argsort(self.term, kind="stable")
        own, at = np.unique(self.term[order], return_index=True)
        self.lists = dict(zip(own.tolist(), np.split(self.doc[order], at[1:])))
        self.most = dict(zip(own.tolist(), np.maximum.reduceat(self.value[order], at).tolist())) if len(own) else {}

    def scores(self, docs: np.ndarray, repeats: np.ndarray) -> np.ndarray:
        """Scores of some documents; `repeats` by term."""
        size = self.first[docs + 1] - self.first[docs]
        at = np.repeat(self.first[docs] - np.cumsum(size) + size, size) + np.arange(size.sum())
        sums = np.concatenate([[0], np.cumsum(self.value[at] * repeats[self.term[at]])])
        end = np.cumsum(size)
        return sums[end] - sums[end - size]

    def best(self, item: Item, repeats: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the item's k best, and their scores; none below `floor` is missed above it."""
        here = [(t, r) for t, r in zip(item.terms.tolist(), item.repeats.tolist()) if t in self.lists]
        if not here:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        masks = np.zeros((-(-len(here) // 64), len(self.ids)), np.uint64)
        for bit, (term, _) in enumerate(here):
            masks[bit // 64][self.lists[term]] |= np.uint64(1 << bit % 64)
        some = np.flatnonzero(masks.any(0))
        masks = masks[:, some]
        first, group = _groups(masks)
        bound = np.zeros(len(first), np.int64)
        for bit, (term, n) in enumerate(here):
            set_ = masks[bit // 64][first] >> np.uint64(bit % 64) & np.uint64(1)
            bound += set_.astype(np.int64) * (n * self.most[term])
        turn = np.argsort(-bound, kind="stable")
        held = np.cumsum(np.bincount(group, minlength=len(first))[turn])
        found, score = [], []
        low, step = 0, int(np.searchsorted(held, max(k, FIRST))) + 1
        place = np.empty(len(first), np.int64)
        place[turn] = np.arange(len(first))
        rank = place[group]
        by_rank = np.argsort(rank, kind="stable")
        while low < len(turn) and bound[turn[low]] >= max(1, floor):
            # The next groups, but none that can't reach the list.
            high = min(len(turn), low + step, int(np.searchsorted(-bound[turn], -max(1, floor), side="right")))
            span = by_rank[held[low - 1] if low else 0 : held[high - 1]]
            found.append(some[span])
            score.append(self.scores(some[span], repeats))
            all_ = np.concatenate(score)
            if len(all_) >= k:
                floor = max(floor, int(np.partition(all_, len(all_) - k)[len(all_) - k]))
            low, step = high, 2 * step
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        found, score = np.concatenate(found), np.concatenate(score)
        keep = score >= max(1, floor)
        return found[keep], score[keep]


def _searched(blocks: DataFrame, items: list[Item], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """`(item_id, doc_id, score)`: every task's best documents of each item."""
    import pyarrow as pa

    shared = blocks.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = shared.value
        # Per item: whether the id is missing, id, score; best first.
        kept = [(np.empty(0, bool), np.empty(0, np.int64), np.empty(0, np.int64)) for _ in items]
        repeats = np.zeros(len(weights), np.int64)
        for batch in batches:
            for raw in batch.column(0):
                block = Block(raw.as_py(), weights, n_docs, n_terms)
                for n, item in enumerate(items):
                    repeats[item.terms] = item.repeats
                    floor = int(kept[n][2][-1]) if len(kept[n][2]) == k else 0
                    doc, score = block.best(item, repeats, k, floor)
                    repeats[item.terms] = 0
                    if len(doc):
                        new = (~block.given[doc], block.ids[doc], score)
                        none, ids, score = (np.concatenate(pair) for pair in zip(kept[n], new))
                        order = np.lexsort((ids, none, -score))[:k]
                        kept[n] = (none[order], ids[order], score[order])
        for item, (none, ids, score) in zip(items, kept):
            if len(ids):
                columns = [pa.array(np.full(len(ids), item.name)), pa.array(ids, mask=none), pa.array(score)]
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "doc_id", "score"])

    return blocks.select("block").mapInArrow(run, "item_id long, doc_id long, score long")


def search(
    items: DataFrame, docs: DataFrame, k: int = 10, item_col: str = "item_id", id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`(item_id, rank, doc_id, score)`: the k documents with the highest score above 0 for every item.

    Terms are runs of letters and digits of ASCII and of all other characters; only A-Z are lower-cased.  With N documents that
    have a term, L terms in all of them, n in one, df documents with a term and tf occurrences in one, a term adds
    floor(1000 ln((2N + 2) / (2df + 1))) * (10**9 tf div (1000 tf + 8m)), m = 25 + 75nN div L, for every time it is in the item.
    Terms are told apart by 64-bit hashes.  Equal scores go by ascending doc_id, null last.  Rows are documents, so a
    repeated row is ranked each time.  Null, empty and term-less texts count for nothing.  Rows of one item id are
    one item, equal ones counted once; items without id, text or any hit have no row.

    Items are searched TERMS terms at a time, each time over all documents; texts are read once and then only postings.
    """
    spark = docs.sparkSession
    small_batches(spark)
    asked = settle(item_terms(items, item_col, text_col))
    slices = max(1, math.ceil(asked.count() / TERMS))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).dropna(subset="text")
    found = None
    for number in range(slices):
        own = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(slices)) == number).toPandas()
        vocabulary, place = np.unique(own["term"].to_numpy(np.int64).view(np.uint64), return_inverse=True)
        own = own.assign(term=place).sort_values(["item_id", "term"])
        listed = [Item(int(i), g["term"].to_numpy(), g["n"].to_numpy(np.int64)) for i, g in own.groupby("item_id")]
        blocks = settle(_blocks(rows, vocabulary))
        size = blocks.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("n"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("l")).first()
        counts = blocks.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("df"))
        weights = np.zeros(len(vocabulary), np.int64)
        for term, df in counts.toPandas().itertuples(index=False):
            weights[term] = math.floor(1000 * math.log((2 * size.n + 2) / (2 * df + 1)))
        hits = _searched(blocks, listed, weights, size.n, size.l, k)
        found = hits if found is None else found.unionByName(hits)
    best = top_per_group(found, ["item_id"], [F.desc("score"), F.col("doc_id").asc_nulls_last()], k)
    return best.select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")

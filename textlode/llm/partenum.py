"""N-gram Jaccard join by PartEnum signatures.

Sets of similar size form bands.  Within a band, sufficiently similar sets
differ in at most K features.  The feature domain is cut into parts of two
levels; some first-level part then holds few differences, and enumerating
subsets of its second-level parts gives a signature both sets share.  Sets with
a common signature form a group and meet its pivot; since Jaccard distance is a
metric, that settles all pairs of most groups.  What it leaves open meets in
blocks of bounded size.  Of the sets that meet, a bitmap of cell parities rules
out the unlike ones; the rest is compared exactly.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlode.llm.common import fits, mix, small_batches, spread_join
from textlode.llm.components import components
from textlode.llm.shingles import shingle_sets
from textlode.llm.trigrams import text_buffer
from textlode.operators.joins import quoted, unused
from textlode.sources.store import settle

# Ratio of the sizes at a band's ends.
BAND = 1.4
# Signature entries that one bucket is sized for, bytes of text per entry (estimated), and buckets at least.
BUCKET, BYTES_PER_ENTRY, BUCKETS = 2_000_000, 12, 40
# Entries that a task gathers before it hands them on, and texts at most.
FLUSH, FLUSH_TEXTS = 1_000_000, 60_000
# Members of a group that meet in one task.
BLOCK = 1_024
# Partners that a set names, and groups in which it names them, when the open sets first meet; then all do in all.
PARTNERS, GROUPS = 4, 4
# Groups that a set names so that a pair is told once.
NAMED = 8
# Bits of a bitmap at most.
CELLS = 1 << 17
# Entries of one signature in one flush from which they travel as rows of their own.
HOT = 64


class Band(NamedTuple):
    """Sizes low to high - 1 differ in at most `differ` features when similar."""

    number: int
    low: int
    high: int
    differ: int
    first: int  # first-level parts
    second: int  # second-level parts of each
    drop: int  # second-level parts that a subset leaves out
    needed: int  # first-level parts that are sure to share a signature
    subsets: np.ndarray  # second-level parts of each subset
    edges: np.ndarray  # where the parts begin in the domain of 64-bit hashes
    salts: np.ndarray  # one per first-level part and subset


def _band(number: int, low: int, num: int, den: int) -> Band:
    high = max(low + 1, int(low * BAND) + 1) if low > 1 else (num + den) // (2 * (den - num)) + 1
    differ = 2 * (high - 1) * (den - num) // (den + num)
    if differ == 0:
        first, second, drop, needed = 1, 1, 0, 1
    elif differ <= 3:
        first, second, drop, needed = 1, differ + 3, differ, 1
    else:
        # At most differ // 2 first-level parts hold two differences or more.
        needed = 2 if differ < 20 else 3
        first, second, drop = differ // 2 + needed, 3, 1
    subsets = np.array(list(itertools.combinations(range(second), second - drop)))
    cells = first * second
    edges = np.array([(i << 64) // cells for i in range(1, cells)], np.uint64)
    salts = mix(np.arange(1, first * len(subsets) + 1, dtype=np.uint64) + np.uint64(number << 32))
    return Band(number, low, high, differ, first, second, drop, needed, subsets, edges, salts)


class Bands:
    """The bands for a similarity of num / den, made as sizes ask for them."""

    def __init__(self, num: int, den: int):
        self.num, self.den, self.made = num, den, [_band(0, 1, num, den)]

    def of(self, size: int) -> list[Band]:
        """The size's own band, and the next one if sets there can be similar."""
        while self.made[-1].high <= size:
            self.made.append(_band(len(self.made), self.made[-1].high, self.num, self.den))
        at = len(self.made) - 1
        while self.made[at].low > size:
            at -= 1
        own = self.made[at]
        if size * self.den < own.high * self.num:
            return [own]
        if at + 1 == len(self.made):
            self.made.append(_band(at + 1, own.high, self.num, self.den))
        return [own, self.made[at + 1]]


def signatures(features: np.ndarray, bands: Bands) -> np.ndarray:
    """Signatures of one set of ascending 64-bit features; none for the empty set.

    A signature is the sum of the scrambled features in its parts.  Those of
    parts without features would be common to unlike sets; a set gives them
    only if so many of its first-level parts have one that a similar set might
    share no other.
    """
    if not len(features):
        return np.empty(0, np.uint64)
    sums = np.zeros(len(features) + 1, np.uint64)
    np.cumsum(mix(features.copy()), out=sums[1:])
    out = []
    for band in bands.of(len(features)):
        at = np.concatenate([[0], np.searchsorted(features, band.edges), [len(features)]])
        count = np.diff(at).reshape(band.first, band.second)
        value = (sums[at[1:]] - sums[at[:-1]]).reshape(band.first, band.second)
        content = value[:, band.subsets].sum(2, dtype=np.uint64)
        some = count[:, band.subsets].sum(2) > 0
        if (~some).any(1).sum() >= band.needed:
            some[:] = True
        out.append(mix(content + band.salts.reshape(content.shape))[some])
    return np.concatenate(out)


def set_key(features: np.ndarray) -> int | None:
    """64-bit name of a set; None for the empty one."""
    if not len(features):
        return None
    total = mix(features.copy()).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(features))
    return int(mix(total).view(np.int64)[0])


def parities(features: np.ndarray) -> np.ndarray:
    """Whether a cell holds an odd number of features, as bits of 64-bit numbers; about two cells per feature up to CELLS.

    A feature that only one of two sets has changes one parity: the bitmaps
    differ in at most as many bits as the sets differ in features.
    """
    cells = min(CELLS, 1 << max(6, (3 * len(features) // 2).bit_length()))
    odd = np.bincount((features & np.uint64(cells - 1)).astype(np.int64), minlength=cells) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def _differing(left: Column, right: Column) -> Column:
    """Bits in which two bitmaps differ; one of twice the size is folded first."""

    def folded(own: Column, other: Column) -> Column:
        half = F.size(other)
        both = F.zip_with(F.slice(own, F.lit(1), half), F.slice(own, half + 1, half), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(own) > half, both).otherwise(own)

    bits = F.zip_with(folded(left, right), folded(right, left), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    return F.aggregate(bits, F.lit(0), lambda total, n: total + n)


def _gathered(docs: DataFrame, k: int, num: int, den: int, buckets: int) -> DataFrame:
    """Blobs of signatures by bucket, and of documents, from `docs(doc_id, copy, text)`.

    An entry of a blob is 48 bits of the signature and 16 of the text's place in
    the blob's tables of set names and sizes.  A set that the task has met
    before gives no entries again.
    """
    import pyarrow as pa

    names = ["bucket", "kind", "blob", "sets", "sizes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands, met = Bands(num, den), set()
        entries: list[np.ndarray] = []
        keys: list[int] = []
        sizes: list[int] = []
        gathered = flushes = 0

        def rows(found: list[tuple]) -> pa.RecordBatch:
            kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), kinds)], names)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal entries, keys, sizes, gathered, flushes
            if not keys:
                return
            place = np.repeat(np.arange(len(keys)), [len(e) for e in entries]).astype(np.uint64)
            whole = np.concatenate(entries)
            order = np.argsort(whole, kind="stable")
            whole, place = whole[order], place[order]
            edge = np.flatnonzero(np.concatenate([[True], whole[1:] != whole[:-1]]))
            run_length = np.diff(np.append(edge, len(whole)))
            hot = np.repeat(run_length > HOT, run_length)
            key, size = np.array(keys, np.int64), np.array(sizes, np.int32)
            if hot.any():
                # One row per part of a hot group; its signature is told to the bucket as well.
                at = np.flatnonzero(hot)
                for low in range(0, len(at), 100_000):
                    own = at[low : low + 100_000]
                    here = place[own].astype(np.int64)
                    bucket = (flushes * 7919 + low // 100_000 + int(key[0] & 1023)) % buckets
                    yield rows([(bucket, 1, whole[own].tobytes(), key[here].tobytes(), size[here].tobytes())])
            mine = (whole % np.uint64(buckets)).astype(np.int64)
            # Signatures are ascending, so a bucket's entries stay so.
            by_bucket = np.argsort(mine, kind="stable")
            cuts = np.searchsorted(mine[by_bucket], np.arange(buckets + 1))
            for bucket in range(buckets):
                own = by_bucket[cuts[bucket] : cuts[bucket + 1]]
                told = np.unique(whole[own][hot[own]])
                if len(told):
                    yield rows([(bucket, 2, told.tobytes(), b"", b"")])
                own = own[~hot[own]]
                if not len(own):
                    continue
                there, number = np.unique(place[own].astype(np.int64), return_inverse=True)
                packed = (whole[own] & ~np.uint64(0xFFFF)) | number.astype(np.uint64)
                yield rows([(bucket, 0, packed.tobytes(), key[there].tobytes(), size[there].tobytes())])
            entries, keys, sizes, gathered = [], [], [], 0
            flushes += 1

        for batch in batches:
            buffer, starts = text_buffer(batch.column(2))
            own_keys, own_sizes, bitmaps = [], [], []
            for features in shingle_sets(buffer, starts, k):
                key = set_key(features)
                own_keys.append(key)
                own_sizes.append(len(features))
                bitmaps.append(parities(features) if key is not None else None)
                if key is not None and key not in met:
                    met.add(key)
                    found = signatures(features, bands)
                    entries.append(found)
                    keys.append(key)
                    sizes.append(len(features))
                    gathered += len(found)
                    if gathered >= FLUSH or len(keys) >= FLUSH_TEXTS:
                        yield from flush()
            if own_keys:
                ids = batch.column(0).to_pylist()
                table = pa.table([pa.array(ids, pa.int64()), batch.column(1), pa.array(own_keys, pa.int64()),
                                  pa.array(own_sizes, pa.int64()), pa.array(bitmaps, pa.list_(pa.int64()))],
                                 ["doc_id", "copy", "node", "n", "bitmap"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, table.schema) as writer:
                    writer.write_table(table)
                bucket = (sum(own_sizes) + len(own_sizes)) % buckets
                yield rows([(bucket, 3, sink.getvalue().to_pybytes(), b"", b"")])
        yield from flush()

    return docs.mapInArrow(run, "bucket int, kind int, blob binary, sets binary, sizes binary")


def _matched(gathered: DataFrame, buckets: int) -> DataFrame:
    """`(kind, grp, node, n, doc_id, copy, bitmap)`: kind 0 are members of groups, kind 1 the documents.

    Each bucket is sorted by signature.  Equal groups found by many signatures are told once.
    """
    import pyarrow as pa

    schema = "kind int, grp long, node long, n long, doc_id long, copy long, bitmap array<long>"
    names = ["kind", "grp", "node", "n", "doc_id", "copy", "bitmap"]

    def members(group, node, n) -> pa.RecordBatch:
        arrays = [pa.array(np.zeros(len(group), np.int32)), pa.array(group.view(np.int64)), pa.array(node), pa.array(n)]
        arrays += [*[pa.nulls(len(group), pa.int64())] * 2, pa.nulls(len(group), pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays(arrays, names)

    def matches(blobs: list[tuple], told: list[np.ndarray]) -> pa.RecordBatch | None:
        if not blobs:
            return None
        sig, node, n = [], [], []
        for blob, sets, sizes in blobs:
            packed = np.frombuffer(blob, np.uint64)
            place = (packed & np.uint64(0xFFFF)).astype(np.int64)
            sig.append(packed & ~np.uint64(0xFFFF))
            node.append(np.frombuffer(sets, np.int64)[place])
            n.append(np.frombuffer(sizes, np.int32)[place])
        sig, node, n = np.concatenate(sig), np.concatenate(node), np.concatenate(n).astype(np.int64)
        hot = np.unique(np.concatenate(told)) if told else np.empty(0, np.uint64)
        hot_short = hot & ~np.uint64(0xFFFF)
        order = np.argsort(sig, kind="stable")
        sig = sig[order]
        alike = np.zeros(len(sig), bool)
        alike[1:] = sig[1:] == sig[:-1]
        alike[:-1] |= alike[1:].copy()
        if len(hot):
            alike |= np.isin(sig, hot_short)
        order, sig = order[alike], sig[alike]
        node, n = node[order], n[order]
        order = np.lexsort((node, sig))
        sig, node, n = sig[order], node[order], n[order]
        keep = np.ones(len(sig), bool)
        keep[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
        sig, node, n = sig[keep], node[keep], n[keep]
        edge = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]])) if len(sig) else np.empty(0, np.int64)
        length = np.diff(np.append(edge, len(sig)))
        sums = np.zeros(len(sig) + 1, np.uint64)
        np.cumsum(mix(node.copy().view(np.uint64)), out=sums[1:])
        name = mix(sums[edge + length] - sums[edge] + length.astype(np.uint64))
        if len(hot):
            # A hot signature keeps its own name: the rest of its group travels apart.
            at = np.searchsorted(hot_short, sig[edge])
            at[at == len(hot)] = 0
            is_hot = hot_short[at] == sig[edge]
            name[is_hot] = mix(hot[at][is_hot].copy())
        else:
            is_hot = np.zeros(len(edge), bool)
        _, once = np.unique(name, return_index=True)
        take = np.zeros(len(edge), bool)
        take[once] = True
        take &= (length > 1) | is_hot
        wide = np.repeat(take, length)
        return members(np.repeat(name, length)[wide], node[wide], n[wide])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, blobs, told = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["bucket"] != bucket:
                    if (out := matches(blobs, told)) is not None:
                        yield out
                    bucket, blobs, told = row["bucket"], [], []
                if row["kind"] == 0:
                    blobs.append((row["blob"], row["sets"], row["sizes"]))
                elif row["kind"] == 1:
                    name = mix(np.frombuffer(row["blob"], np.uint64).copy())
                    sizes = np.frombuffer(row["sizes"], np.int32).astype(np.int64)
                    yield members(name, np.frombuffer(row["sets"], np.int64), sizes)
                elif row["kind"] == 2:
                    told.append(np.frombuffer(row["blob"], np.uint64))
                else:
                    table = pa.ipc.open_stream(row["blob"]).read_all()
                    for part in table.to_batches():
                        size = part.num_rows
                        arrays = [pa.array(np.ones(size, np.int32)), pa.nulls(size, pa.int64()), part.column(2)]
                        arrays += [part.column(3), part.column(0), part.column(1), part.column(4)]
                        yield pa.RecordBatch.from_arrays(arrays, names)
        if (out := matches(blobs, told)) is not None:
            yield out

    # More partitions than buckets, so that few hold several.
    return gathered.repartition(4 * buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def _sets(texts: DataFrame, wanted: DataFrame, k: int) -> DataFrame:
    """`(node, features)` of the wanted sets, from `texts(copy, text)` and `wanted(copy)`."""
    import pyarrow as pa

    wanted = settle(wanted)
    small = fits(wanted, F.lit(8), 1 << 20)
    chosen = texts.join(F.broadcast(wanted) if small else wanted, "copy", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = set()
        for batch in batches:
            buffer, starts = text_buffer(batch.column(1))
            keys, found, gathered = [], [], 0
            for features in shingle_sets(buffer, starts, k):
                key = set_key(features)
                if key in met or key is None:
                    continue
                met.add(key)
                keys.append(key)
                found.append(features.view(np.int64))
                gathered += len(features)
                if gathered > 500_000:
                    yield packed(keys, found)
                    keys, found, gathered = [], [], 0
            if keys:
                yield packed(keys, found)

    def packed(keys: list[int], found: list[np.ndarray]) -> pa.RecordBatch:
        offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), lists], ["node", "features"])

    rows = chosen.select("copy", "text").mapInArrow(run, "node long, features array<long>")
    # Copies of a text may lie in several tasks.
    return rows.groupBy("node").agg(F.first("features").alias("features"))


def _compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`(a, b, common, total)` with the exact sizes of intersection and union."""
    left = sets.select(F.col("node").alias("a"), F.col("features").alias("fa"))
    right = sets.select(F.col("node").alias("b"), F.col("features").alias("fb"))
    common = F.size(F.array_intersect("fa", "fb")).cast("long")
    met = pairs.join(right, "b").join(left, "a").select("a", "b", F.size("fa").alias("na"), F.size("fb").alias("nb"), common.alias("common"))
    return met.select("a", "b", "common", (F.col("na") + F.col("nb") - F.col("common")).cast("long").alias("total"))


def _likely_in_blocks(
    members: DataFrame, bitmaps: DataFrame, num: int, den: int, most: int | None = None
) -> DataFrame:
    """`(a, b)`: pairs of a group with different roots that their bitmaps do not rule out.

    With `most`, a member names only so many of its likeliest partners.

    `members(grp, node, n, root)`, `bitmaps(node, bitmap)`.  A group is cut
    into blocks of about BLOCK members; any two blocks meet in one task, which
    hands on only the pairs that are left.  Of two sets that have a group among
    the NAMED first of both, only the first such group tells.  Bitmaps join
    last, so that they move once.
    """
    import pyarrow as pa

    blocks = members.groupBy("grp").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = (
        members.join(blocks, "grp")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("grp", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "n", "root")
        .join(_first_groups(members, NAMED), "node")
        .join(bitmaps.select("node", "bitmap"), "node")
        .select("grp", "low", "high", "own", "node", "n", "root", "few", "bitmap")
    )

    none = np.iinfo(np.int64).max

    def pairs(parts: list[tuple], group: int, across: bool) -> tuple[list, list]:
        """Pairs among the members of one block, or across two."""
        own, node, n, root = (np.concatenate([p[c] for p in parts]) for c in range(4))
        bits = [b for p in parts for b in p[4]]
        first = np.full((len(bits), NAMED), none)
        for i, few in enumerate(f for p in parts for f in p[5]):
            first[i, : len(few)] = few
        width = min(map(len, bits))
        matrix = np.stack([b if len(b) == width else np.bitwise_xor.reduce(b.reshape(-1, width), axis=0) for b in bits])
        left, right = [], []
        for i in range(len(bits) - 1):
            both, smaller, larger = n[i] + n[i + 1 :], np.minimum(n[i], n[i + 1 :]), np.maximum(n[i], n[i + 1 :])
            fits = (root[i + 1 :] != root[i]) & (smaller * den >= larger * num)
            if across:
                fits &= own[i + 1 :] != own[i]
            at = np.flatnonzero(fits)
            unlike = np.bitwise_count(matrix[i + 1 + at] ^ matrix[i]).sum(1, dtype=np.int64)
            hit = (both[at] - unlike) * den >= (both[at] + unlike) * num
            at = at[hit] + i + 1
            if most is not None and len(at) > most:
                at = at[np.argsort(unlike[hit], kind="stable")[:most]]
            if most is None and len(at):
                shared = (first[at][:, :, None] == first[i][None, None, :]).any(2) & (first[at] != none)
                teller = np.where(shared, first[at], none).min(1)
                at = at[(teller == none) | (teller == group)]
            if len(at):
                left.append(np.minimum(node[i], node[at]))
                right.append(np.maximum(node[i], node[at]))
        return left, right

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, left, right = None, [], [], []

        def settle_group() -> None:
            if sum(len(p[0]) for p in parts) > 1:
                for out, found in zip((left, right), pairs(parts, key[0], key[1] != key[2])):
                    out += found

        def told() -> Iterator[pa.RecordBatch]:
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])
                left.clear()
                right.clear()

        for batch in batches:
            if not batch.num_rows:
                continue
            names, rest = [c.to_numpy() for c in batch.columns[:3]], [c.to_numpy() for c in batch.columns[3:7]]
            few_at, few = batch.column(7).offsets.to_numpy(), batch.column(7).values.to_numpy()
            offsets, flat = batch.column(8).offsets.to_numpy(), batch.column(8).values.to_numpy().view(np.uint64)
            new = np.zeros(batch.num_rows, bool)
            for c in names:
                new[1:] |= c[1:] != c[:-1]
            cuts = [0, *np.flatnonzero(new).tolist(), batch.num_rows]
            for low, high in zip(cuts, cuts[1:]):
                this = tuple(int(c[low]) for c in names)
                if this != key:
                    settle_group()
                    key, parts = this, []
                bits = [flat[offsets[i] : offsets[i + 1]] for i in range(low, high)]
                named = [few[few_at[i] : few_at[i + 1]] for i in range(low, high)]
                parts.append((*(c[low:high] for c in rest), bits, named))
            yield from told()
        settle_group()
        yield from told()

    ordered = dealt.repartition("grp", "low", "high").sortWithinPartitions("grp", "low", "high")
    return ordered.mapInArrow(run, "a long, b long").distinct()


def linked_sets(
    members: DataFrame, bitmaps: DataFrame, sets_of: Callable[[DataFrame], DataFrame], num: int, den: int
) -> DataFrame:
    """`(a, b)`: links between sets, enough of them to connect all sets that similar pairs connect.

    `members(grp, node, n)`, `bitmaps(node, bitmap)`; `sets_of` gives
    `(node, features)` for a table of nodes.  First every member meets the
    pivot of its group; those similar to it form its star.  By the triangle
    inequality a star's members have no link to a set farther than twice the
    allowed distance from the pivot.  The sets that this leaves open meet each
    other unless links connect them already.
    """
    near = 2 * num - den  # similarity (in 1 / den) at twice the allowed distance
    fine = F.col("common") * den >= F.col("total") * num
    both, unlike = F.col("na") + F.col("nb"), F.col("unlike")
    pivots = settle(members.groupBy("grp").agg(F.min(F.struct("node", "n")).alias("p")).select(
        "grp", F.col("p.node").alias("pivot"), F.col("p.n").alias("pn")
    ))
    met = settle(
        members.join(pivots, "grp")
        .filter((F.col("node") != F.col("pivot")) & (F.least("n", "pn") * den >= F.greatest("n", "pn") * near))
        .select(F.col("pivot").alias("a"), F.col("node").alias("b"), F.col("pn").alias("na"), F.col("n").alias("nb"))
        .distinct()
        .join(bitmaps.select(F.col("node").alias("a"), F.col("bitmap").alias("left")), "a")
        .join(bitmaps.select(F.col("node").alias("b"), F.col("bitmap").alias("right")), "b")
        .withColumn("unlike", _differing(F.col("left"), F.col("right")))
        .filter((both - unlike) * den >= (both + unlike) * near)
        .select("a", "b", ((both - unlike) * den >= (both + unlike) * num).alias("likely"))
    )
    likely = met.filter("likely").select("a", "b")
    needed = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    compared = settle(_compared(likely, settle(sets_of(needed))))
    links = compared.filter(fine).select("a", "b")
    roots = settle(components(links))

    rooted = settle(
        members.join(roots, "node", "left").select("grp", "node", "n", F.coalesce("root", "node").alias("root"))
    )
    rest = _several_roots(rooted)
    # A pair that only its bitmaps tell of counts as close.
    known = met.join(compared, ["a", "b"], "left").select(
        F.col("a").alias("pivot"),
        F.col("b").alias("node"),
        F.coalesce(fine, F.lit(False)).alias("linked"),
        F.coalesce(F.col("common") * den >= F.col("total") * near, F.lit(True)).alias("near"),
    )
    star = rest.join(pivots.select("grp", "pivot"), "grp").join(known, ["pivot", "node"])
    proots = roots.select(F.col("node").alias("pivot"), F.col("root").alias("proot"))
    star = settle(
        star.join(proots, "pivot", "left").select(
            "grp", "node", "linked", (F.col("near") & (F.col("root") != F.coalesce("proot", "pivot"))).alias("close")
        )
    )
    unsafe = star.filter("close").select("grp").distinct()
    done = star.filter("linked").join(unsafe, "grp", "left_anti").select("grp", "node")
    done = done.union(pivots.select("grp", "pivot"))
    open_ = settle(_several_roots(rest.join(done, ["grp", "node"], "left_anti")))
    # The likeliest partners first: they connect most of what is alike, so that
    # of a large group of near copies not all pairs have to be compared.
    for most in (PARTNERS, None):
        chosen = open_ if most is None else _few_groups(open_)
        likely = _likely_in_blocks(chosen, bitmaps, num, den, most)
        likely = settle(likely.join(compared.select("a", "b"), ["a", "b"], "left_anti"))
        needed = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
        new = settle(_compared(likely, settle(sets_of(needed))))
        compared = compared.union(new)
        found = new.filter(fine).select("a", "b")
        links = links.union(found)
        if most is not None:
            open_ = settle(_several_roots(_rerooted(open_, found)))
    return links


def _first_groups(members: DataFrame, most: int) -> DataFrame:
    """`(node, few)`: the smallest names of the groups of every set."""
    return members.groupBy("node").agg(F.slice(F.sort_array(F.collect_set("grp")), 1, most).alias("few"))


def _few_groups(members: DataFrame) -> DataFrame:
    """Of every set's groups the GROUPS with the smallest names, which sets that share most groups share."""
    few = _first_groups(members, GROUPS)
    return members.join(few.select("node", F.explode("few").alias("grp")), ["grp", "node"], "left_semi")


def _several_roots(members: DataFrame) -> DataFrame:
    """Members of the groups that links do not connect as a whole."""
    mixed = members.groupBy("grp").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    return members.join(mixed.select("grp"), "grp", "left_semi")


def _rerooted(members: DataFrame, links: DataFrame) -> DataFrame:
    """Members with the roots that further links give."""
    roots = members.select("node", "root").distinct()
    left = links.join(roots.select(F.col("node").alias("a"), F.col("root").alias("x")), "a")
    both = left.join(roots.select(F.col("node").alias("b"), F.col("root").alias("y")), "b")
    new = components(both.select(F.col("x").alias("a"), F.col("y").alias("b")))
    found = members.join(new.select(F.col("node").alias("root"), F.col("root").alias("_new")), "root", "left")
    return found.select("grp", "node", "n", F.coalesce("_new", "root").alias("root"))


def _grouped(docs: DataFrame, k: int, num: int, den: int, id_col: str, text_col: str) -> DataFrame:
    """`(doc_id, copy, n, node, root)` per row: text, set of shingles and linked group, each by a 64-bit name."""
    small_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("copy"), text.alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    buckets = max(BUCKETS, -(-size // (BYTES_PER_ENTRY * BUCKET)))
    matched = settle(_matched(_gathered(source, k, num, den, buckets), buckets))
    rows = matched.filter("kind = 1").select("doc_id", "copy", "node", "n")
    members = settle(matched.filter("kind = 0").select("grp", "node", "n").distinct())
    nodes = members.select("node").distinct()
    first = matched.filter("kind = 1 and node is not null").groupBy("node")
    known = settle(
        first.agg(F.min("copy").alias("copy"), F.first("bitmap").alias("bitmap")).join(nodes, "node", "left_semi")
    )

    def sets_of(wanted: DataFrame) -> DataFrame:
        return _sets(source.select("copy", "text"), known.join(wanted, "node").select("copy").distinct(), k)

    links = settle(linked_sets(members, known.select("node", "bitmap"), sets_of, num, den))
    roots = components(links)
    # Rows of one set may be a third of all; the sets that are linked are few.
    linked = settle(roots)
    small = fits(linked, F.lit(16))
    return spread_join(rows, linked, "node", "left", small).withColumn("root", F.coalesce("root", "node"))


def jaccard_components(
    docs: DataFrame, k: int = 4, num: int = 85, den: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`(doc_id, n_shingles, component_id)`, one row per row of `docs`.

    Sets of `k`-word shingles link when den * |A ∩ B| >= num * |A ∪ B|;
    component_id is the smallest doc_id that links reach.  Null, empty and
    blank texts have no shingles and are linked with nothing: their own id.
    Null ids are kept; they name a component only if it holds no other.
    Repeated rows are linked like any equal texts.
    """
    rows = settle(_grouped(docs, k, num, den, id_col, text_col))
    least = rows.filter("root is not null").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("c"))
    # A group of one names itself, so that only the others are looked up.
    several = settle(least.filter("c > 1").select("root", "component_id"))
    named = spread_join(rows, several, "root", "left", fits(several, F.lit(16)))
    return named.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def one_per_group(
    docs: DataFrame, k: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`docs` with one row of each linked group: that of the smallest id, null last.

    Rows without words all stay, for they are linked with nothing.  Of
    repeated rows one stays.  All columns stay.
    """
    rows = settle(_grouped(docs, k, num, den, id_col, text_col))
    key = F.xxhash64("doc_id", "copy")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "copy")
    grouped = rows.filter("root is not null").select("root", key.alias("_key"), order.alias("order"))
    firsts = grouped.groupBy("root").agg(F.min("order").alias("first"), F.count("*").alias("c")).filter("c > 1")
    firsts = settle(firsts.select("root", F.xxhash64("first.doc_id", "first.copy").alias("first")))
    several = spread_join(grouped.drop("order"), firsts, "root", "inner", fits(firsts, F.lit(16)))
    several = settle(several.groupBy("root", "first", "_key").agg(F.count("*").alias("c")))
    losers = several.filter(F.col("_key") != F.col("first")).select("_key").distinct()
    again = settle(several.filter((F.col("_key") == F.col("first")) & (F.col("c") > 1)).select("_key"))
    own = unused("_key", *docs.columns)
    text = F.coalesce(quoted(text_col), F.lit(""))
    named = docs.withColumn(own, F.xxhash64(quoted(id_col).cast("long"), F.xxhash64(text)))
    losers = settle(losers.withColumnRenamed("_key", own))
    again = again.withColumnRenamed("_key", own)
    kept = spread_join(named, losers, own, "left_anti", fits(losers, F.lit(8)))
    if not again.isEmpty():
        # Rows alike in id and text.
        small = fits(again, F.lit(8))
        alike = spread_join(kept, again, own, "left_semi", small).dropDuplicates([own])
        kept = spread_join(kept, again, own, "left_anti", small).unionByName(alike)
    return kept.select(*map(quoted, docs.columns))

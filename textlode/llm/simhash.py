"""Near duplicates by SimHash fingerprints and covering locality-sensitive hashing.

The 64 places of a fingerprint get vectors of radius + 1 bits, evenly dealt; every vector v but zero
gives a mask: the places whose vector has an odd product with v.  At most radius places in which two
fingerprints differ span no whole space, so some v is orthogonal to them all, and the pair agrees
under its mask: it meets in that table, always.  A bucket that is too large to compare is dealt out
again, by the same masks over the places that its members have not agreed in yet.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlode.llm.common import fits, small_batches, spread_join
from textlode.llm.components import components
from textlode.operators.joins import lookup_join
from textlode.sources.store import settle

BITS = 64
# Bytes of a text that are cut into words at a time.
PIECE = 1 << 20
# Fingerprints of a bucket that are compared with each other; larger buckets are dealt out again.
BUCKET = 1_024
# With so few places left, members are gathered in any case.
FEW = 10
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


def _shingle_bits(words: list[bytes], k: int, seed: int) -> np.ndarray:
    """How many of the `k`-word shingles' hashes have each bit set, the highest bit first."""
    import xxhash

    joined, digest = b" ".join(words), xxhash.xxh64_digest
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    begin = (end - size)[: len(words) - k + 1].tolist()
    raw = b"".join([digest(joined[a:b], seed) for a, b in zip(begin, end[k - 1 :].tolist())])
    total = np.zeros(BITS, np.int64)
    for low in range(0, len(raw), PIECE):
        bits = np.unpackbits(np.frombuffer(raw[low : low + PIECE], np.uint8)).reshape(-1, BITS)
        total += bits.sum(0, dtype=np.int64)
    return total


def fingerprint(raw: bytes, k: int = 3, seed: int = 42) -> bytes:
    """Eight bytes, the highest first: bits that over half of the shingles' XXH64 hashes have set."""
    total, n, tail, at = np.zeros(BITS, np.int64), 0, [], 0
    while at < len(raw):
        # A piece ends before white space, so that no word is cut; the last words begin the next piece's shingles.
        blank = _BLANK.search(raw, at + PIECE)
        end = blank.start() if blank else len(raw)
        words = tail + raw[at:end].lower().split()
        if len(words) >= k:
            total += _shingle_bits(words, k, seed)
            n += len(words) - k + 1
            tail = words[len(words) - k + 1 :]
        else:
            tail = words
        at = end
    if n == 0 and tail:
        total, n = _shingle_bits(tail, len(tail), seed), 1
    return np.packbits(2 * total > n).tobytes()


def simhash(docs: DataFrame, k: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`(doc_id, fp)`, one row per row of `docs`; fp is the fingerprint as a signed 64-bit number.

    A-Z are lower-cased and words split at space and U+0009 to U+000D; repeated shingles count each time.  Fewer words than `k`
    are one shingle.  Null, empty and blank texts have fingerprint zero.  Null ids are kept.
    """
    import pyarrow as pa

    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.large_binary())
            made = b"".join(fingerprint(raw.as_py(), k, seed) for raw in texts)
            numbers = np.frombuffer(made, ">i8").astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(numbers)], ["doc_id", "fp"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def covering_masks(radius: int, fixed: int = 0) -> list[int]:
    """Masks of places, all with those of `fixed`: fingerprints that agree in `fixed` and differ in at most `radius` places agree in one of them."""
    free = [b for b in range(BITS) if not fixed >> b & 1]
    # Vectors of one bit come first, so that more than `radius` free places give no mask without any of them.
    vectors = sorted(range(1, 1 << (radius + 1)), key=int.bit_count)
    masks = set()
    for v in vectors:
        odd = (b for i, b in enumerate(free) if (vectors[i % len(vectors)] & v).bit_count() & 1)
        masks.add(fixed | sum(1 << b for b in odd))
    return sorted(masks)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _bucket_links(grouped: DataFrame, radius: int) -> DataFrame:
    """`(a, b)` from `grouped(fps)`: every member with the first of those that similar pairs of its bucket connect it to."""
    import pyarrow as pa

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            for row in batch.column(0):
                fps = np.sort(row.values.to_numpy())
                # Every member is visited from a linked one, the rest of the bucket shrinking.
                rest = np.arange(len(fps))
                while len(rest) > 1:
                    root, rest = rest[0], rest[1:]
                    front = [root]
                    while front and len(rest):
                        near = np.bitwise_count((fps[rest] ^ fps[front.pop()]).view(np.uint64)) <= radius
                        found, rest = rest[near], rest[~near]
                        front += found.tolist()
                        left.append(np.full(len(found), fps[root]))
                        right.append(fps[found])
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(left)), pa.array(np.concatenate(right))], ["a", "b"])

    return grouped.mapInArrow(run, "a long, b long")


def near_links(fps: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """`(a, b)`: links between different fingerprints of `fps(fp)`, enough to connect all that pairs within `radius` bits connect.

    Buckets of two are told by their smallest and largest member; the members of larger ones are
    gathered up to `bucket`, and beyond that dealt out again.  Every time that fixes about half of the places left, so that
    two or three times are enough whatever the bucket: at most 2 ** FEW different fingerprints differ in FEW places only.
    """
    spark = fps.sparkSession
    masks = covering_masks(radius)
    rows = fps.select("fp", F.explode(F.array(*[F.lit(_signed(m)).cast("long") for m in masks])).alias("fixed"))
    links = None
    while True:
        keyed = rows.select("fixed", F.col("fp").bitwiseAND(F.col("fixed")).alias("value"), "fp")
        stats = keyed.groupBy("fixed", "value").agg(F.count("*").alias("n"), F.min("fp").alias("a"), F.max("fp").alias("b"))
        stats = settle(stats.filter("n > 1"))
        pairs = stats.filter((F.col("n") == 2) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)).select("a", "b")
        members = settle(lookup_join(keyed, stats.filter("n > 2").select("fixed", "value", "n"), ["fixed", "value"]))
        # n counts different fingerprints.
        small = (F.col("n") <= bucket) | (F.bit_count("fixed") >= BITS - max(FEW, radius))
        grouped = members.filter(small).groupBy("fixed", "value").agg(F.collect_list("fp").alias("fps"))
        found = pairs.unionByName(_bucket_links(grouped.select("fps"), radius))
        links = found if links is None else links.unionByName(found)
        hot = members.filter(~small)
        # At most as many masks as there are tables of the level before.
        fixed = [r.fixed for r in hot.select("fixed").distinct().collect()]
        if not fixed:
            return links
        after = [(m, _signed(n)) for m in fixed for n in covering_masks(radius, m & (1 << 64) - 1)]
        masks = F.broadcast(spark.createDataFrame(after, "fixed long, next long"))
        rows = hot.join(masks, "fixed").select("fp", F.col("next").alias("fixed")).distinct()


def near_duplicates(
    docs: DataFrame, k: int = 3, radius: int = 3, seed: int = 42, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`(doc_id, fingerprint, component_id)`, one row per row of `docs`.

    Fingerprints link at `radius` or fewer differing bits; component_id is the smallest doc_id that
    links reach.  Texts without words have fingerprint zero and are linked like any other.  Null ids
    are kept; they name a component only if it holds no other.  Repeated rows are linked like any equal texts.
    """
    rows = settle(simhash(docs, k, seed, id_col, text_col))
    classes = settle(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("c")))
    linked = components(settle(near_links(classes.select("fp"), radius).distinct()))
    linked = settle(classes.join(linked.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("c").alias("all"))
    # A component of one row names itself, so that only the others are looked up.
    several = least.filter(F.col("all") > 1).select("root", "component_id")
    named = settle(linked.select("fp", "root").join(several, "root").select("fp", "component_id"))
    joined = spread_join(rows, named, "fp", "left", fits(named, F.lit(16)))
    return joined.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )

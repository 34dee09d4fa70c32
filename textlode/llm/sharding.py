"""Shards of nearly equal bytes by sampled splitters.

A size-weighted sample of the record keys gives quantile boundaries; records
are range-partitioned by them, and a range that is too full for its shard is
subdivided at the record where the shard is full.  Main path: DataFrame
functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlode.sources.store import settle

# Records of a range, and ranges at least and at most; expected sampled records for each range.
RANGE_ROWS, LEAST_RANGES, MOST_RANGES, SAMPLED = 100_000, 576, 65_536, 28
# Boundaries are looked up by so many leading bits of the key, which is a hash.
CELL_BITS = 14
OVERHEAD = 16


def _splitters(records: DataFrame, total: int, sample: int, ranges: int) -> DataFrame:
    """At most `ranges` boundaries `(key, rid)` of about equal bytes between them.

    A record is drawn with a probability in proportion to its size; one that
    would be drawn for certain counts with its whole size.
    """
    share = F.col("size") * F.lit(float(sample)) / F.lit(float(total))
    drawn = F.pmod(F.xxhash64("rid", F.lit(20_011)), F.lit(1 << 32)) / F.lit(float(1 << 32)) < share
    weighted = records.filter(drawn).select("key", "rid", F.greatest(F.lit(1.0), share).alias("weight"))
    order = Window.orderBy("key", "rid")
    # The sample has a bounded number of rows.
    running = settle(weighted.select("key", "rid", F.sum("weight").over(order).alias("run")))
    whole = running.agg(F.coalesce(F.max("run"), F.lit(1.0))).first()[0]
    cell = F.floor(F.col("run") * F.lit(ranges / whole))
    found = running.groupBy(cell.alias("cell")).agg(F.min(F.struct("key", "rid")).alias("at"))
    return found.select("at.key", "at.rid")


def _cell(key: Column) -> Column:
    return F.shiftright(key, 64 - CELL_BITS)


def _ranged(records: DataFrame, splitters: DataFrame) -> DataFrame:
    """`records` with `range`, the number of boundaries at or below them.

    Boundaries of a cell of keys are one row, with the number of those before; there are 2 ** CELL_BITS cells, so they are broadcast.
    """
    cells = splitters.sparkSession.range(-(1 << CELL_BITS - 1), 1 << CELL_BITS - 1).select(F.col("id").alias("cell"))
    own = splitters.groupBy(_cell(F.col("key")).alias("cell")).agg(
        F.array_sort(F.collect_list(F.struct("key", "rid"))).alias("bounds"), F.count("*").alias("own")
    )
    none = F.array().cast("array<struct<key:bigint,rid:bigint>>")
    before = F.coalesce(F.sum("own").over(Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    table = settle(cells.join(own, "cell", "left").select("cell", F.coalesce("bounds", none).alias("bounds"), before.alias("before")))
    here = F.struct(F.col("key"), F.col("rid"))
    keyed = records.withColumn("cell", _cell(F.col("key")))
    number = F.col("before") + F.size(F.filter("bounds", lambda b: b <= here))
    return keyed.join(F.broadcast(table), "cell").withColumn("range", number).drop("cell", "bounds", "before")


def shard_by_splitters(
    docs: DataFrame, shards: int = 40, range_rows: int = RANGE_ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`(doc_id, size, text_crc32, law, shard, slot, grown_shard)`, one row per row of `docs`.

    Size is the text's UTF-8 bytes plus 16.  The law is `bytes`: two shards
    differ by about one record.  Records are ordered by (hash of the text, row),
    so equal texts are neighbours; a group larger than its shard is subdivided.
    Null text: size 16, null checksum.  Null ids are kept.  Repeated rows are
    records of their own.  `grown_shard` is null (it belongs to another law).
    No rows: no rows.
    """
    text = F.col(text_col)
    records = settle(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
            F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
            F.xxhash64(text).alias("key"),
            F.monotonically_increasing_id().alias("rid"),
        )
    )
    size = records.agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).first()
    total = size.bytes or 1
    ranges = max(LEAST_RANGES, min(MOST_RANGES, size.rows // range_rows))
    ranged = settle(_ranged(records, _splitters(records, total, ranges * SAMPLED, ranges)))

    # One row per range, MOST_RANGES + 1 at most: bytes and rows before it.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("range")
        .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
        .select(
            "range",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        )
    )
    inside = Window.partitionBy("range").orderBy("key", "rid")
    placed = (
        ranged.withColumn("run", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("nth", F.row_number().over(inside))
        .join(F.broadcast(offsets), "range")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            (F.col("rows_before") + F.col("nth") - 1).alias("row"),
            F.least(
                F.lit(shards - 1),
                F.floor(
                    (F.col("bytes_before") + F.col("run") - F.col("size") / 2) * F.lit(shards) / F.lit(float(total))
                ),
            )
            .cast("int")
            .alias("shard"),
        )
    )
    placed = settle(placed)
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

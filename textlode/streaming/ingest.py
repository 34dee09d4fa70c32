"""Incremental ingest of posts with exact deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlode.functions.cleaning import WS, clear_text
from textlode.functions.vectors import hash_embedding, l2_normalize
from textlode.operators.corpus import text_key
from textlode.operators.joins import BROADCAST_ROWS, within
from textlode.operators.tokens import analyze, token_rows
from textlode.sources.store import settle

STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# Rows outside the word limits are only counted, under so many keys.
SKIPPED_KEYS = 64


def _keyed(rows: DataFrame, text: str, low: int, high: int | None) -> DataFrame:
    """`(key, valid, n, row)`: every row as a struct with its cleaned text, under the key of that text."""
    cleaned = clear_text(F.col(text))
    row = rows.select(F.struct(*[F.col(c) for c in rows.columns], cleaned.alias("cleaned_text")).alias("row"))
    n = F.size(F.filter(F.split("row.cleaned_text", " "), lambda w: w != ""))
    limit = n >= max(low, 1) if high is None else n.between(max(low, 1), high)
    # A text that only spells a missing value is none, as in `processed_text`.
    missing = F.rlike(F.col("row").getField(text), F.lit(rf"(?i)\A[{WS}]*nan[{WS}]*\z"))
    valid = F.coalesce(limit & ~missing, F.lit(False))
    skipped = F.encode(F.concat(F.lit("skipped-"), F.pmod(F.xxhash64("row"), F.lit(SKIPPED_KEYS)).cast("string")), "utf-8")
    return row.select(
        F.when(valid, text_key(F.col("row.cleaned_text"))).otherwise(skipped).alias("key"), valid.alias("valid"), F.lit(1).cast("long").alias("n"),
        F.when(valid, F.col("row")).alias("row"),
    )


def _first_of_each(order_col: str):
    """Keeps the first row of each key of an Arrow batch with the number of rows it stands for: copies go before the shuffle."""
    import numpy as np
    import pyarrow as pa

    def run(batches):
        for batch in batches:
            keys = batch.column(0).dictionary_encode()
            names = keys.indices.to_numpy()
            ids = batch.column(3).field(order_col)
            order = np.lexsort((np.arange(len(names)), _ranks(ids), names))
            first = order[np.concatenate([[True], np.diff(names[order]) != 0])] if len(order) else order
            sums = np.bincount(names, batch.column(2).to_numpy(), len(keys.dictionary)).astype(np.int64)
            kept = batch.take(pa.array(first))
            yield kept.set_column(2, "n", pa.array(sums[names[first]]))

    return run


def _ranks(ids):
    """Places of ids in their order, nulls last."""
    import numpy as np
    import pyarrow.compute as pc

    ranks = np.empty(len(ids), np.int64)
    ranks[pc.sort_indices(ids, null_placement="at_end").to_numpy()] = np.arange(len(ids))
    # Equal ids share the first one's place.
    alike = ids.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    least = {}
    for name, rank in zip(alike.tolist(), ranks.tolist()):
        least[name] = min(least.get(name, rank), rank)
    return np.array([least[name] for name in alike.tolist()], np.int64)


def first_seen(keyed: DataFrame, order_col: str) -> DataFrame:
    """`(key, valid, n, row, fresh)`: all rows of a stream of `(key, valid, n, row)`, and a row per key met for the first time.

    The state store holds nothing but the keys met so far.  Rows stay where they are; only keys are shuffled, each once per Arrow
    batch, and no key is a call of a Python function.  Rows have `fresh` false, keys true and nothing else.
    """
    light = keyed.withColumn("row", F.struct(F.col("row").getField(order_col).alias(order_col)))
    keys = light.mapInArrow(_first_of_each(order_col), light.schema).select("key").dropDuplicates(["key"])
    # A file per partition of the state would leave the large files of the rows to few readers.
    keys = keys.repartition(keyed.sparkSession.sparkContext.defaultParallelism)
    return keyed.withColumn("fresh", F.lit(False)).unionByName(keys.withColumn("fresh", F.lit(True)), allowMissingColumns=True)


def _winners(told: DataFrame, order_col: str) -> DataFrame:
    """`(uid)` of the first valid row, by `order_col`, of each fresh key of a micro-batch; null ids come last."""
    place = F.struct(F.col("row").getField(order_col).isNull().alias("last"), F.col("row").getField(order_col).alias("id"), "uid")
    first = told.filter("not fresh and valid").groupBy("key").agg(F.min(place).alias("first"))
    return first.join(told.filter("fresh").select("key"), "key", "left_semi").select("first.uid")


def ingest_stream(
    spark: SparkSession,
    source: str,
    target: str,
    schema: T.StructType,
    text: str = "text",
    order_col: str = "doc_id",
    low: int = 1,
    high: int | None = None,
    files_per_trigger: int | None = None,
) -> None:
    """Ingests all Parquet files that are new in `source`, then returns.

    Every micro-batch keeps the first row of each cleaned text not seen
    before and writes `documents`, their `tokens` and `vectors`, and its
    `counters` under its batch number.  What was seen is the keyed state of the
    query, 32 bytes a text, in RocksDB; no table that was written is read for it.
    A repeated batch starts from the state before it and replaces its own
    output, so a restart neither loses nor doubles a document.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    row = T.StructType([*schema.fields, T.StructField("cleaned_text", T.StringType())])

    def store(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        told = settle(batch.withColumn("uid", F.monotonically_increasing_id()))
        winners = settle(_winners(told, order_col))
        valid = told.filter("not fresh and valid")
        losers = settle(valid.select("uid").join(winners, "uid", "left_anti"))
        # Numbers are unique, so no key is hot.
        others = F.broadcast(losers) if within(losers, BROADCAST_ROWS) else losers.hint("merge")

        def write(df: DataFrame, name: str) -> str:
            path = f"{target}/{name}/batch={number}"
            df.write.mode("overwrite").parquet(path)
            return path

        documents = session.read.schema(row).parquet(write(valid.join(others, "uid", "left_anti").select("row.*"), "documents"))
        write(token_rows(analyze(documents, text), order_col), "tokens")
        vectors = l2_normalize(hash_embedding(F.col("cleaned_text"))).cast("array<float>")
        write(documents.select(order_col, vectors.alias("embedding")), "vectors")

        def total(n: Column) -> Column:
            return F.coalesce(F.sum(n), F.lit(0)).cast("long")

        counts = [total(F.col("n")).alias("received"), total(F.when(~F.col("valid"), F.col("n"))).alias("skipped")]
        stored_now = F.lit(winners.count()).cast("long").alias("stored")
        duplicates = (F.col("received") - F.col("stored") - F.col("skipped")).alias("duplicates")
        told_of = told.filter("not fresh").agg(*counts).select("*", stored_now)
        write(told_of.select("received", "stored", duplicates, "skipped"), "counters")

    keyed = _keyed(reader.parquet(source), text, low, high)
    before = spark.conf.get(STATE_PROVIDER, None)
    # The query keeps the provider that it starts with.
    spark.conf.set(STATE_PROVIDER, ROCKSDB)
    try:
        query = (
            first_seen(keyed, order_col)
            .writeStream.foreachBatch(store)
            .option("checkpointLocation", f"{target}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    finally:
        spark.conf.unset(STATE_PROVIDER) if before is None else spark.conf.set(STATE_PROVIDER, before)


def stored(spark: SparkSession, target: str, name: str) -> DataFrame:
    """`documents`, `tokens`, `vectors` or `counters` of all batches."""
    return spark.read.option("basePath", f"{target}/{name}").parquet(f"{target}/{name}")


def stored_documents(spark: SparkSession, target: str) -> DataFrame:
    return stored(spark, target, "documents")

"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import sys

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlode.operators.joins import hinted_join

# A table is broadcast only after its text was counted to hold at most this many bytes.
BROADCAST_BYTES = 8 << 20
BROADCAST_ROWS = 100_000
# Copies of a side that is too large for that.
SALTS = 64


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rows that a Python worker gets at a time: texts may be long, and a batch of the usual size would be large.
BATCH_ROWS = 1_000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to BATCH_ROWS rows; no result depends on it."""
    rows = int(spark.conf.get(_BATCH, "10000"))
    if rows <= 0 or rows > BATCH_ROWS:
        spark.conf.set(_BATCH, BATCH_ROWS)


def fits(df: DataFrame, width: Column, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
    """Whether `df` has at most `rows` rows and `width`, summed over them, is at most `size`."""
    found = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("b")).first()
    return found.n <= rows and found.b <= size


def spread_join(big: DataFrame, small: DataFrame, on: str, how: str, small_fits: bool) -> DataFrame:
    """Equi-join whose `big` side may hold a third of its rows under one key.

    A small side that was counted to fit is broadcast.  Otherwise its rows are
    copied over salts and the rows of `big` are dealt out over the copies, so
    that no key of `big` meets in one task; the copies are merged, never
    broadcast, for Spark plans them as if they were one.
    """
    return hinted_join(big, small, [on], how, small_fits, SALTS)


def once_per_worker(key: str, build):
    """What `build()` gives, kept for as long as the Python worker lives."""
    kept = sys.__dict__.setdefault("_textlode_kept", {})
    if key not in kept:
        kept[key] = build()
    return kept[key]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (the finaliser of SplitMix64), in place."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x

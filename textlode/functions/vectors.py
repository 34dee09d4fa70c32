"""Vector arithmetic on array columns, accumulated in double precision."""

from __future__ import annotations

from functools import lru_cache
from hashlib import md5

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from textlode.functions.cleaning import let


# Texts embedded at a time.
VECTOR_ROWS = 1_000


def _double(col: Column) -> Column:
    return col.cast("array<double>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(_double(a), _double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def squared_l2(a: Column, b: Column) -> Column:
    gaps = F.zip_with(_double(a), _double(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(gaps, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalize(a: Column) -> Column:
    """Unit-length copy; a zero vector stays as it is."""

    def scale(v: Column, n: Column) -> Column:
        return F.transform(v, lambda x: F.when(n == 0, x).otherwise(x / n))

    return let(_double(a), lambda v: let(norm(v), lambda n: scale(v, n)))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; 0 when either vector has no length."""

    def ratio(x: Column, y: Column) -> Column:
        return let(
            norm(x) * norm(y),
            lambda n: F.when(n == 0, F.lit(0.0)).otherwise(dot(x, y) / n),
        )

    return let(_double(a), lambda x: let(_double(b), lambda y: ratio(x, y)))


def rounded(score: Column, digits: int = 6) -> Column:
    """Scores are rounded before ranking, so that summation order decides no rank."""
    return F.round(score, digits) + F.lit(0.0)


def term_bucket(term: Column, dim: int) -> Column:
    """Bucket of a term: the first eight hex digits of its MD5, modulo `dim`."""
    return F.pmod(F.conv(F.substring(F.md5(term), 1, 8), 16, 10).cast("long"), F.lit(dim))


def hash_embedding(clean: Column, dim: int = 64) -> Column:
    """Counts of a cleaned text's words per hash bucket, as a dense float vector.

    The stand-in where no model is plugged in.  Blank texts give null.  An
    Arrow batch function: every different word of a batch is hashed once.
    """

    @F.arrow_udf("array<float>")
    def embedded(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.string())
        parts = [_bucket_counts(texts.slice(at, VECTOR_ROWS), dim) for at in range(0, len(texts), VECTOR_ROWS)]
        return pa.concat_arrays(parts) if parts else _bucket_counts(texts, dim)

    return embedded(clean)


@lru_cache(200_000)
def _hashed(word: str) -> int:
    """What `term_bucket` takes modulo the width; remembered for the words met last."""
    return int(md5(word.encode()).hexdigest()[:8], 16)


def _bucket_counts(texts: pa.Array, dim: int) -> pa.Array:
    lists = pc.split_pattern(texts, " ")
    words = lists.flatten().dictionary_encode()
    buckets = np.array([_hashed(w) % dim for w in words.dictionary.to_pylist()], np.int64)
    row = np.repeat(np.arange(len(texts)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy())
    counts = np.bincount(row * dim + buckets[words.indices.to_numpy()], minlength=len(texts) * dim)
    blank = pc.fill_null(pc.equal(texts, ""), True)
    offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * dim)
    return pa.ListArray.from_arrays(offsets, pa.array(counts.astype(np.float32)), mask=blank)

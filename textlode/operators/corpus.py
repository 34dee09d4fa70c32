"""Set operations, deduplication and mutation of the corpus tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlode.operators.joins import lookup_join
from textlode.sources.store import settle


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames; a column missing in one is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def text_key(col: Column) -> Column:
    """32-byte key of a cleaned text, so that shuffles move no texts."""
    return F.unhex(F.sha2(F.lower(F.trim(col)), 256))


def first_per_key(df: DataFrame, key: Column, order_col: str) -> DataFrame:
    """`(key, order_col)` of the first row of each key.

    A plain minimum: each task reduces its copies to one row per key before
    the shuffle, so a key held by a third of all rows costs one row per task.
    """
    return df.groupBy(key.alias("key")).agg(F.min(order_col).alias(order_col))


def first_texts(df: DataFrame, col: str, order_col: str) -> DataFrame:
    """`(key, order_col)` of the first row of each cleaned text `col`, blank texts left out."""
    return _first_keys(_text_keys(df, col, order_col), order_col)


def _text_keys(df: DataFrame, col: str, order_col: str) -> DataFrame:
    """`(key, order_col)` of every row, written, so that the texts are read and cleaned once for it."""
    return settle(df.select(text_key(F.col(col)).alias("key"), order_col))


def _first_keys(keys: DataFrame, order_col: str) -> DataFrame:
    """Blank texts go by their key: a condition on the text would be pushed down and clean it again."""
    blank = F.unhex(F.sha2(F.lit(""), 256))
    return first_per_key(keys.filter(F.col("key") != blank), F.col("key"), order_col)


def dedup_first(df: DataFrame, col: str, order_col: str) -> DataFrame:
    """The first row, by the unique `order_col`, of each non-blank cleaned text `col`.

    Winners are found on keys and ids only; the texts then meet the ids of the
    others (copies and blank texts), sent to all tasks if counted to fit.
    """
    keys = _text_keys(df, col, order_col)
    losers = keys.join(_first_keys(keys, order_col), ["key", order_col], "left_anti")
    return lookup_join(df, settle(losers.select(order_col)), [order_col], "left_anti")


def distinct_fragments(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).distinct()


def insert_new_only(new: DataFrame, existing: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose id is not stored yet."""
    return new.join(existing.select(key), key, "left_anti")


def rejected_on_insert(new: DataFrame, existing: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows whose id is already stored."""
    return new.join(existing.select(key), key, "left_semi")


def delete_by_id(df: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows that remain once those listed in `ids` are deleted."""
    return lookup_join(df, ids.select(key).distinct(), [key], "left_anti")


def delete_cascade(
    documents: DataFrame, tokens: DataFrame, ids: DataFrame, key: str = "doc_id"
) -> tuple[DataFrame, DataFrame]:
    """Documents and their tokens without those listed in `ids`."""
    return delete_by_id(documents, ids, key), delete_by_id(tokens, ids, key)


def get_documents(documents: DataFrame, tokens: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents listed in `ids`, with their tokens in order; absent ids give no row."""
    wanted = ids.select("doc_id").distinct()
    fields = [c for c in tokens.columns if c != "doc_id"]
    lists = (
        lookup_join(tokens, wanted, ["doc_id"], "left_semi")
        .groupBy("doc_id")
        .agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("tokens"))
    )
    return lookup_join(documents, wanted, ["doc_id"], "left_semi").join(lists, "doc_id", "left")

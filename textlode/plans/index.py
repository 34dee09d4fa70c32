"""From posts to corpus tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlode.functions.cleaning import clear_text, processed_text
from textlode.functions.tokens import word_count
from textlode.functions.vectors import hash_embedding, l2_normalize
from textlode.operators.bm25 import term_rows
from textlode.operators.corpus import dedup_first, first_texts
from textlode.operators.filters import MOST, words_between
from textlode.operators.tokens import analyze, annotate_tokens, rebuild_truncated, token_rows
from textlode.operators.vectors import embed_with
from textlode.sources.store import cluster_tokens, settle, write_version


def select_posts(
    df: DataFrame, text: str = "text", low: int = 1, high: int | None = None
) -> DataFrame:
    """Posts of at least `low` and, if told, at most `high` words, the first of each cleaned text.

    Words are counted on the whole cleaned text; `ingest_statuses` tells why a post is left out.
    """
    counted = df.withColumn("_words", processed_text(F.col(text), None))
    valid = words_between(counted, "_words", low, high).drop("_words")
    keyed = valid.withColumn("_clean", clear_text(F.col(text)))
    return dedup_first(keyed, "_clean", "doc_id").drop("_clean")


def analyze_posts(df: DataFrame, text: str = "text", max_tokens: int | None = None, **limits) -> DataFrame:
    """`(doc_id, original_text, cleaned_text, mapping, tokens)` of the selected posts."""
    analyzed = analyze(select_posts(df, text, **limits), text)
    if max_tokens is not None:
        analyzed = rebuild_truncated(analyzed, max_tokens)
    return analyzed.select(
        "doc_id", F.col(text).alias("original_text"), "cleaned_text", "mapping", "tokens"
    )


def token_table(documents: DataFrame, lexicon: DataFrame) -> DataFrame:
    """One row per token of the nested documents, with lemma and part of speech."""
    return annotate_tokens(token_rows(documents, "doc_id"), lexicon).select(
        "doc_id", "position", "token", "lemma", "pos",
        "start_clean", "end_clean", "start_orig", "end_orig",
    )


def postings_table(documents: DataFrame) -> DataFrame:
    """The term rows of the documents, laid out by term; `operators.postings` stores statistics, bounds and positions as well."""
    rows = term_rows(documents, "cleaned_text")
    return rows.repartitionByRange("term", "doc_id").sortWithinPartitions("term", "doc_id")


def vector_table(
    documents: DataFrame, encode: Callable[[list[str]], np.ndarray] | None = None, dim: int = 64
) -> DataFrame:
    """Unit vectors of the cleaned texts; without a model, of their hashed word counts."""
    if encode is None:
        embedded = documents.withColumn("embedding", hash_embedding(F.col("cleaned_text"), dim))
    else:
        embedded = embed_with(documents, "cleaned_text", encode)
    unit = l2_normalize(F.col("embedding")).cast("array<float>")
    return embedded.select("doc_id", unit.alias("embedding"))


def load_corpus(
    df: DataFrame,
    base: str,
    lexicon: DataFrame,
    text: str = "text",
    encode: Callable[[list[str]], np.ndarray] | None = None,
    dim: int = 64,
    max_tokens: int | None = None,
    **limits,
) -> int:
    """The whole load of `df(doc_id, <text>)` into a new version of the corpus in `base`.

    Posts are selected, deduplicated, analysed and truncated once; tokens and
    vectors are made from the documents as written.
    """
    documents = settle(analyze_posts(df, text, max_tokens, **limits))
    return write_version(
        df.sparkSession,
        base,
        {
            "documents": documents,
            "tokens": cluster_tokens(token_table(documents, lexicon)),
            "postings": postings_table(documents),
            "vectors": vector_table(documents, encode, dim),
        },
    )


def ingest_statuses(
    df: DataFrame,
    text: str = "text",
    low: int = 1,
    high: int | None = None,
) -> DataFrame:
    """`(doc_id, status)`: stored, duplicate, or skipped for its length."""
    n_words = word_count(processed_text(F.col(text), None))
    clean = F.when(n_words.between(low, MOST if high is None else high), clear_text(F.col(text)))
    keyed = df.select("doc_id", clean.alias("clean"))
    winners = first_texts(keyed, "clean", "doc_id").select("doc_id", F.lit(True).alias("first"))
    status = (
        F.when(F.col("clean").isNull(), F.lit("skipped"))
        .when(F.col("first"), F.lit("stored"))
        .otherwise(F.lit("duplicate"))
    )
    return keyed.join(winners, "doc_id", "left").select("doc_id", status.alias("status"))

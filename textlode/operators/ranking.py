"""Ranking helpers: boosts, re-ranking, fragments in documents, positions."""

from __future__ import annotations

import math
from difflib import SequenceMatcher
from functools import reduce

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from textlode.functions.cleaning import let
from textlode.functions.vectors import rounded
from textlode.operators.joins import hinted_join, lookup_join, top_per_group
from textlode.sources.store import settle

# Fragments of about this many rows and characters go to every task as one automaton.
PATTERN_ROWS = 50_000
PATTERN_CHARS = 16_000_000

# Weights and boosts of the ranking formulas.
EMBEDDING_WEIGHT = 0.6
STRING_WEIGHT = 0.4
BM25_WEIGHT = 0.3
COSINE_WEIGHT = 0.7
TRIPLE_BOOST = 1.2
SHORT_BOOST = 1.5
EXACT_BOOST = 1.2
SHORT_LEMMAS = 10


@F.pandas_udf(T.DoubleType())
def string_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff/Obershelp similarity of two texts."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b)])


def ratio_bound(a: Column, b: Column) -> Column:
    """What `string_ratio` of two texts cannot exceed: the share of their characters that both have, order aside."""

    def count(text: Column, char: Column) -> Column:
        return F.length(text) - F.length(F.replace(text, char, F.lit("")))

    def shared(x: Column, y: Column) -> Column:
        chars = F.filter(F.array_distinct(F.split(x, "")), lambda c: c != "")
        both = F.aggregate(chars, F.lit(0), lambda total, c: total + F.least(count(x, c), count(y, c)))
        size = F.length(x) + F.length(y)
        return F.when(size == 0, F.lit(1.0)).otherwise(2.0 * both / size)

    empty = F.lit("")
    return let(F.coalesce(a, empty), lambda x: let(F.coalesce(b, empty), lambda y: shared(x, y)))


def most_relevant(candidates: DataFrame, k: int, name: str, text: str = "fragment", asked: str = "asked") -> DataFrame:
    """`(query_id, <name>, similarity, rank)`: the k most relevant candidates of each query by 0.6 embedding and 0.4 string similarity.

    `candidates(query_id, <name>, <text>, <asked>, score)`.  The string similarity is computed for the k candidates with the
    highest bounds, and of the others only for those whose bound reaches the k-th best similarity found there.
    """
    bound = relevance(F.col("score"), ratio_bound(F.col(asked), F.col(text)))
    columns = list(dict.fromkeys(["query_id", name, text, asked, "score"]))
    ordered = Window.partitionBy("query_id").orderBy(F.desc("bound"), F.asc(name))
    placed = settle(candidates.select(*columns, bound.alias("bound")).withColumn("place", F.row_number().over(ordered)))

    def exact(rows: DataFrame) -> DataFrame:
        similarity = rounded(relevance(F.col("score"), string_ratio(asked, text)))
        return rows.select("query_id", name, similarity.alias("similarity"))

    first = settle(exact(placed.filter(F.col("place") <= k)))
    least = first.groupBy("query_id").agg(F.min("similarity").alias("least"))
    rest = placed.filter(F.col("place") > k).join(least, "query_id")
    # More than the rounding of a similarity.
    open_ = rest.filter(F.col("bound") >= F.col("least") - 1e-6)
    every = first.unionByName(exact(open_))
    return top_per_group(every, ["query_id"], [F.desc("similarity"), F.asc(name)], k)


def levenshtein_ratio(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; a JVM-side alternative to `string_ratio`."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longer)


def relevance(embedding_score: Column, text_score: Column) -> Column:
    return EMBEDDING_WEIGHT * embedding_score + STRING_WEIGHT * text_score


def triple_match(
    candidates: DataFrame, query_triples: DataFrame, doc_triples: DataFrame
) -> DataFrame:
    """Candidates `(query_id, doc_id, ..)` sharing at least one triple with their query."""
    roles = ["subj", "verb", "obj"]
    shared = lookup_join(
        doc_triples.select("doc_id", *roles),
        query_triples.select("query_id", *roles).distinct(),
        roles,
    )
    pairs = shared.select("query_id", "doc_id").distinct()
    return candidates.join(pairs, ["query_id", "doc_id"], "left_semi")


def dedup_ranked(hits: DataFrame, n: int) -> DataFrame:
    """Best score per query and document, the `n` best documents of each query."""
    best = hits.groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))
    return top_per_group(best, ["query_id"], [F.desc("score"), F.asc("doc_id")], n)


def containing_doc(fragments: DataFrame, docs: DataFrame) -> DataFrame:
    """`(fragment, doc_id)`: the first document, by id, with the fragment as a substring.

    `fragments(fragment)`, `docs(doc_id, text)`; null and empty fragments and
    documents without id or text take no part, a fragment found nowhere has no
    row.  Fragments become search automata of bounded size, by hash, and every
    automaton reads each text once; each task hands on its first document per
    fragment.  Whatever their number, no row per character or run is made.
    """
    fragments = fragments.select("fragment").filter("fragment <> ''").distinct()
    docs = docs.select("doc_id", "text").filter("doc_id is not null and text is not null")
    size = fragments.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("fragment")), F.lit(0)).alias("chars")).head()
    slices = max(1, math.ceil(size.n / PATTERN_ROWS), math.ceil(size.chars / PATTERN_CHARS))
    if slices > 1:
        fragments = settle(fragments.withColumn("slice", F.pmod(F.xxhash64("fragment"), F.lit(slices))))

    def first_in(own: DataFrame) -> DataFrame:
        patterns = [row["fragment"] for row in own.select("fragment").collect()]
        return _scan_documents(patterns, docs).groupBy("fragment").agg(F.min("doc_id").alias("doc_id"))

    if slices == 1:
        return first_in(fragments)
    # One after the other, so that the driver holds one slice.
    parts = [settle(first_in(fragments.filter(F.col("slice") == n))) for n in range(slices)]
    return reduce(DataFrame.unionByName, parts)


def _scan_documents(patterns: list[str], docs: DataFrame) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(patterns)
    schema = T.StructType([T.StructField("fragment", T.StringType()), docs.schema["doc_id"]])
    out = to_arrow_schema(schema)

    def scan(batches):
        automaton = ahocorasick.Automaton()
        for pattern in shared.value:
            automaton.add_word(pattern, pattern)
        if len(automaton) == 0:
            return
        automaton.make_automaton()
        first = {}
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for _, pattern in automaton.iter(text):
                    if pattern not in first or doc_id < first[pattern]:
                        first[pattern] = doc_id
        columns = [pa.array(first.keys(), out[0].type), pa.array(first.values(), out[1].type)]
        yield pa.RecordBatch.from_arrays(columns, schema=out)

    return docs.mapInArrow(scan, schema)


def phrase_positions(
    phrases: DataFrame, terms: DataFrame, scores: DataFrame, fits: bool = False
) -> DataFrame:
    """Where the expanded query terms occur in the scored documents.

    `phrases(doc_id, type, lemma, start, stop)` meets `terms(query_id, term)`
    on the lemma, within the documents of `scores(query_id, doc_id, score)`.
    """
    listed = terms.select("query_id", F.col("term").alias("lemma")).distinct()
    located = lookup_join(phrases, listed, ["lemma"])
    return hinted_join(
        located, scores.select("query_id", "doc_id", "score"), ["query_id", "doc_id"], "inner", fits
    ).select("query_id", "doc_id", "type", "lemma", "start", "stop", "score")


def token_lookup(tokens: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Tokens whose lemma is listed in `lemmas(lemma)`."""
    return lookup_join(tokens, lemmas.select("lemma").distinct(), ["lemma"], "left_semi")



"""Query expansion from lexicon tables.

`synonyms(word, synset_id, synset_rank, sense, sense_rank)` has one row per
sense of each synset a word belongs to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlode.functions.cleaning import clear_text
from textlode.functions.tokens import clean_words_of
from textlode.operators.joins import lookup_join, top_per_group
from textlode.operators.tokens import annotate_tokens


def query_lemmas(queries: DataFrame, lexicon: DataFrame) -> DataFrame:
    """`(query_id, position, term)`: the lemmas of each cleaned query, in order."""
    tokens = queries.select(
        "query_id", F.posexplode(clean_words_of(clear_text(F.col("text")))).alias("position", "token")
    )
    return annotate_tokens(tokens, lexicon).select("query_id", "position", F.col("lemma").alias("term"))


def expand_synonyms(terms: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Distinct `(query_id, term)`: the terms and all lower-cased senses of all their synsets."""
    own = terms.select("query_id", "term").distinct()
    senses = lookup_join(
        own, synonyms.select(F.col("word").alias("term"), F.lower("sense").alias("sense")), ["term"]
    )
    return own.union(senses.select("query_id", F.col("sense").alias("term"))).distinct()


def capped_synonyms(synonyms: DataFrame, synsets: int = 2, most: int = 3) -> DataFrame:
    """`(word, rank, sense)`: up to `most` distinct other senses from the first `synsets` synsets."""
    usable = synonyms.filter((F.col("synset_rank") <= synsets) & (F.col("sense") != F.col("word")))
    first = usable.groupBy("word", "sense").agg(
        F.min(F.struct("synset_rank", "sense_rank")).alias("at")
    )
    return top_per_group(first, ["word"], [F.col("at")], most).select("word", "rank", "sense")


def expand_synonyms_capped(
    terms: DataFrame, synonyms: DataFrame, synsets: int = 2, most: int = 3
) -> DataFrame:
    """`(query_id, position, rank, term)`: each term with rank 0, its synonyms with 1, 2, ..

    A term that occurs twice in a query is expanded twice.
    """
    listed = capped_synonyms(synonyms, synsets, most).withColumnRenamed("word", "term")
    added = lookup_join(terms, listed, ["term"]).select(
        "query_id", "position", "rank", F.col("sense").alias("term")
    )
    own = terms.select("query_id", "position", F.lit(0).alias("rank"), "term")
    return own.union(added)


def process_query(queries: DataFrame, lexicon: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Clean query, its lemmas and its capped synonyms as ordered arrays, one row per query."""
    expanded = expand_synonyms_capped(query_lemmas(queries, lexicon), synonyms)
    lemma = F.when(F.col("rank") == 0, F.struct("position", "term"))
    # All lemmas come first, then the synonyms in the order of their lemmas.
    place = F.struct((F.col("rank") > 0).alias("late"), "position", "rank", "term")
    lists = expanded.groupBy("query_id").agg(
        F.transform(F.array_sort(F.collect_list(lemma)), lambda x: x["term"]).alias("lemmas"),
        F.transform(F.array_sort(F.collect_list(place)), lambda x: x["term"]).alias("expanded_terms"),
    )
    clean = queries.select("query_id", clear_text(F.col("text")).alias("clean_query"))
    return clean.join(lists, "query_id", "left")


def synset_siblings(words: DataFrame, synonyms: DataFrame) -> DataFrame:
    """`(word, synset_id, sibling)`: all senses of all synsets of each word in `words(word)`."""
    synsets = synonyms.select("word", "synset_id").distinct()
    senses = synonyms.select("synset_id", F.lower("sense").alias("sibling")).distinct()
    return lookup_join(words.select("word").distinct(), synsets, ["word"]).join(senses, "synset_id")

"""Okapi BM25 over a corpus of term rows.

Terms are counted inside each document's row, so no text and no posting is
shuffled: what moves are the counts per term, the rows of query terms and each
task's best documents.  The term rows may as well be stored and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlode.functions.tokens import clean_words_of, word_counts
from textlode.functions.vectors import rounded
from textlode.operators.joins import BROADCAST_ROWS, hinted_join, lookup_join, one_per_key, spread_by, top_per_group, within
from textlode.sources.store import settle

# The usual Okapi parameters.
K1 = 1.5
B = 0.75
EPSILON = 0.25


def term_rows(docs: DataFrame, text: str = "clean", key: str = "doc_id") -> DataFrame:
    """`(doc_id, dl, term, tf)`: one row per document and term of the cleaned text.

    Every document also has one row with a null term, so that documents
    without tokens count, and so that the number of documents and their total
    length can be read off the same counts as the terms.
    """
    clean = F.coalesce(F.col(text), F.lit(""))
    split = docs.select(F.col(key).alias("doc_id"), clean_words_of(clean).alias("tokens"))
    # The length is taken before the explode; after it, it would be taken per term.
    sized = split.select("doc_id", F.size("tokens").alias("dl"), word_counts(F.col("tokens")).alias("counts"))
    none = F.array(F.struct(F.lit(None).cast("string").alias("word"), F.lit(0).alias("n")))
    terms = F.inline(F.concat("counts", none)).alias("term", "tf")
    return sized.select("doc_id", "dl", terms)


def lemma_rows(rows: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Term rows with every term replaced by its lemma, where the lexicon has one."""
    listed = one_per_key(lexicon.select(F.col("form").alias("term"), "lemma", "pos"), "term").drop("pos")
    found = lookup_join(rows, listed, ["term"], "left")
    lemmas = found.select("doc_id", "dl", F.coalesce("lemma", "term").alias("term"), "tf")
    return lemmas.groupBy("doc_id", "dl", "term").agg(F.sum("tf").alias("tf"))


def query_terms(terms: DataFrame) -> DataFrame:
    """`(query_id, term, qtf)` from one row per query term; repeats count."""
    return terms.groupBy("query_id", "term").agg(F.count("*").alias("qtf"))


def term_counts(rows: DataFrame) -> DataFrame:
    """`(term, df, total_dl)`; the null term holds the document count and total length."""
    return rows.groupBy("term").agg(
        F.count("*").alias("df"), F.sum("dl").alias("total_dl")
    )


def inverse_document_frequencies(rows: DataFrame, epsilon: float = EPSILON) -> DataFrame:
    """`(term, df, idf, avgdl)`; a negative idf becomes `epsilon` times the vocabulary mean."""
    counts = term_counts(rows)
    whole = counts.filter(F.col("term").isNull())
    n_docs = whole.select("df").scalar()
    avgdl = whole.select(F.col("total_dl") / F.col("df")).scalar()
    raw = F.log(n_docs - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    vocabulary = counts.filter(F.col("term").isNotNull())
    mean = vocabulary.agg(F.avg(raw)).scalar()
    return vocabulary.select(
        "term",
        "df",
        F.when(raw < 0, epsilon * mean).otherwise(raw).alias("idf"),
        avgdl.alias("avgdl"),
    )


def bm25_scores(
    terms: DataFrame,
    rows: DataFrame,
    k1: float = K1,
    b: float = B,
    epsilon: float = EPSILON,
    digits: int = 6,
) -> DataFrame:
    """`(query_id, doc_id, dl, score)` of every document with at least one query term.

    `terms(query_id, term, qtf)` are the queries, `rows` the corpus.  A
    document without any query term scores 0 and has no row.
    """
    fits = within(terms, BROADCAST_ROWS)
    idf = inverse_document_frequencies(rows, epsilon)
    # At most one row per query term, so whatever bounds `terms` bounds this.
    weighted = hinted_join(idf, terms, ["term"], "inner", fits).select(
        "query_id", "term", (F.col("qtf") * F.col("idf")).alias("weight"), "avgdl"
    )
    wanted = terms.select("term").distinct()
    if fits:
        # Hits move once, by document and with the number of their term; pairs of query and document are made where they arrive.
        wanted = settle(wanted.withColumn("no", F.monotonically_increasing_id()))
        hits = hinted_join(rows, wanted, ["term"], "inner", fits).select("doc_id", "dl", "no", "tf")
        tf, on = spread_by(hits, "dl", "doc_id"), ["no"]
        weighted = hinted_join(weighted, wanted, ["term"], "inner", fits).drop("term")
    else:
        tf, on = hinted_join(rows, wanted, ["term"], "left_semi", fits), ["term"]
    part = (
        F.col("weight")
        * F.col("tf")
        * (k1 + 1)
        / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.col("avgdl")))
    )
    matched = hinted_join(tf, weighted, on, "inner", fits)
    return matched.groupBy("query_id", "doc_id", "dl").agg(
        rounded(F.sum(part), digits).alias("score")
    )


def bm25_top_n(terms: DataFrame, rows: DataFrame, n: int, **parameters) -> DataFrame:
    """The `n` best documents of each query; ties go to the smaller id."""
    scores = bm25_scores(terms, rows, **parameters)
    return top_per_group(scores, ["query_id"], [F.desc("score"), F.asc("doc_id")], n)

"""Small lexicons and table shapes used by the registered queries.

The lexicons are fixed values, spelt as SQL rows that Spark and DuckDB read
alike.  Their words are frequent ones of the test corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlode.sources.store import read_spread

LEMMA_LEXICON = """
SELECT * FROM (VALUES
 ('is', 'be', 'VERB'), ('are', 'be', 'VERB'), ('was', 'be', 'VERB'), ('ist', 'sein', 'VERB'),
 ('est', 'etre', 'VERB'), ('the', 'the', 'DET'), ('an', 'a', 'DET'), ('der', 'der', 'DET'),
 ('die', 'der', 'DET'), ('das', 'der', 'DET'), ('la', 'le', 'DET'), ('les', 'le', 'DET'),
 ('le', 'le', 'DET'), ('el', 'el', 'DET'), ('los', 'el', 'DET'), ('of', 'of', 'ADP'),
 ('in', 'in', 'ADP'), ('to', 'to', 'PART'), ('de', 'de', 'ADP'), ('and', 'and', 'CCONJ'),
 ('und', 'und', 'CCONJ'), ('que', 'que', 'SCONJ')
) AS t(form, lemma, pos)"""

SYNONYMS = """
SELECT * FROM (VALUES
 ('the', 's1', 1, 'That', 1), ('the', 's1', 1, 'this', 2), ('the', 's1', 1, 'the', 3),
 ('the', 's2', 2, 'That', 1), ('the', 's2', 2, 'these', 2), ('the', 's2', 2, 'those', 3),
 ('the', 's3', 3, 'such', 1),
 ('be', 's4', 1, 'exist', 1), ('be', 's4', 1, 'Live', 2),
 ('of', 's5', 1, 'from', 1), ('of', 's5', 1, 'for', 2), ('of', 's6', 2, 'by', 1), ('of', 's6', 2, 'with', 2),
 ('le', 's7', 1, 'un', 1), ('und', 's8', 1, 'auch', 1), ('und', 's8', 1, 'sowie', 2), ('in', 's9', 1, 'into', 1)
) AS t(word, synset_id, synset_rank, sense, sense_rank)"""

GAZETTEER = """
SELECT * FROM (VALUES
 ('the', 'ORG', 'The'), ('of the', 'LOC', 'Of The'), ('and the', 'PER', 'And The'),
 ('de la', 'LOC', 'De La'), ('la', 'PER', 'La'), ('de', 'ORG', 'De'), ('und', 'PER', 'Und'),
 ('der', 'LOC', 'Der'), ('in der', 'LOC', 'In Der'), ('to', 'MISC', 'To'), ('que', 'ORG', 'Que'),
 ('la que', 'PER', 'La Que'), ('is', 'PER', 'Is')
) AS t(phrase_lemma, type, normal)"""

SLANG = """
SELECT * FROM (VALUES
 ('the', 'ye'), ('und', 'so wie auch'), ('que', 'lo que')
) AS t(term, replacement)"""

POSITIVE_WORDS = ["good", "the", "und", "que", "with"]
NEGATIVE_WORDS = ["bad", "of", "der", "les", "not"]


TEXT_TABLES = ["documents", "pages", "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    return read_spread(spark, path) if name in TEXT_TABLES else spark.read.parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", "text")


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as posts: `(doc_id, role, text)`."""
    return table(spark, sf_dir, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"), "role", "text"
    )


def posts3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-column posts: every turn, its text in the column of its role."""
    roles = {"doc_text": "user", "image2text": "assistant", "speech2text": "system"}
    texts = [F.when(F.col("role") == role, F.col("text")).alias(name) for name, role in roles.items()]
    return turns(spark, sf_dir).select(F.col("doc_id").alias("post_id"), *texts)


def benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark passages as search queries."""
    return table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("query_id"), "text")

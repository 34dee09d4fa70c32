"""Row filters and validators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlode.functions.cleaning import let
from textlode.functions.tokens import word_count
from textlode.operators.joins import lookup_join


# Stands for "no upper limit" of a word count.
MOST = 2**31 - 1


def words_between(df: DataFrame, col: str, low: int = 1, high: int | None = 30) -> DataFrame:
    """Rows whose text has `low`..`high` words (None: any number above); a blank text has none.

    The words are counted once for both limits; pushed down, each limit would clean the text by itself.
    """
    return df.filter(let(word_count(F.col(col)), lambda n: n.between(low, MOST if high is None else high)))


def min_chars(df: DataFrame, col: str, above: int = 10) -> DataFrame:
    """Rows whose text is longer than `above` characters."""
    return df.filter(F.length(col) > above)


def min_words(df: DataFrame, col: str, least: int = 3) -> DataFrame:
    return df.filter(word_count(F.col(col)) >= least)


def with_max_words_status(df: DataFrame, col: str, limit: int = 30) -> DataFrame:
    """Adds `n_words` and `reason` (null when accepted); nothing raises inside a task."""
    n_words = word_count(F.coalesce(F.col(col), F.lit("")))
    reason = F.when(n_words > limit, F.lit(f"more than {limit} words"))
    return df.withColumns({"n_words": n_words, "reason": reason})


def search_any_column(df: DataFrame, regex: str) -> DataFrame:
    """Rows where any string column matches the regex, ignoring case; null never matches."""
    matched: Column = F.lit(False)
    for field in df.schema.fields:
        if isinstance(field.dataType, T.StringType):
            hit = F.regexp_like(F.col(field.name), F.lit(f"(?iu){regex}"))
            matched = matched | F.coalesce(hit, F.lit(False))
    return df.filter(matched)


def drop_punct(tokens: Column) -> Column:
    """Token structs whose `pos` is not PUNCT; an untagged token stays."""
    return F.filter(tokens, lambda t: F.coalesce(t["pos"], F.lit("")) != "PUNCT")


def with_dimension_status(df: DataFrame, col: str, width: int) -> DataFrame:
    """Adds `dim` and `ok`; vectors of another width are to be rejected."""
    dim = F.coalesce(F.size(col), F.lit(-1))
    return df.withColumns({"dim": dim, "ok": dim == width})


def vector_width(df: DataFrame, col: str = "embedding", default: int = 768) -> int:
    """Width of the first vector, or `default` for an empty table."""
    row = df.filter(F.col(col).isNotNull()).select(F.size(col).alias("dim")).head()
    return row["dim"] if row else default


def validate_hits(hits: DataFrame, tokens: DataFrame, terms: DataFrame) -> DataFrame:
    """Hits `(query_id, doc_id, ..)` whose document has a token with lemma and POS of the query.

    `terms(query_id, lemma, pos)` is the query side, `tokens(doc_id, lemma,
    pos)` the corpus.  The corpus is first reduced to tokens of query terms.
    """
    matched = lookup_join(tokens.select("doc_id", "lemma", "pos"), terms, ["lemma", "pos"])
    return hits.join(matched.select("query_id", "doc_id").distinct(), ["query_id", "doc_id"], "left_semi")

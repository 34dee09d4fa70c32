"""Table schemas of the corpus."""

from __future__ import annotations

from pyspark.sql import types as T

POST_COLUMNS = ["doc_text", "image2text", "speech2text"]

POSTS = T.StructType([T.StructField(name, T.StringType()) for name in POST_COLUMNS])

TOKEN = T.StructType(
    [
        T.StructField("token", T.StringType()),
        T.StructField("lemma", T.StringType()),
        T.StructField("pos", T.StringType()),
        T.StructField("start_clean", T.IntegerType()),
        T.StructField("end_clean", T.IntegerType()),
        T.StructField("start_orig", T.IntegerType()),
        T.StructField("end_orig", T.IntegerType()),
    ]
)

TOKENS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("position", T.IntegerType())]
    + list(TOKEN.fields)
)

VECTORS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
    ]
)

SEARCH_LOG = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("logged_at", T.TimestampType()),
    ]
)

SEARCHES = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("query_text", T.StringType()),
        T.StructField("rank", T.IntegerType()),
        T.StructField("doc_id", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField(
            "positions",
            T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())])),
        ),
        T.StructField("logged_at", T.TimestampType()),
    ]
)

_SPAN = [T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType())]

# What an annotator gives for a text.
ANNOTATED_TOKENS = T.ArrayType(T.StructType([*[T.StructField(n, T.StringType()) for n in ("text", "lemma", "pos", "rel")], *_SPAN]))
ANNOTATED_ENTITIES = T.ArrayType(T.StructType([*[T.StructField(n, T.StringType()) for n in ("text", "lemma", "type")], *_SPAN]))

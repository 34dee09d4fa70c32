"""Annotation by a model that comes as a batch function.

The model is made in the task by a factory and called with batches of bounded size, so nothing of it is pickled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from textlode.functions.cleaning import collapse_ends
from textlode.operators.joins import lookup_join, numbered, quoted, unused
from textlode.schemas import ANNOTATED_ENTITIES, ANNOTATED_TOKENS
from textlode.sources.store import settle

# Rows at most that `annotate_texts` answers at a time, those without a text included.
MOST_ROWS = 1_000

# Forms -> (lemma, part of speech) of each.
FormModel = Callable[[list[str]], list[tuple[str | None, str | None]]]
# Texts -> (tokens, entities) of each, as dictionaries of the fields of `schemas.ANNOTATED_TOKENS` and `ANNOTATED_ENTITIES`.
TextModel = Callable[[list[str]], list[tuple[list[dict], list[dict]]]]


def _batches(values: list, size: int) -> Iterator[list]:
    rest = iter(values)
    while part := list(islice(rest, size)):
        yield part


def _slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Pieces of an Arrow batch with at most `size` texts in the last column, so that no more answers are held at a time."""
    seen = np.cumsum(batch.column(batch.num_columns - 1).is_valid().to_numpy(zero_copy_only=False))
    low = 0
    while low < batch.num_rows:
        before = seen[low - 1] if low else 0
        high = min(int(np.searchsorted(seen, before + size, side="right")), low + MOST_ROWS)
        yield batch.slice(low, high - low)
        low = high


def _answers(model: Callable[[list], list], values: list, size: int) -> list:
    out = []
    for part in _batches(values, size):
        made = list(model(part))
        if len(made) != len(part):
            raise ValueError(f"the annotator returned {len(made)} rows for {len(part)}")
        out += made
    return out


def annotate_forms(rows: DataFrame, factory: Callable[[], FormModel], token: str = "token", batch_size: int = 256) -> DataFrame:
    """Adds `lemma` and `pos` from a model of single forms; every different form is annotated once.

    A form without a lemma is its own.  Null and blank forms are not shown to the model and have no part of speech.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for batch in batches:
            forms = batch.column(0).to_pylist()
            made = _answers(model, forms, batch_size)
            columns = [batch.column(0), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["form", "lemma", "pos"])

    forms = rows.select(quoted(token).alias("form")).filter(F.trim("form") != "").distinct()
    known = settle(forms.mapInArrow(run, "form string, lemma string, pos string")).withColumnRenamed("form", token)
    found = lookup_join(rows.drop("lemma", "pos"), known, [token], "left")
    return found.withColumn("lemma", F.coalesce("lemma", quoted(token)))


def annotate_texts(df: DataFrame, text: str, factory: Callable[[], TextModel], batch_size: int = 32) -> DataFrame:
    """Adds `tokens` (text, lemma, pos, rel, start, stop) and `entities` (text, lemma, type, start, stop) of each text.

    Rows stay rows and keep their order within a task, which holds the answers to `batch_size` texts at a time.  Null and blank texts are not shown to the model and have empty
    lists.  Tokens of one sentence per row feed `extract_triples`; entities need no gazetteer.
    """
    kept = df.drop("tokens", "entities")
    stripped = unused("_stripped", *kept.columns)
    source = kept.withColumn(stripped, F.when(collapse_ends(quoted(text)) != "", quoted(text)))
    source = numbered(source)
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("tokens", ANNOTATED_TOKENS), T.StructField("entities", ANNOTATED_ENTITIES)])
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = factory()
        for whole in batches:
            for batch in _slices(whole, batch_size):
                texts = batch.column(batch.num_columns - 1).to_pylist()
                made = iter(_answers(model, [t for t in texts if t is not None], batch_size))
                rows = [next(made) if t is not None else ([], []) for t in texts]
                tokens = pa.array([list(r[0]) for r in rows], out.field("tokens").type)
                entities = pa.array([list(r[1]) for r in rows], out.field("entities").type)
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], tokens, entities], schema=out)

    return source.mapInArrow(run, schema).toDF(*kept.columns, "tokens", "entities")


def entity_rows(annotated: DataFrame, *keys: str) -> DataFrame:
    """`(keys.., text, lemma, type, start, stop, length)`, one row per entity; length counts words."""
    words: Column = F.size(F.split("e.text", " "))
    rows = annotated.select(*keys, F.explode("entities").alias("e"))
    return rows.select(*keys, "e.text", "e.lemma", "e.type", "e.start", "e.stop", words.alias("length"))

"""The corpus pipeline: toxicity, near copies, leaked benchmark passages, secrets, packing.

Every stage takes `(spark, docs, sf_dir)` and returns a DataFrame; all but the
last return the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlode.llm.common import read
from textlode.llm.decontamination import without_leaks
from textlode.llm.packing import pack_documents
from textlode.llm.partenum import one_per_group
from textlode.llm.secret_scan import redact_secrets
from textlode.llm.toxicity import fit_severity, score_severity
from textlode.operators.joins import quoted
from textlode.sources.store import settle

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected grade of toxicity reaches the threshold go."""
    model = fit_severity(docs, read(spark, sf_dir, "labels"))
    scored = score_severity(docs, model, prefix="_toxicity_")
    return scored.filter(~F.col("_toxicity_rejected")).select(*map(quoted, docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that a similarity of 0.8 of five-word shingles links stays."""
    return one_per_group(docs, k=5, num=4, den=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    return without_leaks(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in the texts are replaced by their kind; every document stays."""
    return redact_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 1,024 tokens."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return pack_documents(docs, ranks, public_tokenizers.PATTERN)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("packing", packing),
]
# Learned weights, similarity joins and tokens have no SQL form; the tests compare every stage with a plain one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each on what its predecessor kept, written and read again."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    return docs

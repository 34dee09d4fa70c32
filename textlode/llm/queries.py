"""The registered queries of this subpackage: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlode.llm.common import read
from textlode.llm.decontamination import find_leaks
from textlode.llm.disclosure import digest, find_disclosures
from textlode.llm.hard_negatives import mine, whole_vectors
from textlode.llm.mask_search import search
from textlode.llm.packing import pack_documents
from textlode.llm.partenum import jaccard_components
from textlode.llm.secret_scan import scan_secrets
from textlode.llm.sharding import shard_by_splitters
from textlode.llm.simhash import near_duplicates
from textlode.llm.site_style import extract_main_text
from textlode.llm.toxicity import fit_severity, score_severity
from textlode.llm.url_reputation import filter_urls, label_outcomes
from textlode.llm.vp_tree import build_trees, nearest, valid_vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_severity(docs, read(spark, sf_dir, "labels"))
    return score_severity(docs, model).drop("text")


@query
def op2_host_reputation(spark, sf_dir):
    return filter_urls(read(spark, sf_dir, "pages"), label_outcomes(read(spark, sf_dir, "labels")))


@query
def op3_decontaminate(spark, sf_dir):
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op4_disclosure(spark, sf_dir):
    return digest(find_disclosures(read(spark, sf_dir, "documents")))


@query
def op5_vp_tree(spark, sf_dir):
    vectors = valid_vectors(read(spark, sf_dir, "embeddings"))
    return nearest(vectors.filter("vec_id % 20 = 0"), build_trees(vectors, 20), 20)


@query
def op6_site_style(spark, sf_dir):
    return extract_main_text(read(spark, sf_dir, "pages"))


@query
def op7_partenum(spark, sf_dir):
    return jaccard_components(read(spark, sf_dir, "documents"))


@query
def op8_splitters(spark, sf_dir):
    return shard_by_splitters(read(spark, sf_dir, "documents"))


@query
def op9_trigram_secrets(spark, sf_dir):
    return scan_secrets(read(spark, sf_dir, "documents"))


@query
def op10_pattern_packing(spark, sf_dir):
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return pack_documents(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op11_shared_lists(spark, sf_dir):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = whole_vectors(read(spark, sf_dir, "embeddings"), label=label)
    return mine(rows, rows.filter("vec_id % 50 = 0"))


@query
def op12_presence_masks(spark, sf_dir):
    return search(read(spark, sf_dir, "benchmark"), read(spark, sf_dir, "documents"))


@query
def op13_covering_simhash(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"))

"""A stored index: term statistics, and blocks of postings with positions.

A block holds the postings of one term in up to 2 ** BLOCK_BITS documents, so that no row grows with the corpus,
and the largest share of a score that any of them can have.  Rows lie in folders by a hash of the term and in the order of terms.  A
search reads the folders of its terms only, and of their blocks those that can reach its list; phrases are
found by intersecting positions.  No text is read.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textlode.functions.vectors import rounded
from textlode.operators.bm25 import B, EPSILON, K1
from textlode.operators.joins import lookup_join, top_per_group, within
from textlode.operators.tokens import analyze, annotate_tokens, explode_rows
from textlode.sources.store import settle

BLOCK_BITS = 9
BUCKETS = 64
# Query terms that the scan is told by name; the folders of more terms are read whole.
NAMED_TERMS = 1_000
# Blocks of each query that are scored first, for a bound on the rest.
FIRST_BLOCKS = 2
# More than two scores of six digits can differ by rounding.
SLACK = 2e-6

POSTINGS = (
    "bucket int, term string, block long, docs array<struct<no:int,doc_id:long,dl:int,tf:int>>, most double, "
    "codes array<long>, starts array<int>, stops array<int>"
)
TERMS = "bucket int, term string, df long, idf double"


class Index(NamedTuple):
    """`postings(term, block, docs, most, codes, starts, stops)`, `terms(term, df, idf)` and the parameters of the scores.

    `docs` lists (no, doc_id, dl, tf) by place in the block; `codes` are all positions, no * 2 ** 32 + place in the document, ascending.
    """

    postings: DataFrame
    terms: DataFrame
    n_docs: int
    avgdl: float
    k1: float
    b: float


def _bucket(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(BUCKETS)).cast("int")


def _share(tf: Column, dl: Column, k1: float, b: float, avgdl: float) -> Column:
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))


def write_index(
    docs: DataFrame, path: str, lexicon: DataFrame | None = None, text: str = "text", k1: float = K1, b: float = B, epsilon: float = EPSILON
) -> Index:
    """Indexes `docs(doc_id, <text>)` by the lemmas, or without a lexicon the words, of the cleaned text.

    Every row is a document, also one without words, which only counts.  The texts are analysed once; tokens move once, by
    term and block, so that a word of all documents is no hot key.
    """
    spark = docs.sparkSession
    slim = F.transform("tokens", lambda t: F.struct(t["token"].alias("token"), t["start_orig"].alias("start"), t["end_orig"].alias("stop")))
    analyzed = analyze(docs.select("doc_id", text), text).select("doc_id", slim.alias("tokens"))
    # Numbers of rows of a partition are consecutive; once written, they stay.
    numbered = settle(analyzed.withColumn("uid", F.monotonically_increasing_id()))
    numbered = numbered.select(
        "doc_id", "tokens", F.size("tokens").alias("dl"), F.shiftright("uid", BLOCK_BITS).alias("block"),
        F.col("uid").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1)).cast("int").alias("no"),
    )
    whole = numbered.agg(F.count("*").alias("n"), F.coalesce(F.avg("dl"), F.lit(0.0)).alias("avgdl")).head()
    avgdl = whole.avgdl or 1.0
    rows = explode_rows(numbered, "tokens", "at", "t", "block", "no", "doc_id", "dl").select("*", "t.token", "t.start", "t.stop").drop("t")
    if lexicon is None:
        rows = rows.withColumn("term", F.col("token"))
    else:
        rows = annotate_tokens(rows, lexicon).withColumn("term", F.col("lemma"))
    rows = rows.repartition("term", "block")
    each = rows.groupBy("term", "block", "no", "doc_id", "dl").agg(
        F.count("*").cast("int").alias("tf"), F.sort_array(F.collect_list(F.struct("at", "start", "stop"))).alias("places")
    )
    listed = each.groupBy("term", "block").agg(F.sort_array(F.collect_list(F.struct("no", "doc_id", "dl", "tf", "places"))).alias("l"))

    def flat(field):
        return F.flatten(F.transform("l", lambda d: F.transform(d["places"], lambda p: field(d, p))))

    postings = listed.select(
        _bucket(F.col("term")).alias("bucket"),
        "term",
        "block",
        F.transform("l", lambda d: F.struct(*[d[c].alias(c) for c in ("no", "doc_id", "dl", "tf")])).alias("docs"),
        F.array_max(F.transform("l", lambda d: _share(d["tf"], d["dl"], k1, b, avgdl))).alias("most"),
        flat(lambda d, p: F.shiftleft(d["no"].cast("long"), 32) + p["at"]).alias("codes"),
        flat(lambda d, p: p["start"]).alias("starts"),
        flat(lambda d, p: p["stop"]).alias("stops"),
    )
    order = ["bucket", "term", "block"]
    laid = postings.repartitionByRange(*order).sortWithinPartitions(*order)
    laid.write.partitionBy("bucket").option("parquet.bloom.filter.enabled#term", True).parquet(f"{path}/postings")

    counts = settle(spark.read.schema(POSTINGS).parquet(f"{path}/postings").groupBy("bucket", "term").agg(F.sum(F.size("docs")).alias("df")))
    raw = F.log(F.lit(whole.n) - F.col("df") + 0.5) - F.log(F.col("df") + 0.5)
    mean = counts.agg(F.avg(raw)).head()[0]
    terms = counts.select("bucket", "term", "df", F.when(raw < 0, F.lit(epsilon) * F.lit(mean)).otherwise(raw).alias("idf"))
    terms.repartitionByRange("bucket", "term").sortWithinPartitions("bucket", "term").write.partitionBy("bucket").parquet(f"{path}/terms")
    spark.createDataFrame([(whole.n, avgdl, k1, b)], "n_docs long, avgdl double, k1 double, b double").write.parquet(f"{path}/stats")
    return open_index(spark, path)


def open_index(spark: SparkSession, path: str) -> Index:
    """The index stored at `path`; ids come back as 64-bit numbers."""
    stats = spark.read.parquet(f"{path}/stats").head()
    postings, terms = (spark.read.schema(s).parquet(f"{path}/{n}") for n, s in (("postings", POSTINGS), ("terms", TERMS)))
    return Index(postings, terms, stats.n_docs, stats.avgdl, stats.k1, stats.b)


def of_terms(table: DataFrame, wanted: DataFrame) -> DataFrame:
    """The part of `postings` or `terms` that the folders, and for few terms the files' statistics, say may hold `wanted(term)`."""
    buckets = [r.bucket for r in wanted.select(_bucket(F.col("term")).alias("bucket")).distinct().collect()]
    part = table.filter(F.col("bucket").isin(buckets))
    names = wanted.select("term").distinct()
    if within(names, NAMED_TERMS):
        part = part.filter(F.col("term").isin([r.term for r in names.collect()]))
    return part.drop("bucket")


def weights(terms: DataFrame, index: Index) -> DataFrame:
    """`(query_id, term, weight)` of the terms that the index holds, from `terms(query_id, term, qtf)`."""
    known = lookup_join(of_terms(index.terms, terms), terms.select("query_id", "term", "qtf"), ["term"])
    return settle(known.select("query_id", "term", (F.col("qtf") * F.col("idf")).alias("weight")))


def block_bounds(weighted: DataFrame, index: Index) -> DataFrame:
    """`(query_id, block, bound)`: no document of the block has a higher score; blocks without a query term have no row."""
    heads = of_terms(index.postings, weighted).select("term", "block", "most")
    most = F.greatest(F.lit(0.0), F.col("weight") * F.col("most"))
    return lookup_join(heads, weighted, ["term"]).groupBy("query_id", "block").agg(F.sum(most).alias("bound"))


def _scored(pairs: DataFrame, weighted: DataFrame, index: Index, digits: int) -> DataFrame:
    """`(query_id, block, no, doc_id, dl, score)` of all documents of `pairs(query_id, block)` with a query term."""
    wanted = settle(pairs.join(weighted, "query_id"))
    # A term has one row in a block, so no key is hot and one copy will do.
    found = lookup_join(of_terms(index.postings, wanted).select("term", "block", "docs"), wanted, ["term", "block"], salts=1)
    rows = found.select("query_id", "block", "weight", F.inline("docs"))
    part = F.col("weight") * _share(F.col("tf"), F.col("dl"), index.k1, index.b, index.avgdl)
    return rows.groupBy("query_id", "block", "no", "doc_id", "dl").agg(rounded(F.sum(part), digits).alias("score"))


def search_index(terms: DataFrame, index: Index, n: int, digits: int = 6) -> DataFrame:
    """The `n` best documents of each query by BM25: `(query_id, doc_id, dl, score, rank, block)`; ties go to the smaller id.

    `terms(query_id, term, qtf)`.  The blocks with the highest bounds are scored first; of the others only
    those that can still reach the n-th best score found there.
    """
    weighted = weights(terms, index)
    bounds = settle(block_bounds(weighted, index))
    order = [F.desc("score"), F.asc("doc_id")]
    ahead = settle(top_per_group(bounds, ["query_id"], [F.desc("bound"), F.asc("block")], FIRST_BLOCKS).select("query_id", "block"))
    first = settle(top_per_group(_scored(ahead, weighted, index, digits), ["query_id"], order, n).drop("rank"))
    least = first.groupBy("query_id").agg(F.when(F.count("*") >= n, F.min("score")).alias("least"))
    open_ = bounds.join(least, "query_id", "left").filter(F.col("least").isNull() | (F.col("bound") >= F.col("least") - SLACK))
    rest = settle(open_.select("query_id", "block").join(ahead, ["query_id", "block"], "left_anti"))
    best = top_per_group(first.unionByName(_scored(rest, weighted, index, digits)), ["query_id"], order, n)
    return best.select("query_id", "doc_id", "dl", "score", "rank", "block")


def _phrase_blocks(phrases: DataFrame, index: Index) -> DataFrame:
    """`(phrase, block)`: blocks that hold the rarest word of a phrase; a phrase with an unknown word has none."""
    words = phrases.select("phrase", F.explode(F.array_distinct(F.split("phrase", " "))).alias("term"))
    known = lookup_join(of_terms(index.terms, words).select("term", "df"), words, ["term"])
    rarest = known.groupBy("phrase").agg(F.count("*").alias("n"), F.min_by("term", F.struct("df", "term")).alias("term"))
    whole = settle(rarest.filter(F.size(F.array_distinct(F.split("phrase", " "))) == F.col("n")).select("phrase", "term"))
    return lookup_join(of_terms(index.postings, whole).select("term", "block"), whole, ["term"]).select("phrase", "block")


def find_phrases(asked: DataFrame, index: Index, blocks: DataFrame | None = None) -> DataFrame:
    """`(phrase, doc_id, start, stop, block)`: all places of the phrases of `asked(phrase)`, words of the index with a space between.

    Phrases of any number of words; places are those of the original text.  `blocks(phrase, block)` restricts the search.  A
    task holds the asked terms' postings of one block and meets each phrase with them, rarest word first.
    """
    import numpy as np
    import pyarrow as pa

    phrases = settle(asked.select("phrase").filter("phrase <> ''").distinct())
    pairs = settle(_phrase_blocks(phrases, index) if blocks is None else blocks.select("phrase", "block").distinct())
    words = settle(pairs.select("block", F.explode(F.array_distinct(F.split("phrase", " "))).alias("term")).distinct())
    lists = lookup_join(of_terms(index.postings, words).select("term", "block", "docs", "codes", "starts", "stops"), words, ["block", "term"], salts=1)

    def meet(postings: pa.Table, asked: pa.Table) -> pa.Table:
        at = {t: i for i, t in enumerate(postings.column("term").to_pylist())}

        def lists(name: str) -> list:
            column = postings.column(name).combine_chunks()
            return [column[i].values for i in range(len(column))]

        codes = [c.to_numpy() for c in lists("codes")]
        docs, starts, stops = lists("docs"), lists("starts"), lists("stops")
        out: dict[str, list] = {"phrase": [], "doc_id": [], "start": [], "stop": []}
        for phrase in asked.column("phrase").to_pylist():
            own = [at.get(w) for w in phrase.split(" ")]
            if None in own:
                continue
            order = sorted(range(len(own)), key=lambda k: len(codes[own[k]]))
            found = codes[own[order[0]]] - order[0]
            # A place before the document's first word would be one of the document before.
            found = found[(found & 0xFFFFFFFF) <= (codes[own[order[0]]] & 0xFFFFFFFF)]
            for k in order[1:]:
                other = codes[own[k]]
                place = np.minimum(np.searchsorted(other, found + k), len(other) - 1)
                found = found[other[place] == found + k]
            if not len(found):
                continue
            first, last = own[0], own[-1]
            numbers = docs[first].field("no").to_numpy()
            ids = docs[first].field("doc_id").take(pa.array(np.searchsorted(numbers, found >> 32)))
            out["phrase"].append(pa.array([phrase] * len(found)))
            out["doc_id"].append(ids.cast(pa.int64()))
            out["start"].append(starts[first].take(pa.array(np.searchsorted(codes[first], found))))
            out["stop"].append(stops[last].take(pa.array(np.searchsorted(codes[last], found + len(own) - 1))))
        kinds = {"phrase": pa.string(), "doc_id": pa.int64(), "start": pa.int32(), "stop": pa.int32()}
        columns = {n: pa.chunked_array(parts, kinds[n]) for n, parts in out.items()}
        size = len(columns["phrase"])
        return pa.table({**columns, "block": pa.array([asked.column("block")[0].as_py() if asked.num_rows else None] * size, pa.int64())})

    return lists.groupBy("block").cogroup(pairs.groupBy("block")).applyInArrow(meet, "phrase string, doc_id long, start int, stop int, block long")

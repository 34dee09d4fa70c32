"""The registered queries: every operator on the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textlode import schemas
from textlode.functions import cleaning as C
from textlode.functions import tokens as T
from textlode.functions import vectors as V
from textlode.operators import annotate, bm25, corpus, filters, lexicon, postings, profile, ranking
from textlode.operators import tokens as K
from textlode.operators import vectors as E
from textlode.operators.joins import lookup_join, spread_by, top_per_group
from textlode.plans import fixtures as X
from textlode.plans import index, search
from textlode.session import fresh_dir
from textlode.sources import posts, store
from textlode.streaming import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# Sources and sinks


@query
def scan_csv_union(spark, sf):
    turns = X.table(spark, sf, "conversations")
    folder = fresh_dir(spark, "csv")
    mine = F.col("role") == "user"
    posts.write_csv(turns.filter(mine).drop("role"), f"{folder}/user.csv")
    posts.write_csv(turns.filter(~mine), f"{folder}/other.csv")
    back = posts.read_posts(spark, folder)
    return back.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text"
    )


@query
def scan_pruned(spark, sf):
    folder = fresh_dir(spark, "csv")
    posts.write_csv(X.posts3(spark, sf).drop("post_id"), f"{folder}/posts.csv")
    read = posts.read_posts(spark, folder, schemas.POSTS)
    return posts.read_column(read, "doc_text")


@query
def scan_headerless(spark, sf):
    path = fresh_dir(spark, "csv")
    posts.write_csv(X.posts3(spark, sf).drop("post_id"), path, header=False)
    return posts.read_csv(spark, path, schemas.POSTS, header=False)


@query
def scan_file_filter(spark, sf):
    turns = X.turns(spark, sf).select("doc_id", "text")
    folder = fresh_dir(spark, "csv")
    posts.write_csv(turns, f"{folder}/turns.csv")
    posts.write_csv(turns, f"{folder}/combined_turns.csv")
    back = posts.read_posts(spark, folder, skip_prefix="combined")
    return back.select(F.col("doc_id").cast("long"), "text")


@query
def rows_per_file(spark, sf):
    folder = fresh_dir(spark, "csv")
    X.turns(spark, sf).write.options(**posts.CSV_OPTIONS).option("header", True).partitionBy(
        "role"
    ).csv(folder)
    counts = posts.rows_per_file(posts.read_csv(spark, folder, tolerant=True))
    role = F.regexp_extract("file_path", "role=([^/]+)/", 1).alias("role")
    return counts.groupBy(role).agg(F.sum("n").alias("n"))


@query
def sink_csv_roundtrip(spark, sf):
    cleaned = C.clean_columns(X.posts3(spark, sf).drop("post_id"), schemas.POST_COLUMNS)
    path = fresh_dir(spark, "csv")
    posts.write_csv(cleaned, path)
    return posts.read_csv(spark, path, schemas.POSTS)


@query
def write_corpus(spark, sf):
    base = fresh_dir(spark, "corpus")
    index.load_corpus(X.turns(spark, sf), base, spark.sql(X.LEMMA_LEXICON))
    tokens = store.read_version(spark, base, "tokens")
    documents = store.read_version(spark, base, "documents").select("doc_id", "cleaned_text")
    columns = ["doc_id", "cleaned_text", "position", "token", "lemma", "pos", "start_clean", "end_clean", "start_orig", "end_orig"]
    return documents.join(tokens, "doc_id").select(*columns)


@query
def vectors_roundtrip(spark, sf):
    base = fresh_dir(spark, "vectors")
    vectors = X.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    late = F.col("doc_id") > 100
    store.append_version(spark, base, {"vectors": vectors.filter(~late)})
    store.append_version(spark, base, {"vectors": vectors.filter(late)})
    back = store.read_version(spark, base, "vectors")
    return back.select("doc_id", F.posexplode("embedding").alias("dim", "x")).select(
        "doc_id", "dim", V.rounded(F.col("x").cast("double")).alias("x")
    )


@query
def append_corpus(spark, sf):
    """Documents arrive in two appends; the vectors written before stay readable."""
    base = fresh_dir(spark, "corpus")
    docs = X.documents(spark, sf)
    vectors = X.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    store.write_version(spark, base, {"vectors": vectors})
    for odd in (0, 1):
        store.append_version(spark, base, {"documents": docs.filter(F.col("doc_id") % 2 == odd)})
    width = F.size("embedding").alias("width")
    stored = store.read_version(spark, base, "vectors").select("doc_id", width)
    return store.read_version(spark, base, "documents").join(stored, "doc_id", "left")


@query
def delete_version(spark, sf):
    base = fresh_dir(spark, "corpus")
    store.write_version(spark, base, {"documents": X.documents(spark, sf)})
    _, hits = store.delete_version(spark, base, _toxic(spark, sf), ["documents"])
    return store.read_version(spark, base, "documents").withColumn("n_deleted", F.lit(hits).cast("long"))


@query
def vectors_load_or_create(spark, sf):
    base = fresh_dir(spark, "vectors")
    empty = store.load_or_create(spark, base, "vectors", schemas.VECTORS)
    stored = X.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    store.write_version(spark, base, {"vectors": empty.unionByName(stored)})
    return _vector_rows(store.load_or_create(spark, base, "vectors", schemas.VECTORS), "doc_id")


@query
def search_log(spark, sf):
    path = fresh_dir(spark, "log")
    store.log_hits(semantic_search(spark, sf).withColumnRenamed("vec_id", "doc_id"), path)
    # The time of the search is the only column that differs from run to run.
    return spark.read.schema(schemas.SEARCH_LOG).parquet(path).drop("logged_at")


@query
def search_log_positions(spark, sf):
    """Logged searches with their texts and the places of their words and pairs, read back one place a row."""
    path = fresh_dir(spark, "log")
    places = store.settle(phrase_positions(spark, sf))
    hits = places.groupBy("query_id", "doc_id").agg(F.max("score").alias("score"))
    ranked = top_per_group(hits, ["query_id"], [F.desc("score"), F.asc("doc_id")], 5)
    store.log_searches(ranked, X.benchmark_queries(spark, sf), places, path)
    log = spark.read.schema(schemas.SEARCHES).parquet(path)
    return log.select("query_id", "query_text", "rank", "doc_id", "score", F.inline("positions"))


# Cleaning


def _cleaned(spark, sf, clean) -> DataFrame:
    return X.documents(spark, sf).select("doc_id", clean(F.col("text")).alias("clean"))


def _cleaned_pages(spark, sf, clean) -> DataFrame:
    pages = X.table(spark, sf, "pages")
    return pages.select("page_id", clean(F.concat_ws(" ", "url", "html")).alias("clean"))


@query
def clean_flags(spark, sf):
    return _cleaned_pages(
        spark, sf, lambda c: C.preprocess(c, replace_yo=False, remove_emoji=False, remove_punctuation=False)
    )


@query
def clear_text(spark, sf):
    return _cleaned(spark, sf, C.clear_text)


@query
def clean_for_search(spark, sf):
    return _cleaned_pages(spark, sf, C.clean_for_search)


@query
def clean_for_embedding(spark, sf):
    return _cleaned_pages(spark, sf, C.clean_for_embedding)


@query
def clean_for_display(spark, sf):
    return _cleaned_pages(spark, sf, C.clean_for_display)


@query
def clean_social(spark, sf):
    return _cleaned_pages(spark, sf, C.clean_social)


@query
def clean_simple(spark, sf):
    return _cleaned(spark, sf, C.clean_simple)


@query
def clean_words(spark, sf):
    return _cleaned(spark, sf, C.clean_words)


@query
def clean_underscore(spark, sf):
    return _cleaned_pages(spark, sf, C.clean_underscore)


@query
def clean_alnum(spark, sf):
    return _cleaned(spark, sf, C.clean_alnum)


@query
def clean_columns(spark, sf):
    return C.clean_columns(X.posts3(spark, sf), [*schemas.POST_COLUMNS, "absent"])


@query
def processed_text(spark, sf):
    return _cleaned(spark, sf, C.processed_text)


@query
def merge_fields(spark, sf):
    fields = [F.col(c) for c in schemas.POST_COLUMNS]
    return X.posts3(spark, sf).select("post_id", C.merge_fields(*fields).alias("merged"))


@query
def fill_nulls(spark, sf):
    return C.fill_nulls(X.posts3(spark, sf))


@query
def slang_normalise(spark, sf):
    return K.replace_slang(X.documents(spark, sf), "doc_id", "text", spark.sql(X.SLANG))


# Filters


@query
def filter_words(spark, sf):
    limited = X.turns(spark, sf).withColumn("clean", C.processed_text(F.col("text")))
    return filters.words_between(limited, "clean", 1, 30).select("doc_id", "clean")


@query
def filter_min_chars(spark, sf):
    split = K.split_sentences(X.documents(spark, sf), "text", "doc_id")
    return filters.min_chars(split, "sentence", 10)


@query
def filter_min_words(spark, sf):
    split = K.split_sentences(X.documents(spark, sf), "text", "doc_id")
    return filters.min_words(split, "sentence", 3)


@query
def validate_max_words(spark, sf):
    return filters.with_max_words_status(X.turns(spark, sf), "text", 30).select(
        "doc_id", "n_words", "reason"
    )


@query
def search_any_column(spark, sf):
    docs = X.table(spark, sf, "documents")
    return filters.search_any_column(docs, r"^src1\d$|\bthe\s+and\b|ÉAU").select("doc_id", "source")


@query
def drop_punct(spark, sf):
    marked = F.regexp_replace("text", "([.,!?])", " $1 ")
    tokens = F.transform(
        T.words(marked),
        lambda w: F.struct(
            w.alias("token"),
            F.when(w.isin(".", ",", "!", "?"), F.lit("PUNCT")).alias("pos"),
        ),
    )
    kept = filters.drop_punct(F.col("tokens"))
    return (
        X.documents(spark, sf)
        .select("doc_id", tokens.alias("tokens"))
        .select("doc_id", F.array_join(F.transform(kept, lambda t: t["token"]), " ").alias("kept"))
    )


@query
def vector_dim_check(spark, sf):
    vectors = X.table(spark, sf, "embeddings")
    # Vectors of one label are cut short, so that both outcomes occur.
    mixed = vectors.withColumn(
        "embedding",
        F.when(F.col("label") == 3, F.slice("embedding", 1, 32)).otherwise(F.col("embedding")),
    )
    return filters.with_dimension_status(mixed, "embedding", 64).select("vec_id", "dim", "ok")


def _annotated(spark, sf) -> DataFrame:
    """Token rows of the conversation turns, with lemma and part of speech."""
    clean = X.turns(spark, sf).select("doc_id", C.clear_text(F.col("text")).alias("clean"))
    spans = clean.select("doc_id", F.posexplode(T.token_spans(F.col("clean"))).alias("position", "t"))
    rows = spans.select("doc_id", "position", "t.token", "t.start_clean", "t.end_clean")
    return K.annotate_tokens(rows, spark.sql(X.LEMMA_LEXICON))


@query
def validate_pos(spark, sf):
    queries = X.benchmark_queries(spark, sf)
    docs = _clean_turns(spark, sf)
    hits = search.bm25_search(queries, docs, 10).select("query_id", "doc_id", "rank")
    tokens = K.annotate_tokens(
        search.words_as_terms(queries).withColumnRenamed("term", "token"), spark.sql(X.LEMMA_LEXICON)
    )
    verbs = tokens.filter(F.col("pos") == "VERB").select("query_id", "lemma", "pos").distinct()
    return filters.validate_hits(hits, _annotated(spark, sf), verbs)


# Tokens, spans, annotation


@query
def tokenize(spark, sf):
    docs = X.documents(spark, sf)
    return docs.select("doc_id", F.posexplode(T.words(F.col("text"))).alias("position", "token"))


@query
def sentences(spark, sf):
    return K.split_sentences(X.documents(spark, sf), "text", "doc_id")


@query
def token_spans(spark, sf):
    clean = _cleaned(spark, sf, C.clear_text)
    rows = clean.select("doc_id", F.posexplode(T.token_spans(F.col("clean"))).alias("position", "t"))
    return rows.select("doc_id", "position", "t.token", "t.start_clean", "t.end_clean")


@query
def char_map(spark, sf):
    mapped = X.turns(spark, sf).select(
        "doc_id", T.greedy_map(F.col("text")).alias("mapping")
    )
    return K.explode_rows(mapped, "mapping", "clean_at", "original", "doc_id")


def _analyzed_turns(spark, sf) -> DataFrame:
    return K.analyze(X.turns(spark, sf).select("doc_id", "text"))


@query
def span_to_original(spark, sf):
    return K.token_rows(_analyzed_turns(spark, sf), "doc_id").select(
        "doc_id", "position", "start_orig", "end_orig"
    )


@query
def lemmatize_lexicon(spark, sf):
    return _annotated(spark, sf).select("doc_id", "position", "token", "lemma", "pos")


def _suffix_model():
    """A deterministic stand-in for a lemmatiser: a final s goes, the length tells the part of speech."""
    return lambda forms: [(f.removesuffix("s") or f, "NOUN" if len(f) % 2 else "VERB") for f in forms]


def _sentence_model():
    """A deterministic stand-in for a parser: words are subject, verb and object by turns, long ones are entities."""

    def one(text):
        tokens, entities, at = [], [], 0
        for n, word in enumerate(text.split(" ")):
            span = {"text": word, "lemma": word.removesuffix("s") or word, "start": at, "stop": at + len(word)}
            tokens.append(span | {"pos": "NOUN" if len(word) % 2 else "VERB", "rel": ("nsubj", "root", "obj")[n % 3]})
            if len(word) > 9:
                entities.append(span | {"type": "ORG"})
            at += len(word) + 1
        return tokens, entities

    return lambda texts: [one(t) for t in texts]


@query
def annotate_forms(spark, sf):
    split = X.turns(spark, sf).select("doc_id", F.posexplode(T.clean_words_of(C.clear_text(F.col("text")))).alias("position", "token"))
    return annotate.annotate_forms(split, _suffix_model).select("doc_id", "position", "token", "lemma", "pos")


def _annotated_texts(spark, sf) -> DataFrame:
    clean = X.turns(spark, sf).select("doc_id", C.clear_text(F.col("text")).alias("clean"))
    return annotate.annotate_texts(clean, "clean", _sentence_model)


@query
def annotate_triples(spark, sf):
    return K.extract_triples(_annotated_texts(spark, sf), "doc_id")


@query
def annotate_entities(spark, sf):
    return annotate.entity_rows(_annotated_texts(spark, sf), "doc_id")


@query
def truncate_tokens(spark, sf):
    clean = _cleaned(spark, sf, C.clear_text).withColumn("tokens", T.clean_words_of(F.col("clean")))
    cut = T.truncate_tokens(F.col("tokens"), 30)
    return clean.select("doc_id", F.size(cut).alias("n"), F.array_join(cut, " ").alias("clean"))


@query
def unigram_bigram(spark, sf):
    lemmas = F.transform("tokens", lambda t: t["lemma"])
    return _clean_phrase_tokens(spark, sf).select("doc_id", F.inline(T.unigrams_bigrams(lemmas)))


def _clean_phrase_tokens(spark, sf) -> DataFrame:
    spans = _clean_turns(spark, sf).select(
        "doc_id", T.token_spans(F.col("clean")).alias("tokens")
    )
    return K.lemmatise(K.phrase_tokens(spans, "", spans="clean"), spark.sql(X.LEMMA_LEXICON), "doc_id")


@query
def phrases(spark, sf):
    return K.phrase_rows(_clean_phrase_tokens(spark, sf), "doc_id")


@query
def phrases_in_sentence(spark, sf):
    split = K.split_sentences(X.turns(spark, sf), "text", "doc_id").select(
        "doc_id", "sent", T.token_spans(C.clear_text(F.col("sentence"))).alias("tokens")
    )
    lemmas = K.lemmatise(K.phrase_tokens(split, "", spans="clean"), spark.sql(X.LEMMA_LEXICON), "doc_id", "sent")
    return K.phrase_rows(lemmas, "doc_id", "sent")


def _entities(spark, sf) -> DataFrame:
    return K.extract_entities(_clean_phrase_tokens(spark, sf), spark.sql(X.GAZETTEER), "doc_id")


@query
def entities_gazetteer(spark, sf):
    return _entities(spark, sf)


@query
def entities_any_length(spark, sf):
    """Names of two to seven words: how the benchmark passages begin, in the documents."""
    lemmas = lexicon.query_lemmas(X.benchmark_queries(spark, sf), spark.sql(X.LEMMA_LEXICON))
    begins = []
    for n, kind in ((2, "PER"), (3, "LOC"), (5, "ORG"), (7, "ORG")):
        words = F.array_sort(F.collect_list(F.struct("position", "term")))
        first = lemmas.filter(F.col("position") < n).groupBy("query_id").agg(words.alias("w")).filter(F.size("w") == n)
        name = F.array_join(F.transform("w", lambda x: x["term"]), " ")
        begins.append(first.select(name.alias("phrase_lemma"), F.lit(kind).alias("type"), F.upper(name).alias("normal")))
    gazetteer = corpus.union_all(*begins).distinct()
    docs = _cleaned(spark, sf, C.clear_text).select("doc_id", "clean", T.token_spans(F.col("clean")).alias("tokens"))
    tokens = K.lemmatise(K.phrase_tokens(docs, "clean", spans="clean"), spark.sql(X.LEMMA_LEXICON), "doc_id")
    return K.extract_entities(tokens, gazetteer, "doc_id")


def _triples(df: DataFrame, key: str) -> DataFrame:
    """The words of a sentence are subject, verb and object by turns."""
    split = K.split_sentences(df, "text", key)
    roles = F.array(F.lit("nsubj"), F.lit("root"), F.lit("obj"))
    tokens = F.transform(
        T.clean_words_of(C.clear_text(F.col("sentence"))),
        lambda w, i: F.struct(w.alias("lemma"), F.get(roles, i % 3).alias("rel")),
    )
    return K.extract_triples(split.select(key, "sent", tokens.alias("tokens")), key, "sent")


@query
def triples_from_rel(spark, sf):
    return _triples(X.documents(spark, sf), "doc_id")


@query
def nested_document(spark, sf):
    nested = K.nested_document(X.turns(spark, sf), "text", _entities(spark, sf))
    words = F.flatten(F.transform("sentences", lambda s: F.transform(s["tokens"], lambda t: t["token"])))
    return nested.select(
        "doc_id",
        "clean_text",
        F.size("sentences").alias("n_sentences"),
        F.array_join(words, " ").alias("words"),
        F.array_join(F.transform("entities", lambda e: e["lemma"]), " ").alias("entities"),
    )


@query
def slice_original(spark, sf):
    cut = T.slices(F.col("text"), F.col("tokens"), lambda span, text: text)
    sliced = _analyzed_turns(spark, sf).select("doc_id", cut.alias("slices"))
    return K.explode_rows(sliced, "slices", "position", "slice", "doc_id")


@query
def tokens_json_roundtrip(spark, sf):
    analyzed = _analyzed_turns(spark, sf)
    kind = analyzed.schema["tokens"].dataType.simpleString()
    texts = analyzed.select(
        "doc_id", F.to_json("tokens").alias("tokens"), F.to_json("mapping").alias("mapping")
    )
    back = texts.select(
        "doc_id",
        F.from_json("tokens", kind).alias("tokens"),
        F.from_json("mapping", "array<int>").alias("mapping"),
    )
    return back.select("doc_id", F.size("mapping").alias("n_mapping"), F.inline_outer("tokens"))


# Query expansion


def _lemmas(spark, sf) -> DataFrame:
    return lexicon.query_lemmas(X.benchmark_queries(spark, sf), spark.sql(X.LEMMA_LEXICON))


@query
def expand_synonyms(spark, sf):
    return lexicon.expand_synonyms(_lemmas(spark, sf), spark.sql(X.SYNONYMS))


@query
def expand_capped(spark, sf):
    return lexicon.expand_synonyms_capped(_lemmas(spark, sf), spark.sql(X.SYNONYMS))


@query
def process_query(spark, sf):
    processed = lexicon.process_query(
        X.benchmark_queries(spark, sf), spark.sql(X.LEMMA_LEXICON), spark.sql(X.SYNONYMS)
    )
    return processed.select(
        "query_id",
        "clean_query",
        F.array_join("lemmas", " ").alias("lemmas"),
        F.array_join("expanded_terms", " ").alias("expanded_terms"),
    )


@query
def synset_siblings(spark, sf):
    rows = bm25.term_rows(_clean_turns(spark, sf))
    words = rows.select(F.col("term").alias("word")).distinct()
    return lexicon.synset_siblings(words, spark.sql(X.SYNONYMS))


# Vectors


def _clean_turns(spark, sf) -> DataFrame:
    return X.turns(spark, sf).select("doc_id", C.clear_text(F.col("text")).alias("clean"))


def _vector_rows(df: DataFrame, key: str, col: str = "embedding") -> DataFrame:
    exploded = K.explode_rows(df, col, "dim", "x", key)
    return exploded.select(key, "dim", V.rounded(F.col("x").cast("double")).alias("x"))


@query
def embed_hash(spark, sf):
    docs = _cleaned(spark, sf, C.clear_text)
    return _vector_rows(docs.select("doc_id", V.hash_embedding(F.col("clean")).alias("embedding")), "doc_id")


@query
def embed_tfidf(spark, sf):
    vectors = E.embed_tfidf(_cleaned(spark, sf, C.clear_text))
    return _vector_rows(vectors, "doc_id").withColumn("x", V.rounded(F.col("x")))


def _centroids(spark, sf) -> DataFrame:
    """One query per label: the mean of the label's vectors."""
    vectors = X.table(spark, sf, "embeddings")
    pooled = E.mean_pool(vectors, "label", "embedding", F.lit(1))
    return pooled.withColumnRenamed("label", "query_id")


@query
def mean_pool(spark, sf):
    vectors = X.table(spark, sf, "embeddings")
    mask = F.get("embedding", F.lit(0)) >= 0
    return _vector_rows(E.mean_pool(vectors, "label", "embedding", mask), "label")


@query
def l2_normalize(spark, sf):
    vectors = X.table(spark, sf, "embeddings")
    scaled = F.transform("embedding", lambda x: x.cast("double") * (F.col("label") * 2))
    unit = vectors.select("vec_id", scaled.alias("scaled")).select(
        "vec_id", V.l2_normalize(F.col("scaled")).alias("embedding")
    )
    return _vector_rows(unit, "vec_id")


@query
def knn_ip(spark, sf):
    vectors = X.table(spark, sf, "embeddings")
    return E.top_k_vectors(_centroids(spark, sf), vectors, 10, "ip", "vec_id")


@query
def knn_l2(spark, sf):
    vectors = X.table(spark, sf, "embeddings")
    return E.top_k_vectors(_centroids(spark, sf), vectors, 10, "l2", "vec_id")


@query
def knn_all(spark, sf):
    """Every vector as a query against all vectors."""
    vectors = X.table(spark, sf, "embeddings").select("vec_id", "embedding")
    return E.top_k_pruned(vectors.withColumnRenamed("vec_id", "query_id"), vectors, 5, "l2", "vec_id")


@query
def cosine_pairs(spark, sf):
    anchors = _centroids(spark, sf).select(
        F.col("query_id").alias("label"), F.col("embedding").alias("anchor")
    )
    return E.cosine_pairs(X.table(spark, sf, "embeddings"), anchors, "label").select(
        "vec_id", "label", "cosine"
    )


@query
def vector_count(spark, sf):
    return E.vector_count(X.table(spark, sf, "embeddings"))


# Retrieval


@query
def semantic_search(spark, sf):
    return search.semantic_search(
        _centroids(spark, sf), X.table(spark, sf, "embeddings"), 5, 0.4, "vec_id"
    )


@query
def bm25_scores(spark, sf):
    terms = bm25.query_terms(search.words_as_terms(X.benchmark_queries(spark, sf)))
    return bm25.bm25_scores(terms, bm25.term_rows(_cleaned(spark, sf, C.clear_text)))


@query
def bm25_top_n(spark, sf):
    docs = _cleaned(spark, sf, C.clear_text)
    hits = search.bm25_search(X.benchmark_queries(spark, sf), docs, 10)
    return hits.select("query_id", "doc_id", "score", "rank")


@query
def bm25_stored(spark, sf):
    """The same from a stored index, blocks that cannot reach the list left out."""
    built = postings.write_index(X.documents(spark, sf), fresh_dir(spark, "index"))
    hits = search.bm25_in_index(X.benchmark_queries(spark, sf), built, 10)
    return hits.select("query_id", "doc_id", "score", "rank")


@query
def stream_tables(spark, sf):
    """Tokens, vectors and counters that the stream writes with its documents."""
    source, target = fresh_dir(spark, "stream"), fresh_dir(spark, "ingested")
    turns = X.turns(spark, sf).select("doc_id", "text")
    turns.write.parquet(source)
    ingest.ingest_stream(spark, source, target, turns.schema)
    tokens = ingest.stored(spark, target, "tokens").groupBy("doc_id").agg(F.count("*").alias("n_tokens"))
    vectors = ingest.stored(spark, target, "vectors").select("doc_id", F.size("embedding").alias("width"))
    counters = ingest.stored(spark, target, "counters").agg(*[F.sum(c).alias(c) for c in ("received", "stored", "duplicates", "skipped")])
    row = counters.first()
    named = [F.lit(row[c]).cast("long").alias(c) for c in counters.columns]
    return ingest.stored_documents(spark, target).select("doc_id").join(tokens, "doc_id", "left").join(vectors, "doc_id").select("*", *named)


@query
def bm25_rerank(spark, sf):
    docs = _cleaned(spark, sf, C.clear_text)
    return search.bm25_then_l2(X.benchmark_queries(spark, sf), docs, 10)


def _query_triples(spark, sf) -> DataFrame:
    return _triples(X.benchmark_queries(spark, sf), "query_id")


@query
def hybrid_v1(spark, sf):
    return search.hybrid_search(
        X.benchmark_queries(spark, sf),
        _cleaned(spark, sf, C.clear_text),
        _query_triples(spark, sf),
        triples_from_rel(spark, sf),
        n=3,
    )


@query
def triple_match(spark, sf):
    candidates = bm25_top_n(spark, sf).select("query_id", "doc_id", "rank")
    return ranking.triple_match(
        candidates, _query_triples(spark, sf), triples_from_rel(spark, sf)
    )


@query
def hybrid_v2(spark, sf):
    return search.hybrid_search_expanded(
        X.benchmark_queries(spark, sf),
        _clean_turns(spark, sf),
        spark.sql(X.LEMMA_LEXICON),
        spark.sql(X.SYNONYMS),
        n=3,
    )


@query
def fragment_search(spark, sf):
    return search.fragment_search(X.benchmark_queries(spark, sf), X.documents(spark, sf))


def _turn_pairs(spark, sf) -> DataFrame:
    """Each turn with the one before it, cleaned, and the cosine of their vectors."""
    clean = _clean_turns(spark, sf)
    turns = clean.withColumn("embedding", V.hash_embedding(F.col("clean")))
    before = turns.select(
        (F.col("doc_id") + 1).alias("doc_id"),
        F.col("clean").alias("clean_before"),
        F.col("embedding").alias("embedding_before"),
    )
    return turns.join(before, "doc_id").withColumn(
        "cosine", V.cosine(F.col("embedding"), F.col("embedding_before"))
    )


@query
def relevance_levenshtein(spark, sf):
    text = ranking.levenshtein_ratio(F.col("clean"), F.col("clean_before"))
    return _turn_pairs(spark, sf).select(
        "doc_id",
        V.rounded(text).alias("text_ratio"),
        V.rounded(ranking.relevance(F.col("cosine"), text)).alias("relevance"),
    )


@query
def relevance_ratio(spark, sf):
    docs = X.turns(spark, sf).select("doc_id", C.clear_text(F.col("text")).alias("clean"))
    return search.relevance_search(X.benchmark_queries(spark, sf), docs)


def _homes(spark, sf) -> DataFrame:
    """First document holding each benchmark passage, with its cleaned text."""
    passages = X.table(spark, sf, "benchmark").select(
        C.clear_text(F.col("text")).alias("fragment")
    )
    fragments = passages.filter(F.col("fragment") != "").distinct()
    docs = _cleaned(spark, sf, C.clear_text).withColumnRenamed("clean", "text")
    homes = store.settle(ranking.containing_doc(fragments, docs))
    return lookup_join(docs, homes, ["doc_id"])


@query
def containing_doc(spark, sf):
    return _homes(spark, sf).select("fragment", "doc_id")


@query
def context_window(spark, sf):
    around = T.context_window(F.col("text"), F.col("fragment"), 5)
    return _homes(spark, sf).select("fragment", "doc_id", around.alias("context"))


@query
def token_vector_search(spark, sf):
    words = T.unigrams_bigrams(F.col("tokens"))
    occurrences = _clean_turns(spark, sf).select(
        "doc_id", T.clean_words_of(F.col("clean")).alias("tokens")
    ).select("doc_id", F.inline(words))
    # Every distinct token borrows the vector whose id its hash bucket names.
    vectors = X.table(spark, sf, "embeddings")
    n_vectors = vectors.count()
    tokens = occurrences.select("token").distinct().withColumn(
        "vec_id", V.term_bucket(F.col("token"), n_vectors)
    )
    token_vectors = lookup_join(tokens, vectors.select("vec_id", "embedding"), ["vec_id"])
    return search.token_vector_search(
        _centroids(spark, sf), occurrences, token_vectors.select("token", "embedding"), 5, 0.05
    )


@query
def dedup_ranked(spark, sf):
    """Best document per query by the longest query word among the subjects of its sentences."""
    asked = search.words_as_terms(X.benchmark_queries(spark, sf)).withColumnRenamed("term", "word").distinct()
    words = triples_from_rel(spark, sf).select("doc_id", F.explode(F.split("subj", " ")).alias("word"))
    # Words move once, by document; pairs of query and document are made and reduced where these arrive.
    found = spread_by(lookup_join(words, asked.select("word").distinct(), ["word"], "left_semi"), "doc_id")
    shared = lookup_join(found, asked, ["word"])
    hits = shared.select("query_id", "doc_id", F.length("word").cast("double").alias("score"))
    return ranking.dedup_ranked(hits, 5)


@query
def phrase_positions(spark, sf):
    return search.phrase_search(
        X.benchmark_queries(spark, sf),
        X.turns(spark, sf),
        spark.sql(X.LEMMA_LEXICON),
        spark.sql(X.SYNONYMS),
        n=5,
    )


@query
def phrase_positions_stored(spark, sf):
    """The same from stored positions."""
    lexicon_ = spark.sql(X.LEMMA_LEXICON)
    built = postings.write_index(X.turns(spark, sf).select("doc_id", "text"), fresh_dir(spark, "index"), lexicon_)
    return search.phrase_search_in_index(X.benchmark_queries(spark, sf), built, lexicon_, spark.sql(X.SYNONYMS), n=5)


@query
def phrase_any_length(spark, sf):
    """All places in the documents of all runs of three to six lemmas of the benchmark passages."""
    lexicon_ = spark.sql(X.LEMMA_LEXICON)
    built = postings.write_index(X.documents(spark, sf), fresh_dir(spark, "index"), lexicon_)
    asked = search.phrase_runs(X.benchmark_queries(spark, sf), lexicon_, 3, 6)
    return search.phrases_in_index(asked, built)


@query
def token_lookup(spark, sf):
    wanted = spark.sql(X.SYNONYMS).select(F.col("word").alias("lemma"))
    return ranking.token_lookup(_annotated(spark, sf), wanted).select(
        "doc_id", "position", "token", "lemma", "pos"
    )


# Profiling


@query
def text_stats(spark, sf):
    return profile.text_stats(X.documents(spark, sf), "text").drop("text")


@query
def word_frequencies(spark, sf):
    return profile.word_frequencies(X.documents(spark, sf), "text", "doc_id")


@query
def top_words(spark, sf):
    fields = C.fill_nulls(X.posts3(spark, sf))
    cleaned = fields.select(*[C.clean_simple(F.col(c)).alias(c) for c in schemas.POST_COLUMNS])
    return profile.top_words(cleaned, schemas.POST_COLUMNS, 10)


@query
def null_counts(spark, sf):
    return profile.null_counts(X.posts3(spark, sf))


@query
def duplicate_rows(spark, sf):
    return profile.duplicate_row_count(X.table(spark, sf, "documents").drop("doc_id"))


@query
def unique_values(spark, sf):
    return profile.unique_values(X.table(spark, sf, "documents"), "source", "doc_id", 10)


@query
def length_summary(spark, sf):
    summary = profile.length_summary(X.posts3(spark, sf), schemas.POST_COLUMNS)
    return summary.withColumns({c: F.round(c, 4) for c in ["mean", "std", "p25", "p50", "p75"]})


@query
def dataset_stats(spark, sf):
    return profile.dataset_stats(X.posts3(spark, sf))


@query
def sample_rows(spark, sf):
    return profile.sample_rows(X.documents(spark, sf), 1, seed=7)


@query
def sentiment(spark, sf):
    label = profile.sentiment(F.col("text"), X.POSITIVE_WORDS, X.NEGATIVE_WORDS)
    return X.turns(spark, sf).select("doc_id", label.alias("sentiment"))


@query
def ingest_summary(spark, sf):
    statuses = index.ingest_statuses(X.documents(spark, sf), low=1, high=300)
    return profile.ingest_summary(statuses)


@query
def ingest_observed(spark, sf):
    """The same counters, observed while the statuses are written."""
    statuses = index.ingest_statuses(X.documents(spark, sf), low=1, high=300)
    counters = profile.write_with_summary(statuses, fresh_dir(spark, "statuses"))
    return spark.createDataFrame([counters], "success long, duplicates long, skipped long, errors long")


# Sets, deduplication, mutation


@query
def union_all(spark, sf):
    docs = X.documents(spark, sf)
    return corpus.union_all(docs, X.turns(spark, sf))


@query
def distinct_rows(spark, sf):
    return corpus.distinct_rows(X.table(spark, sf, "documents").select("text", "lang"))


@query
def dedup_first(spark, sf):
    cleaned = _cleaned(spark, sf, C.clear_text)
    return corpus.dedup_first(cleaned, "clean", "doc_id")


@query
def distinct_fragments(spark, sf):
    split = K.split_sentences(X.documents(spark, sf), "text", "doc_id")
    return corpus.distinct_fragments(split, "sentence")


@query
def insert_new_only(spark, sf):
    labelled = X.table(spark, sf, "labels")
    return corpus.insert_new_only(X.documents(spark, sf), labelled)


def _toxic(spark, sf) -> DataFrame:
    return X.table(spark, sf, "labels").filter(F.col("toxic") == 1)


@query
def delete_by_id(spark, sf):
    return corpus.delete_by_id(X.documents(spark, sf), _toxic(spark, sf))


@query
def delete_cascade(spark, sf):
    documents, tokens = corpus.delete_cascade(
        X.documents(spark, sf), token_spans(spark, sf), _toxic(spark, sf)
    )
    left = tokens.groupBy("doc_id").agg(F.count("*").alias("n_tokens"))
    return documents.join(left, "doc_id", "left").select("doc_id", "n_tokens")


@query
def get_documents(spark, sf):
    tokens = token_spans(spark, sf).select("doc_id", "position", "token")
    found = corpus.get_documents(X.documents(spark, sf), tokens, _toxic(spark, sf))
    joined = F.array_join(F.transform("tokens", lambda t: t["token"]), " ")
    return found.select("doc_id", "text", joined.alias("tokens"))


# Streaming


@query
def stream_ingest(spark, sf):
    """Both halves of the documents arrive one after the other; ids decide which is first."""
    source, target = fresh_dir(spark, "stream"), fresh_dir(spark, "ingested")
    docs = X.documents(spark, sf)
    middle = docs.agg(F.percentile_approx("doc_id", 0.5)).head()[0]
    for part in (F.col("doc_id") <= middle, F.col("doc_id") > middle):
        docs.filter(part).write.mode("append").parquet(source)
        ingest.ingest_stream(spark, source, target, docs.schema)
    return ingest.stored_documents(spark, target).select("doc_id", "cleaned_text")

"""Search pipelines over whole tables of queries.

`queries(query_id, text)`; documents are `(doc_id, clean)` unless said
otherwise.  Model parts - lemmas, synonyms, triples, vectors - come in as
tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textlode.functions.cleaning import WORD, clean_social, clear_text, let
from textlode.functions.tokens import adjacent_pairs, clean_words_of, context_window, sentences, word_count
from textlode.functions.vectors import cosine, hash_embedding, l2_normalize, rounded, squared_l2
from textlode.operators import ranking as R
from textlode.operators.bm25 import bm25_top_n, lemma_rows, query_terms, term_rows
from textlode.operators.filters import min_chars
from textlode.operators.joins import BROADCAST_ROWS, hinted_join, top_per_group
from textlode.operators import postings as P
from textlode.operators.lexicon import expand_synonyms, query_lemmas
from textlode.operators.tokens import analyze, lemmatise, phrase_rows, phrase_tokens
from textlode.operators.vectors import top_k_vectors
from textlode.sources.store import settle

# Posts of more characters and fragments of at least so many words.
MIN_CHARS = 10
MIN_WORDS = 3


def semantic_search(
    queries: DataFrame, vectors: DataFrame, top_k: int = 5, threshold: float = 0.0, key: str = "doc_id"
) -> DataFrame:
    """Cosine top-k: `(query_id, <key>, score, rank)`, the threshold applied after the cut.

    `queries(query_id, embedding)` and `vectors(<key>, embedding)` of any length.
    """
    unit = l2_normalize(F.col("embedding")).cast("array<float>").alias("embedding")
    hits = top_k_vectors(
        queries.select("query_id", unit), vectors.select(key, unit), top_k, "ip", key
    )
    return hits.filter(F.col("score") >= threshold)


def words_as_terms(queries: DataFrame) -> DataFrame:
    """`(query_id, term)`: one row per word of each cleaned query."""
    return queries.select(
        "query_id", F.explode(clean_words_of(clear_text(F.col("text")))).alias("term")
    )


def bm25_search(queries: DataFrame, docs: DataFrame, n: int) -> DataFrame:
    # Counted once: the scores, the frequencies and the lengths all read the counts.
    return bm25_in_postings(queries, settle(term_rows(docs)), n)


def bm25_in_postings(queries: DataFrame, postings: DataFrame, n: int) -> DataFrame:
    """The `n` best documents of each query from stored term rows; no text is read."""
    return bm25_top_n(query_terms(words_as_terms(queries)), postings, n)


def _bounded(queries: DataFrame, per_query: int) -> bool:
    """Whether `per_query` rows for each query are few enough to broadcast."""
    most = BROADCAST_ROWS // per_query
    return queries.limit(most + 1).count() <= most


def _with_vectors(
    candidates: DataFrame, queries: DataFrame, docs: DataFrame, dim: int, fits: bool
) -> DataFrame:
    """Candidates with `query_vec` and `doc_vec`; only candidate documents are embedded."""
    wanted = hinted_join(docs, candidates.select("doc_id").distinct(), ["doc_id"], "left_semi", fits)
    doc_vecs = wanted.select("doc_id", hash_embedding(F.col("clean"), dim).alias("doc_vec"))
    query_vecs = queries.select(
        "query_id", hash_embedding(clear_text(F.col("text")), dim).alias("query_vec")
    )
    return candidates.join(doc_vecs, "doc_id").join(query_vecs, "query_id")


def bm25_then_l2(queries: DataFrame, docs: DataFrame, n: int = 10, dim: int = 64) -> DataFrame:
    """The `n` best BM25 documents, re-ordered by the distance of their vectors to the query's."""
    candidates = settle(bm25_search(queries, docs, n).select("query_id", "doc_id"))
    scored = _with_vectors(candidates, queries, docs, dim, _bounded(queries, n))
    distance = scored.withColumn(
        "distance", rounded(squared_l2(F.col("query_vec"), F.col("doc_vec")))
    )
    return top_per_group(distance, ["query_id"], [F.asc("distance"), F.asc("doc_id")], n).select(
        "query_id", "doc_id", "distance", "rank"
    )


def _blend(bm25, semantic):
    return R.BM25_WEIGHT * bm25 + R.COSINE_WEIGHT * semantic


def hybrid_search(
    queries: DataFrame,
    docs: DataFrame,
    query_triples: DataFrame,
    doc_triples: DataFrame,
    n: int = 3,
    dim: int = 64,
) -> DataFrame:
    """0.3 BM25 + 0.7 cosine over the 2n best BM25 documents, times 1.2 for a shared triple."""
    fits = _bounded(queries, 2 * n)
    candidates = settle(
        bm25_search(queries, docs, 2 * n).select("query_id", "doc_id", F.col("score").alias("bm25"))
    )
    scored = _with_vectors(candidates, queries, docs, dim, fits)
    found = candidates.select("doc_id").distinct()
    near_triples = hinted_join(doc_triples, found, ["doc_id"], "left_semi", fits)
    matched = R.triple_match(candidates.select("query_id", "doc_id"), query_triples, near_triples)
    flagged = scored.join(
        matched.withColumn("matched", F.lit(True)), ["query_id", "doc_id"], "left"
    )
    blend = _blend(F.col("bm25"), cosine(F.col("query_vec"), F.col("doc_vec")))
    boost = F.when(F.col("matched"), R.TRIPLE_BOOST).otherwise(1.0)
    hits = flagged.select("query_id", "doc_id", rounded(blend * boost).alias("score"))
    return R.dedup_ranked(hits, n)


def hybrid_search_expanded(
    queries: DataFrame,
    docs: DataFrame,
    lexicon: DataFrame,
    synonyms: DataFrame,
    n: int = 3,
    dim: int = 64,
) -> DataFrame:
    """The blend on synonym-expanded lemmas, with boosts for short documents and exact lemmas.

    Every candidate holds a query lemma, or BM25 would not have returned it,
    so the boost for an exact lemma applies to all of them.
    """
    fits = _bounded(queries, 2 * n)
    terms = expand_synonyms(query_lemmas(queries, lexicon), synonyms)
    rows = settle(lemma_rows(term_rows(docs), lexicon))
    candidates = settle(
        bm25_top_n(query_terms(terms), rows, 2 * n).select(
            "query_id", "doc_id", "dl", F.col("score").alias("bm25")
        )
    )
    scored = _with_vectors(candidates, queries, docs, dim, fits)
    blend = _blend(F.col("bm25"), cosine(F.col("query_vec"), F.col("doc_vec")))
    short = F.when(F.col("dl") < R.SHORT_LEMMAS, R.SHORT_BOOST).otherwise(1.0)
    hits = scored.select(
        "query_id", "doc_id", rounded(blend * short * R.EXACT_BOOST).alias("score")
    )
    return R.dedup_ranked(hits, n)


def social_fragments(docs: DataFrame, text: str = "text") -> DataFrame:
    """Distinct cleaned sentences of at least three words, as `(fragment)`."""
    return fragments_of(docs.select(clean_social(F.col(text)).alias("text")))


def fragments_of(posts: DataFrame) -> DataFrame:
    """The same from socially cleaned texts `posts(text)`."""

    def fragments(post: Column) -> Column:
        # What a cleaned text of these characters alone keeps in every sentence needs no pattern again.
        odd = F.contains(post, F.lit("http")) | F.contains(post, F.lit("www")) | F.rlike(post, F.lit(f"[^{WORD}.,!? ]"))
        parts = sentences(post)
        cleaned = F.when(odd, F.transform(parts, clean_social)).otherwise(F.transform(parts, lambda p: F.lower(F.trim(p))))
        return F.when(
            F.length(post) > MIN_CHARS, F.filter(cleaned, lambda f: word_count(f) >= MIN_WORDS)
        )

    # The conditions sit inside the generator, so that no pushed-down filter
    # cleans every text a second time.
    return posts.select(F.explode(let(F.col("text"), fragments)).alias("fragment")).distinct()


def fragment_search(
    queries: DataFrame,
    docs: DataFrame,
    top_k: int = 5,
    min_score: float = 0.5,
    dim: int = 64,
    around: int = 5,
) -> DataFrame:
    """Sentence fragments by 0.6 cosine + 0.4 string similarity, with their context.

    `docs(doc_id, text)`.  The 10k nearest fragments of each query are
    compared as strings, so everything after the vector scan works on a
    bounded candidate table.
    """
    fits = _bounded(queries, 10 * top_k)
    # Cleaned once, for the fragments, their documents and the context.
    posts = settle(docs.select("doc_id", clean_social(F.col("text")).alias("text")))
    fragments = fragments_of(posts)

    def unit(text: str):
        # Sentences keep `.,!?`; the words to embed are those of the full cleaning.
        vector = hash_embedding(clear_text(F.col(text)), dim)
        return l2_normalize(vector).cast("array<float>").alias("embedding")

    asked = queries.select("query_id", clean_social(F.col("text")).alias("asked"))
    near = top_k_vectors(
        asked.select("query_id", unit("asked")),
        fragments.select("fragment", unit("fragment")),
        10 * top_k,
        "ip",
        "fragment",
    ).filter(F.col("score") >= min_score)
    candidates = near.join(asked, "query_id")
    best = settle(R.most_relevant(candidates, top_k, "fragment"))
    # The containing document does not change the order, so only the winners need one.
    homes = R.containing_doc(best.select("fragment").distinct(), min_chars(posts, "text"))
    home_texts = hinted_join(posts, homes, ["doc_id"], "inner", fits).select(
        "fragment", F.col("text").alias("home")
    )
    placed = best.join(home_texts, "fragment", "left").withColumn(
        "full_text", F.coalesce("home", "fragment")
    )
    return placed.select(
        "query_id",
        "rank",
        "fragment",
        context_window(F.col("full_text"), F.col("fragment"), around).alias("context"),
        "similarity",
        "full_text",
    )


def relevance_search(queries: DataFrame, docs: DataFrame, top_k: int = 5, dim: int = 64) -> DataFrame:
    """`(query_id, rank, doc_id, similarity)`: of the 10 top_k nearest documents the top_k by 0.6 cosine + 0.4 string similarity.

    `queries(query_id, text)`, `docs(doc_id, clean)`.
    """
    asked = queries.select("query_id", clear_text(F.col("text")).alias("asked"))

    def unit(text: str):
        return l2_normalize(hash_embedding(F.col(text), dim)).cast("array<float>").alias("embedding")

    near = settle(top_k_vectors(asked.select("query_id", unit("asked")), docs.select("doc_id", unit("clean")), 10 * top_k, "ip"))
    texts = hinted_join(docs.select("doc_id", "clean"), near, ["doc_id"], "inner", _bounded(queries, 10 * top_k))
    best = R.most_relevant(texts.join(asked, "query_id"), top_k, "doc_id", "clean")
    return best.select("query_id", "rank", "doc_id", "similarity")


def token_vector_search(
    queries: DataFrame,
    occurrences: DataFrame,
    token_vectors: DataFrame,
    k: int = 5,
    threshold: float = 0.7,
) -> DataFrame:
    """Word and word-pair hits by raw inner product: `(query_id, doc_id, token, position, ..)`.

    `occurrences(doc_id, token, position, type)` are all uni- and bigrams,
    `token_vectors(token, embedding)` has one vector per distinct token.  The
    k best occurrences lie among those of the k best tokens, so vectors are
    compared per distinct token and only then meet their occurrences.
    """
    best = top_k_vectors(queries, token_vectors, k, "ip", "token").select(
        "query_id", "token", F.col("score").alias("confidence")
    )
    found = hinted_join(occurrences, best, ["token"], "inner", _bounded(queries, k))
    order = [F.desc("confidence"), F.asc("token"), F.asc("doc_id"), F.asc("position"), F.asc("type")]
    hits = top_per_group(found, ["query_id"], order, k)
    return hits.filter(F.col("confidence") >= threshold).select(
        "query_id",
        "rank",
        "doc_id",
        "token",
        "position",
        (F.col("type") == "bigram").alias("is_bigram"),
        "confidence",
    )


def _asked_phrases(queries: DataFrame, lexicon: DataFrame, synonyms: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Expanded terms `(query_id, term)`, and with them the pairs of neighbouring lemmas."""
    lemmas = query_lemmas(queries, lexicon)
    terms = expand_synonyms(lemmas, synonyms)
    ordered = lemmas.groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("position", "term"))).alias("l"))
    pairs = ordered.select(
        "query_id", F.explode(adjacent_pairs(F.transform("l", lambda x: x["term"]))).alias("p")
    ).select("query_id", F.concat_ws(" ", "p.first", "p.second").alias("term"))
    return terms, terms.select("query_id", "term").unionByName(pairs).distinct()


def phrase_runs(queries: DataFrame, lexicon: DataFrame, shortest: int, longest: int) -> DataFrame:
    """Distinct `(query_id, phrase)`: all runs of so many neighbouring lemmas of each query."""
    lemmas = query_lemmas(queries, lexicon).groupBy("query_id").agg(F.array_sort(F.collect_list(F.struct("position", "term"))).alias("l"))

    def runs(length: int) -> Column:
        heads = F.sequence(F.lit(1), F.greatest(F.size("l") - length + 1, F.lit(1)))
        made = F.transform(heads, lambda i: F.transform(F.slice("l", i, length), lambda x: x["term"]))
        return F.filter(made, lambda r: F.size(r) == length)

    every = F.concat(*[runs(n) for n in range(shortest, longest + 1)])
    return lemmas.select("query_id", F.explode(every).alias("r")).select("query_id", F.array_join("r", " ").alias("phrase")).distinct()


def bm25_in_index(queries: DataFrame, index: P.Index, n: int) -> DataFrame:
    """The `n` best documents of each query from a stored index; no text is read."""
    return P.search_index(query_terms(words_as_terms(queries)), index, n)


def phrases_in_index(asked: DataFrame, index: P.Index) -> DataFrame:
    """`(query_id, doc_id, phrase, start, stop)`: every place of every phrase of `asked(query_id, phrase)`; no text is read."""
    asked = asked.select("query_id", "phrase").distinct()
    places = P.find_phrases(asked, index)
    return hinted_join(places, asked, ["phrase"], "inner", False).select("query_id", "doc_id", "phrase", "start", "stop")


def phrase_search_in_index(
    queries: DataFrame, index: P.Index, lexicon: DataFrame, synonyms: DataFrame, n: int = 5
) -> DataFrame:
    """`phrase_search` from an index of lemmas: only the postings of the n best documents' blocks are met."""
    terms, asked = _asked_phrases(queries, lexicon, synonyms)
    asked = settle(asked.withColumnRenamed("term", "phrase"))
    best = settle(P.search_index(query_terms(terms), index, n).select("query_id", "doc_id", "block", "score"))
    blocks = asked.join(best.select("query_id", "block").distinct(), "query_id").select("phrase", "block")
    places = P.find_phrases(asked, index, blocks)
    wanted = best.join(asked, "query_id")
    located = hinted_join(places, wanted, ["phrase", "block", "doc_id"], "inner", _bounded(queries, n))
    kind = F.when(F.size(F.split("phrase", " ")) == 1, "word").otherwise("phrase")
    return located.select("query_id", "doc_id", kind.alias("type"), F.col("phrase").alias("lemma"), "start", "stop", "score")


def phrase_search(
    queries: DataFrame,
    docs: DataFrame,
    lexicon: DataFrame,
    synonyms: DataFrame,
    n: int = 5,
) -> DataFrame:
    """Positions, in the original text, of the query's words and word pairs in the n best documents.

    `docs(doc_id, text)`; only those best documents are analysed.  Words and
    pairs meet by lemma, so inflected forms are found; synonyms stand for words.
    """
    fits = _bounded(queries, n)
    terms, asked = _asked_phrases(queries, lexicon, synonyms)
    clean = docs.select("doc_id", clear_text(F.col("text")).alias("clean"))
    rows = settle(lemma_rows(term_rows(clean), lexicon))
    scores = settle(
        bm25_top_n(query_terms(terms), rows, n).select("query_id", "doc_id", "score")
    )
    found = scores.select("doc_id").distinct()
    wanted = hinted_join(docs.select("doc_id", "text"), found, ["doc_id"], "left_semi", fits)
    tokens = lemmatise(phrase_tokens(analyze(wanted), "text"), lexicon, "doc_id")
    return R.phrase_positions(phrase_rows(tokens, "doc_id"), asked, scores, fits)



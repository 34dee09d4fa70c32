"""Token, phrase and entity tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlode.functions.cleaning import clear_text, let
from textlode.functions.tokens import (
    analyzed_spans,
    exact_map,
    phrases,
    runs_of,
    sentences,
    slices,
    token_spans,
)
from textlode.operators.joins import lookup_join, one_per_key
from textlode.sources.store import settle


# Words of a dictionary that every row looks through by itself.
SHORT_DICTIONARY = 64
# Beginnings of phrases that every row knows.
BEGINS = 2_000


def explode_rows(df: DataFrame, array: str, at: str, item: str, *keys: str) -> DataFrame:
    """`(keys.., <at>, <item>)`, one row per element of a computed array column.

    The plain explode of a column makes the optimizer filter for non-empty
    arrays, and that filter is pushed down and computes the array once more;
    the outer form with the condition behind it does not.
    """
    rows = df.select(*keys, F.posexplode_outer(array).alias(at, item))
    return rows.filter(F.col(at).isNotNull())


def split_sentences(df: DataFrame, text: str, *keys: str) -> DataFrame:
    """`(keys.., sent, sentence)`, one row per sentence."""
    return df.select(*keys, F.posexplode(sentences(F.col(text))).alias("sent", "sentence"))


def analyze(df: DataFrame, text: str = "text") -> DataFrame:
    """Adds `cleaned_text`, `mapping` and `tokens` with both character ranges; exact and row-local.

    The words are found in the original; the cleaned text is these words with a space between.
    """

    analyzed = df.withColumn("tokens", analyzed_spans(F.coalesce(F.col(text), F.lit(""))))
    return analyzed.withColumns(
        {
            "cleaned_text": F.array_join(F.transform("tokens", lambda t: t["token"]), " "),
            "mapping": exact_map(F.col("tokens")),
        }
    )


def token_rows(analyzed: DataFrame, *keys: str) -> DataFrame:
    """`(keys.., position, token, start_clean, ..)`, one row per token."""
    return explode_rows(analyzed, "tokens", "position", "t", *keys).select(*keys, "position", "t.*")


def annotate_tokens(rows: DataFrame, lexicon: DataFrame, token: str = "token") -> DataFrame:
    """Adds `lemma` and `pos` from `lexicon(form, lemma, pos)`; an unknown form is its own lemma.

    Of a form listed more than once the smallest row counts.
    """
    listed = one_per_key(lexicon.select(F.col("form").alias(token), "lemma", "pos"), token)
    found = lookup_join(rows, listed, [token], "left")
    return found.withColumn("lemma", F.coalesce("lemma", F.col(token)))


def rebuild_truncated(analyzed: DataFrame, limit: int = 30) -> DataFrame:
    """First `limit` tokens; cleaned text and mapping shrink with them."""
    tokens = F.slice("tokens", 1, limit)
    text = F.array_join(F.transform(tokens, lambda t: t["token"]), " ")
    shorter = analyzed.withColumns({"tokens": tokens, "cleaned_text": text})
    return shorter.withColumn("mapping", F.slice("mapping", 1, F.length("cleaned_text")))


def phrase_tokens(analyzed: DataFrame, text: str, spans: str = "original") -> DataFrame:
    """Turns `tokens` into the `array<struct<text, lemma, start, stop>>` the phrase functions take.

    With original spans, the text of a token is cut out of the original.
    """
    if spans == "original":
        tokens = slices(
            F.col(text),
            F.col("tokens"),
            lambda t, cut: F.struct(
                cut.alias("text"),
                t["token"].alias("lemma"),
                t["start_orig"].alias("start"),
                t["end_orig"].alias("stop"),
            ),
        )
    else:
        tokens = F.transform(
            "tokens",
            lambda t: F.struct(
                t["token"].alias("text"),
                t["token"].alias("lemma"),
                t["start_clean"].alias("start"),
                t["end_clean"].alias("stop"),
            ),
        )
    return analyzed.withColumn("tokens", tokens)


def lemmatise(df: DataFrame, lexicon: DataFrame, *keys: str) -> DataFrame:
    """`(keys.., tokens)` with the lemma of every token of `array<struct<text, lemma, start, stop>>` looked up.

    Rows without tokens have none to give and are left out.  Keys must name a row.
    """
    rows = explode_rows(df, "tokens", "at", "t", *keys).select(*keys, "at", "t.text", F.col("t.lemma").alias("token"), "t.start", "t.stop")
    found = annotate_tokens(rows, lexicon)
    token = F.struct("at", "text", "lemma", "start", "stop")
    return found.groupBy(*keys).agg(F.array_sort(F.collect_list(token)).alias("tokens"))


def phrase_rows(df: DataFrame, *keys: str) -> DataFrame:
    """`(keys.., type, text, lemma, start, stop, length)` of one- and two-word phrases."""
    return df.select(*keys, F.inline(phrases(F.col("tokens"))))


def extract_entities(
    df: DataFrame,
    gazetteer: DataFrame,
    *keys: str,
    longest: int | None = None,
    types: tuple[str, ...] = ("PER", "LOC", "ORG"),
) -> DataFrame:
    """Named entities: phrases found in `gazetteer(phrase_lemma, type, normal)`.

    Phrases have any number of words (at most `longest`, if told); only runs of
    as many words as some phrase has, which begin as one does, are made.  The longest match of each start
    position wins; of one phrase listed under several types, the first type does.
    """
    listed = gazetteer.filter(F.col("type").isin(*types)).select(F.col("phrase_lemma").alias("lemma"), "type", "normal")
    listed = one_per_key(listed, "lemma", "type")
    sizes = listed.select(F.size(F.split("lemma", " ")).alias("n")).filter("n > 0").distinct()
    # As many numbers as there are lengths of phrases.
    lengths = sorted(r.n for r in sizes.collect() if longest is None or r.n <= longest)
    # How the phrases begin, where these are few; words that begin none make no run.
    begins = [r.b for r in listed.select(F.substring_index("lemma", " ", 2).alias("b")).filter("b is not null").distinct().limit(BEGINS + 1).collect()]
    runs = df.select(*keys, F.inline(runs_of(F.col("tokens"), lengths or [1], begins if len(begins) <= BEGINS else None)))
    found = lookup_join(runs, listed, ["lemma"])
    best = F.max_by(F.struct("text", "normal", "type", "stop", "length"), F.struct("length", "type"))
    return (
        found.groupBy(*keys, "start")
        .agg(best.alias("e"))
        .select(*keys, "e.text", F.col("e.normal").alias("lemma"), "e.type", "start", "e.stop", "e.length")
    )


def extract_triples(df: DataFrame, *keys: str) -> DataFrame:
    """`(keys.., subj, verb, obj)` of sentences whose `tokens` carry `lemma` and `rel`.

    Words of one role are joined by a space; all three roles must occur.
    """

    def role(tokens, rel: str):
        members = F.filter(tokens, lambda t: t["rel"] == rel)
        return F.array_join(F.transform(members, lambda t: t["lemma"]), " ")

    # The condition sits inside the generator; as a filter it would be pushed
    # below it and evaluate the tokens again for every role.
    triples = F.transform(
        F.array("tokens"),
        lambda t: F.struct(
            role(t, "nsubj").alias("subj"), role(t, "root").alias("verb"), role(t, "obj").alias("obj")
        ),
    )
    complete = F.filter(
        triples, lambda r: (r["subj"] != "") & (r["verb"] != "") & (r["obj"] != "")
    )
    return df.select(*keys, F.inline(complete))


def nested_document(df: DataFrame, text: str, entities: DataFrame, key: str = "doc_id") -> DataFrame:
    """One record per document: clean text, sentences with their tokens, entities."""
    nested = F.transform(
        sentences(F.col(text)),
        lambda s: let(
            clear_text(s),
            lambda c: F.struct(c.alias("text"), token_spans(c).alias("tokens")),
        ),
    )
    documents = df.select(
        key, clear_text(F.col(text)).alias("clean_text"), nested.alias("sentences")
    )
    lists = entities.groupBy(key).agg(
        F.array_sort(
            F.collect_list(F.struct("start", "stop", "text", "lemma", "type", "length"))
        ).alias("entities")
    )
    return documents.join(lists, key, "left")


def replace_slang(df: DataFrame, key: str, text: str, slang: DataFrame) -> DataFrame:
    """`(<key>, normalised)`: cleaned text with every word listed in `slang(term, replacement)` replaced; one row per row.

    A short dictionary is looked up inside the row, without a shuffle.  For a
    longer one the words are taken apart, looked up and put together again by
    the number of their row.  Both give the same rows, also for repeated and null keys.
    """
    clean = df.select(F.col(key).alias("name"), clear_text(F.coalesce(F.col(text), F.lit(""))).alias("clean"))
    slang = one_per_key(slang.select("term", "replacement").filter("replacement is not null"), "term")
    short = slang.limit(SHORT_DICTIONARY + 1).collect()
    if len(short) <= SHORT_DICTIONARY:
        listed = F.create_map(*[F.lit(x) for r in short for x in (r.term, r.replacement)])
        swap = (lambda w: F.coalesce(F.element_at(listed, w), w)) if short else (lambda w: w)
        return clean.select(F.col("name").alias(key), F.array_join(F.transform(F.split("clean", " "), swap), " ").alias("normalised"))
    numbered = settle(clean.withColumn("row", F.monotonically_increasing_id()))
    words = numbered.select("row", "name", F.posexplode(F.split("clean", " ")).alias("at", "term"))
    swapped = lookup_join(words, slang, ["term"], "left")
    parts = F.array_sort(F.collect_list(F.struct("at", F.coalesce("replacement", "term").alias("word"))))
    whole = swapped.groupBy("row").agg(F.first("name").alias("name"), parts.alias("parts"))
    return whole.select(F.col("name").alias(key), F.array_join(F.transform("parts", lambda p: p["word"]), " ").alias("normalised"))

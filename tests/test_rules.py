"""What must hold whatever the size, the order or the state of the input."""

import pytest
from pyspark.sql import functions as F

from textlode import schemas
from textlode.operators import bm25, corpus, profile, tokens
from textlode.operators import vectors as E
from textlode.operators.tokens import annotate_tokens, replace_slang
from textlode.plans import index, search
from textlode.plans.queries import QUERIES
from textlode.session import fresh_dir
from textlode.sources import posts, store


def test_columns_are_taken_by_name(spark):
    folder = fresh_dir(spark, "csv")
    rows = [("an image", "a text", "a speech")]
    posts.write_csv(spark.createDataFrame(rows, "image2text string, doc_text string, speech2text string"), f"{folder}/a.csv")
    posts.write_csv(spark.createDataFrame([("t", "i", "s", "x")], "doc_text string, image2text string, speech2text string, more string"), f"{folder}/b.csv")
    read = posts.read_posts(spark, folder, schemas.POSTS)
    assert sorted(map(tuple, read.select("doc_text", "image2text").collect())) == [("a text", "an image"), ("t", "i")]
    posts.write_csv(spark.createDataFrame([(1, "x")], "id int, other string"), f"{folder}/c.csv")
    with pytest.raises(ValueError, match="doc_text"):
        posts.read_posts(spark, folder, schemas.POSTS)


def test_unreadable_files_are_reported(spark):
    folder = fresh_dir(spark, "csv")
    posts.write_csv(spark.createDataFrame([("a", "b")], "x string, y string"), f"{folder}/good.csv")

    def header(session, path):
        if "bad" in path:
            raise OSError("broken file\nand more")
        return posts.header_of(session, path)

    groups, report = posts.readable_files(spark, [f"{folder}/good.csv", f"{folder}/bad.csv"], header)
    assert groups == {("x", "y"): [f"{folder}/good.csv"]}
    assert [tuple(r) for r in report.collect()] == [(f"{folder}/bad.csv", "broken file")]
    rows, none = posts.read_posts_reported(spark, folder)
    assert rows.count() == 1 and none.count() == 0


def test_appends_keep_the_other_tables(spark):
    base = fresh_dir(spark, "corpus")
    store.write_version(spark, base, {"documents": spark.range(4), "tokens": spark.range(2)})
    store.append_version(spark, base, {"vectors": spark.range(3)})
    store.append_version(spark, base, {"vectors": spark.range(3, 5), "tokens": spark.range(7, 8)})
    counts = {name: store.read_version(spark, base, name).count() for name in ("documents", "tokens", "vectors")}
    assert counts == {"documents": 4, "tokens": 3, "vectors": 5}
    assert store.read_version(spark, base, "vectors", 2).count() == 3
    with pytest.raises(KeyError):
        store.read_version(spark, base, "vectors", 1)
    number, hits = store.delete_version(spark, base, spark.range(2, 9), ["documents", "tokens"], "id")
    assert (number, hits) == (4, 2)
    assert [r.id for r in store.read_version(spark, base, "tokens").orderBy("id").collect()] == [0, 1]
    assert store.read_version(spark, base, "vectors").count() == 5


@pytest.mark.parametrize("limit", [1, 4096])
def test_queries_of_two_widths_are_an_error_at_every_size(spark, monkeypatch, limit):
    monkeypatch.setattr(E, "QUERY_ROWS", limit)
    queries = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None)], "query_id long, embedding array<float>")
    vectors = spark.createDataFrame([(1, [1.0, 2.0])], "doc_id long, embedding array<float>")
    with pytest.raises(ValueError, match="width"):
        E.top_k_vectors(queries, vectors, 2).collect()


def test_a_null_text_is_a_document_without_words(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "doc_id long, clean string")
    counts = bm25.term_counts(bm25.term_rows(docs)).filter("term is null").head()
    assert (counts.df, counts.total_dl) == (3, 3)


def test_a_form_listed_twice_changes_nothing(spark):
    kind = "form string, lemma string, pos string"
    once = spark.createDataFrame([("saw", "saw", "NOUN")], kind)
    twice = spark.createDataFrame([("saw", "see", "VERB"), ("saw", "saw", "NOUN")], kind)
    docs = spark.createDataFrame([(1, "saw a b"), (2, "a b c d")], "doc_id long, clean string")
    rows = bm25.term_rows(docs)
    assert sorted(map(str, bm25.lemma_rows(rows, once).collect())) == sorted(map(str, bm25.lemma_rows(rows, twice).collect()))
    words = spark.createDataFrame([(1, "saw"), (1, "x")], "doc_id long, token string")
    assert annotate_tokens(words, twice).count() == 2
    slang = spark.createDataFrame([("lol", "z"), ("lol", "b")], "term string, replacement string")
    texts = spark.createDataFrame([(1, "a lol lol")], "doc_id long, text string")
    assert replace_slang(texts, "doc_id", "text", slang).head().normalised == "a b b"


@pytest.mark.parametrize("longest", [0, 64])
def test_slang_is_the_same_with_a_long_dictionary(spark, monkeypatch, longest):
    monkeypatch.setattr(tokens, "SHORT_DICTIONARY", longest)
    slang = spark.createDataFrame([("lol", "laugh out loud"), ("u", "you")], "term string, replacement string")
    texts = spark.createDataFrame([(1, "LOL u there"), (2, ""), (3, None), (4, "plain words")], "doc_id long, text string")
    rows = {r.doc_id: r.normalised for r in replace_slang(texts, "doc_id", "text", slang).collect()}
    assert rows == {1: "laugh out loud you there", 2: "", 3: "", 4: "plain words"}


def test_no_text_moves(spark, plan, sf_dir):
    """BM25 and the counts inside a row shuffle counts and hits, never texts or words of texts."""
    for name in ("word_frequencies", "slang_normalise"):
        assert "Exchange" not in plan(QUERIES[name](spark, sf_dir).repartition(1)).replace("Exchange SinglePartition", "").replace(
            "Exchange RoundRobinPartitioning", ""
        ), name
    for line in plan(QUERIES["bm25_top_n"](spark, sf_dir)).splitlines():
        assert "Exchange hashpartitioning(doc_id" not in line and "Exchange hashpartitioning(clean" not in line


def test_word_maps_and_rejected_rows(spark):
    docs = spark.createDataFrame([(1, "b a b"), (2, ""), (3, None)], "doc_id long, text string")
    maps = {r.doc_id: r.word_frequencies for r in profile.word_frequency_maps(docs, "text", "doc_id").collect()}
    assert maps[1] == {"a": 1, "b": 2} and not maps[2] and not maps[3]
    assert sorted(map(tuple, profile.word_frequencies(docs, "text", "doc_id").collect())) == [(1, "a", 1), (1, "b", 2)]
    stored = spark.createDataFrame([(2,), (9,)], "doc_id long")
    assert [r.doc_id for r in corpus.rejected_on_insert(docs, stored).collect()] == [2]


def test_loaders_keep_long_posts_unless_told(spark):
    long = " ".join("abc"[i % 3] * (1 + i % 5) for i in range(400))
    docs = spark.createDataFrame([(1, long), (2, "short one"), (3, "!!")], "doc_id long, text string")
    assert sorted(r.doc_id for r in index.select_posts(docs).collect()) == [1, 2]
    assert [r.doc_id for r in index.select_posts(docs, high=30).collect()] == [2]
    kept = {r.doc_id: r.tokens for r in index.analyze_posts(docs).collect()}
    assert len(kept[1]) == 400
    reasons = {r.doc_id: r.status for r in index.ingest_statuses(docs, high=30).collect()}
    assert reasons == {1: "skipped", 2: "stored", 3: "skipped"}
    # The limit counts words beyond the 500th character too.
    spaced = spark.createDataFrame([(1, "x" * 490 + " y" * 31)], "doc_id long, text string")
    assert index.select_posts(spaced, high=30).count() == 0


def test_rows_of_one_key_stay_rows_whatever_the_dictionary(spark):
    texts = spark.createDataFrame([(1, "the cat"), (1, "und dog"), (None, "the"), (None, None), (2, ""), (1, "the cat")], "doc_id long, text string")
    texts = texts.selectExpr("doc_id AS at", "text", "1 AS term", "2 AS row")
    listed = [("the", "ye"), ("und", "so wie auch"), ("cat", None)]
    told = []
    for more in (0, 100):
        slang = spark.createDataFrame(listed + [(f"zz{i}", "x") for i in range(more)], "term string, replacement string")
        told.append(sorted(map(tuple, replace_slang(texts, "at", "text", slang).collect()), key=str))
    assert told[0] == told[1] and len(told[0]) == 6 and (1, "so wie auch dog") in told[0] and (1, "ye cat") in told[0]


def test_helper_columns_hide_no_column(spark):
    from textlode.operators.joins import hinted_join, one_per_key

    big = spark.createDataFrame([(1, 5, 7), (2, 6, 8)], "k long, _salt long, `a.b` long")
    small = spark.createDataFrame([(1, "x"), (1, "w"), (3, "y")], "k long, _row string")
    for fits in (True, False):
        joined = hinted_join(big, one_per_key(small, "k"), ["k"], "left", fits)
        assert joined.columns == ["k", "_salt", "a.b", "_row"]
        assert sorted(map(tuple, joined.collect())) == [(1, 5, 7, "w"), (2, 6, 8, None)]


def test_entities_of_any_length(spark):
    from textlode.operators.tokens import extract_entities

    words = "new york city hall of the new york state".split()
    tokens = [(w, w, i, i + 1) for i, w in enumerate(words)]
    schema = "doc_id long, tokens array<struct<text:string,lemma:string,start:int,stop:int>>"
    docs = spark.createDataFrame([(1, tokens), (2, []), (3, None)], schema)
    names = [("new york", "LOC", "NY"), ("new york city hall of the new", "ORG", "Hall"), ("york city hall", "ORG", "YCH"),
             ("hall", "PER", "Hall"), ("state", "MISC", "S"), ("new york", "ORG", "NYO")]
    gazetteer = spark.createDataFrame(names, "phrase_lemma string, type string, normal string")
    found = {(r.start, r.lemma, r.length) for r in extract_entities(docs, gazetteer, "doc_id").collect()}
    assert found == {(0, "Hall", 7), (1, "YCH", 3), (3, "Hall", 1), (6, "NYO", 2)}
    short = {(r.start, r.length) for r in extract_entities(docs, gazetteer, "doc_id", longest=2).collect()}
    assert short == {(0, 2), (3, 1), (6, 2)}
    assert extract_entities(docs, gazetteer.limit(0), "doc_id").count() == 0


def test_inflected_words_and_phrases_are_located(spark):
    lexicon = spark.createDataFrame([("are", "be", "VERB"), ("is", "be", "VERB"), ("cats", "cat", "NOUN")], "form string, lemma string, pos string")
    none = spark.createDataFrame([], "word string, synset_id string, synset_rank int, sense string, sense_rank int")
    docs = spark.createDataFrame([(1, "They\nare here. The cats are out!"), (2, "nothing of it")], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "is"), (2, "cat is")], "query_id long, text string")
    rows = search.phrase_search(asked, docs, lexicon, none).collect()
    found = sorted((r.query_id, r.type, r.lemma, r.start, r.stop) for r in rows)
    assert found == [
        (1, "word", "be", 5, 8), (1, "word", "be", 24, 27),
        (2, "phrase", "cat be", 19, 27), (2, "word", "be", 5, 8), (2, "word", "be", 24, 27), (2, "word", "cat", 19, 23),
    ]


def test_an_encoder_sees_bounded_batches_and_is_made_in_the_task(spark):
    def factory():
        made = {"calls": 0}

        def encode(texts):
            assert len(texts) <= 3
            made["calls"] += 1
            return [[float(len(t)), float(made["calls"])] for t in texts]

        return encode

    texts = ["a", "", "bb", None, "ccc", "dddd", "e", " ", "ff", "g"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, t string").coalesce(1)
    rows = {r.id: r.embedding for r in E.embed_with(frame, "t", factory=factory, batch_size=3).collect()}
    assert [i for i, v in rows.items() if v is None] == [1, 3, 7]
    assert rows[5] == [4.0, 2.0] and rows[9] == [1.0, 3.0]
    with pytest.raises(ValueError):
        E.embed_with(frame, "t")


def test_first_rows(spark):
    frame = spark.range(20).select((19 - F.col("id")).alias("n"))
    assert [r.n for r in profile.head_rows(frame, "n").collect()] == [0, 1, 2, 3, 4]


def test_mean_pool_by_plain_sums(spark):
    rows = [("a", [1.0, 2.0], 1), ("a", [5.0, None], 1), ("b", None, 1), ("b", [1.0], 1), ("b", [3.0, 4.0], 1), (None, [7.0], 1)]
    rows += [("hot", [float(i), 1.0], i % 2) for i in range(2000)] + [("none", [1.0], None)]
    frame = spark.createDataFrame(rows, "k string, v array<float>, m int").repartition(6)
    found = {r.k: r.embedding for r in E.mean_pool(frame, "k", "v", F.col("m")).collect()}
    assert found == {"a": [3.0, 1.0], "b": [2.0, 4.0], None: [7.0], "hot": [1000.0, 1.0], "none": [0.0]}


def test_only_runs_that_begin_as_a_phrase_does_are_made(spark, monkeypatch):
    import random

    from textlode.functions.tokens import runs_of
    from textlode.operators import tokens as K

    rng = random.Random(4)
    lemmas = ["a", "b", "c", "d", "a b", "", None, "e"]
    made = [(d, [(f"t{i}", rng.choice(lemmas), i, i + 1) for i in range(rng.randrange(9))]) for d in range(300)]
    docs = spark.createDataFrame(made, "doc_id int, tokens array<struct<text:string,lemma:string,start:int,stop:int>>")
    names = ["a", "a b", "a b c", "b  c", " a", "d e", "c d a", "e e e e", None, "", "a b a b"]
    gazetteer = spark.createDataFrame([(n, "PER", "N") for n in names], "phrase_lemma string, type string, normal string")
    few = sorted(map(str, K.extract_entities(docs, gazetteer, "doc_id").collect()))
    monkeypatch.setattr(K, "BEGINS", 0)
    assert few == sorted(map(str, K.extract_entities(docs, gazetteer, "doc_id").collect())) and len(few) > 300
    plain = docs.filter("forall(tokens, t -> t.lemma is not null)")
    runs = plain.select(F.inline(runs_of(F.col("tokens"), [1, 3], ["d e", "c"])))
    assert 0 < runs.count() < plain.select(F.inline(runs_of(F.col("tokens"), [1, 3]))).count() / 3
    assert all(r.lemma == "c" or r.lemma.startswith("d e") for r in runs.collect())


def test_both_word_limits_clean_a_text_once(spark, plan):
    """a condition that is pushed down holds its text, and the cleaning in it, once."""
    from textlode.functions.cleaning import processed_text
    from textlode.operators.filters import words_between

    docs = spark.createDataFrame([(1, "a"), (2, "a b"), (3, "a b c"), (4, ""), (5, None), (6, "nan")], "doc_id long, text string")
    cleaned = docs.withColumn("w", processed_text(F.col("text"), None))
    kept = words_between(cleaned, "w", 1, 2).drop("w")
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]
    assert sorted(r.doc_id for r in words_between(cleaned, "w", 1, None).collect()) == [1, 2, 3]
    condition = plan(kept).split("Filter")[1].split("\n")[0]
    # As often as the cleaning itself looks for links.
    assert condition.count("https?://") == 1

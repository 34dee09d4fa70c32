import pytest
from pyspark.sql import functions as F

from textlode import schemas
from textlode.operators import corpus, filters, profile
from textlode.plans import fixtures as X
from textlode.plans import index, search
from textlode.session import fresh_dir, shared_dir
from textlode.sources import posts, store
from textlode.streaming import ingest

POSTS = "doc_id long, text string"


@pytest.mark.parametrize("pieces", [1, 7])
def test_dedup_keeps_the_first_whatever_the_partitions(spark, pieces):
    rows = [(i, "Hot Text!" if i % 3 == 0 else f"text {'abc'[i % 2]}") for i in range(90)]
    docs = spark.createDataFrame(rows, POSTS).repartition(pieces)
    from textlode.functions.cleaning import clear_text

    kept = corpus.dedup_first(docs.withColumn("clean", clear_text(F.col("text"))), "clean", "doc_id")
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2]


def test_blank_texts_are_dropped_by_dedup(spark):
    docs = spark.createDataFrame([(1, ""), (2, None), (3, "a"), (4, " A ")], "doc_id long, clean string")
    assert [r.doc_id for r in corpus.dedup_first(docs, "clean", "doc_id").collect()] == [3]


def test_duplicates_tell_null_from_empty(spark):
    rows = [("a", None), ("a", None), ("a", ""), ("A", None)]
    assert profile.duplicate_row_count(spark.createDataFrame(rows, "x string, y string")).head()[0] == 1


def test_versions_commit_together(spark):
    base = fresh_dir(spark, "versions")
    with pytest.raises(FileNotFoundError):
        store.require_version(spark, base)
    first = spark.range(3).withColumnRenamed("id", "doc_id")
    assert store.write_version(spark, base, {"documents": first}) == 1
    # What a failed write left is not read, and gives way to the next one.
    first.write.parquet(f"{base}/documents/version=2")
    first.write.parquet(f"{base}/tokens/version=2")
    assert store.require_version(spark, base) == 1
    assert store.read_version(spark, base, "documents").count() == 3
    assert store.append_version(spark, base, {"documents": spark.range(3, 5).withColumnRenamed("id", "doc_id")}) == 2
    with pytest.raises(KeyError):
        store.read_version(spark, base, "tokens")
    assert store.read_version(spark, base, "documents").count() == 5
    assert store.read_version(spark, base, "documents", 1).count() == 3
    assert store.load_or_create(spark, base, "documents", first.schema, overwrite=True).count() == 0


def test_load_corpus_and_search_it(spark, sf_dir):
    base = fresh_dir(spark, "corpus")
    index.load_corpus(X.turns(spark, sf_dir), base, spark.sql(X.LEMMA_LEXICON))
    documents = store.read_version(spark, base, "documents")
    tokens = store.read_version(spark, base, "tokens")
    vectors = store.read_version(spark, base, "vectors")
    assert documents.count() == vectors.count() > 0
    assert tokens.count() == documents.agg(F.sum(F.size("tokens"))).head()[0]
    assert tokens.columns == schemas.TOKENS.fieldNames()
    queries = vectors.withColumnRenamed("doc_id", "query_id")
    hits = search.semantic_search(queries, vectors, 1, 0.5)
    assert hits.filter("abs(score - 1) > 1e-5").count() == 0


def test_truncation_shortens_text_and_mapping(spark):
    from textlode.operators.tokens import analyze, rebuild_truncated

    docs = spark.createDataFrame([(1, "One, two, three, four")], POSTS)
    row = rebuild_truncated(analyze(docs), 2).head()
    assert row.cleaned_text == "one two" and len(row.tokens) == 2
    assert row.mapping == [0, 1, 2, 4, 5, 6, 7]


def test_log_appends(spark):
    path = fresh_dir(spark, "log")
    hits = spark.createDataFrame([(1, 1, 7, 0.5)], "query_id long, rank int, doc_id long, score double")
    store.log_hits(hits, path)
    store.log_hits(hits, path)
    log = spark.read.parquet(path)
    assert log.count() == 2 and log.filter("logged_at is null").count() == 0


def test_log_keeps_the_query_and_all_places(spark):
    path = fresh_dir(spark, "log")
    hits = spark.createDataFrame([(1, 1, 7, 0.5), (1, 2, 8, 0.4), (9, 1, 7, 0.1)], "query_id long, rank int, doc_id long, score double")
    queries = spark.createDataFrame([(1, "the cat")], "query_id long, text string")
    places = spark.createDataFrame([(1, 7, 4, 7), (1, 7, 0, 3), (1, 7, 0, 3)], "query_id long, doc_id long, start int, stop int")
    store.log_searches(hits, queries, places, path)
    told = {(r.query_id, r.doc_id): (r.query_text, [tuple(p) for p in r.positions]) for r in spark.read.parquet(path).collect()}
    assert told == {(1, 7): ("the cat", [(0, 3), (4, 7)]), (1, 8): ("the cat", []), (9, 7): (None, [])}


def test_counters_are_observed_on_the_write(spark):
    statuses = spark.createDataFrame([(1, "stored"), (2, "duplicate"), (3, "stored"), (4, "skipped"), (5, None)], "doc_id long, status string")
    path = fresh_dir(spark, "statuses")
    counter = spark.sparkContext._jsc.sc().dagScheduler().nextJobId
    before = counter()
    told = profile.write_with_summary(statuses, path)
    assert counter() - before == 1
    assert told == {"success": 2, "duplicates": 1, "skipped": 1, "errors": 0}
    assert told == profile.ingest_summary(spark.read.parquet(path)).head().asDict()


def test_lookup_of_absent_lemmas_skips_row_groups(spark, sf_dir):
    import glob

    import pyarrow.parquet as pq

    base = fresh_dir(spark, "corpus")
    tokens = spark.range(40_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("w"), F.col("id") * 2).alias("lemma"))
    store.write_version(spark, base, {"tokens": store.cluster_tokens(tokens)})
    stored = store.read_version(spark, base, "tokens")
    gone, there = (stored.filter(F.col("lemma") == w) for w in ("w20001", "w20002"))
    assert gone.count() == 0 and there.count() == 1

    def scanned(df):
        df.collect()
        node = df._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
        return node.metrics().apply("numOutputRows").value()

    # The lemma lies within the range of its file: only the bloom filter tells that it is absent.
    files = [f for f in glob.glob(f"{base.removeprefix('file://')}/tokens/*/*.parquet")]
    ranges = [pq.ParquetFile(f).metadata.row_group(0).column(1).statistics for f in files]
    assert any(s.min < "w20001" < s.max for s in ranges)
    assert scanned(gone) == 0 and scanned(there) >= 1


def test_posts_need_files_and_columns(spark):
    empty = fresh_dir(spark, "empty")
    with pytest.raises(FileNotFoundError):
        posts.read_posts(spark, empty)
    folder = fresh_dir(spark, "posts")
    rows = [("a\nb", 'say "x", y'), (" pad ", "")]
    frame = spark.createDataFrame(rows, "doc_text string, note string")
    posts.write_csv(frame, f"{folder}/a.csv")
    back = posts.read_posts(spark, folder)
    # An empty cell is a missing value.
    assert sorted(map(tuple, back.collect())) == [(" pad ", None), rows[0]]
    with pytest.raises(ValueError, match="image2text"):
        posts.read_column(back, "doc_text", "image2text")


def test_pruned_scan_reads_one_column(spark, plan, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id")
    assert "ReadSchema: struct<doc_id:bigint>" in plan(docs)


def stream_dirs(spark):
    return fresh_dir(spark, "source"), fresh_dir(spark, "target")


def moved(spark, path, to):
    name = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = name(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    assert files.rename(name(path), name(to))


def test_stream_keeps_first_over_runs_and_files(spark):
    source, target = stream_dirs(spark)
    schema = spark.createDataFrame([], POSTS).schema
    batches = [[(1, "A b."), (2, "a b"), (3, "")], [(4, "A B!"), (5, "new one")], [(6, "NEW one"), (7, "x")]]
    for rows in batches:
        spark.createDataFrame(rows, POSTS).coalesce(1).write.mode("append").parquet(source)
        ingest.ingest_stream(spark, source, target, schema)
    # Only copies, then nothing new.
    spark.createDataFrame([(8, "a B")], POSTS).coalesce(1).write.mode("append").parquet(source)
    ingest.ingest_stream(spark, source, target, schema)
    counters = ingest.stored(spark, target, "counters").agg(F.sum("received"), F.sum("stored"), F.sum("duplicates"), F.sum("skipped"))
    assert tuple(counters.head()) == (8, 3, 4, 1)
    ingest.ingest_stream(spark, source, target, schema)
    kept = ingest.stored_documents(spark, target)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5, 7]


def test_repeated_batch_replaces_its_output(spark):
    """A batch number seen before, as after a crash, gives the same rows again."""
    source, target = stream_dirs(spark)
    schema = spark.createDataFrame([], POSTS).schema
    rows = [(1, "one text"), (2, "two text"), (3, "One text")]
    spark.createDataFrame(rows, POSTS).write.parquet(source)
    ingest.ingest_stream(spark, source, target, schema)
    moved(spark, f"{target}/checkpoint", f"{target}/checkpoint_lost")
    ingest.ingest_stream(spark, source, target, schema)
    kept = ingest.stored_documents(spark, target)
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2]


def test_replayed_batch_starts_from_the_state_before_it(spark):
    """The commit of the last batch is lost: it runs again, and does not take its own keys for seen ones."""
    source, target = stream_dirs(spark)
    schema = spark.createDataFrame([], POSTS).schema
    for rows in [[(5, "one text"), (6, "two text")], [(1, "One text"), (2, "nan"), (8, "four"), (7, "Four!"), (None, "four"), (None, "five")]]:
        spark.createDataFrame(rows, POSTS).coalesce(1).write.mode("append").parquet(source)
        ingest.ingest_stream(spark, source, target, schema)
    names = {"documents", "counters"}
    before = {n: sorted(map(str, ingest.stored(spark, target, n).collect())) for n in names}
    moved(spark, f"{target}/checkpoint/commits/1", f"{target}/lost")
    ingest.ingest_stream(spark, source, target, schema)
    assert {n: sorted(map(str, ingest.stored(spark, target, n).collect())) for n in names} == before
    assert {r.doc_id for r in ingest.stored_documents(spark, target).collect()} == {5, 6, 7, None}
    # The state is the only memory.
    assert store.exists(spark, f"{target}/checkpoint/state") and not store.exists(spark, f"{target}/keys")


def test_stream_reads_no_table_that_it_wrote(spark, plan):
    from textlode.functions.cleaning import clear_text

    schema = spark.createDataFrame([], POSTS).schema
    source = fresh_dir(spark, "source")
    spark.createDataFrame([(2, "hot text")] * 50 + [(1, "Hot text"), (3, "x y")], POSTS).write.parquet(source)
    keyed = ingest._keyed(spark.read.schema(schema).parquet(source), "text", 1, None)
    reduced = keyed.mapInArrow(ingest._first_of_each("doc_id"), keyed.schema)
    # Copies go before the shuffle, the number of rows that they stood for stays.
    assert reduced.count() < 30 and reduced.agg(F.sum("n")).head()[0] == 52
    assert plan(reduced).count("Scan parquet") == 1 and "Exchange" not in plan(reduced)


def test_stream_meets_keys_without_a_call_per_key(spark):
    """what was seen is looked up by Spark itself; a Python function that is called per key takes milliseconds each."""
    source = fresh_dir(spark, "source")
    spark.createDataFrame([(1, "a b")], POSTS).write.parquet(source)
    schema = spark.createDataFrame([], POSTS).schema
    keyed = ingest._keyed(spark.readStream.schema(schema).parquet(source), "text", 1, None)
    made = ingest.first_seen(keyed, "doc_id")._jdf.queryExecution().analyzed().toString()
    assert "Deduplicate [key" in made and "WithState" not in made


def test_stream_of_equal_ids_and_texts(spark):
    """One row of each text, whatever ids repeat or are missing, in one batch and over two."""
    source, target = stream_dirs(spark)
    schema = spark.createDataFrame([], POSTS).schema
    rows = [[(1, "a b")] * 3 + [(None, "a b"), (None, "c"), (None, "c"), (2, ""), (2, None)], [(0, "A b"), (1, "d"), (1, "d")]]
    for part in rows:
        spark.createDataFrame(part, POSTS).repartition(2).write.mode("append").parquet(source)
        ingest.ingest_stream(spark, source, target, schema)
    kept = ingest.stored_documents(spark, target).select("doc_id", "cleaned_text").collect()
    assert sorted(map(tuple, kept), key=str) == [(1, "a b"), (1, "d"), (None, "c")]
    counters = ingest.stored(spark, target, "counters").orderBy("received").collect()
    assert [(r.received, r.stored, r.duplicates, r.skipped) for r in counters] == [(3, 1, 2, 0), (8, 2, 4, 2)]


def test_stream_equals_batch(spark, sf_dir):
    source, target = stream_dirs(spark)
    docs = X.documents(spark, sf_dir)
    docs.write.parquet(source)
    ingest.ingest_stream(spark, source, target, docs.schema, high=300)
    batch = index.select_posts(docs, high=300)
    found = ingest.stored_documents(spark, target).select("doc_id")
    assert sorted(found.collect()) == sorted(batch.select("doc_id").collect())


def test_validators(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None), (3, " ")], POSTS)
    checked = filters.with_max_words_status(frame, "text", 1).orderBy("doc_id").collect()
    assert [(r.n_words, r.reason is None) for r in checked] == [(2, False), (0, True), (0, True)]
    found = filters.search_any_column(
        spark.createDataFrame([("ПРИВЕТ", 1), (None, 2), ("x", 3)], "a string, n int"), "привет"
    )
    assert [r.n for r in found.collect()] == [1]
    empty = spark.createDataFrame([], "embedding array<float>")
    assert filters.vector_width(empty) == 768


def test_release_deletes_the_applications_folder(spark, monkeypatch, tmp_path):
    from textlode import session

    kept = tmp_path / "other"
    kept.mkdir()
    monkeypatch.setattr(session, "work_dir", lambda spark: str(tmp_path / "app"))
    spark.range(1).write.parquet(session.fresh_dir(spark, "settled"))
    assert (tmp_path / "app").exists()
    session.release(spark)
    assert not (tmp_path / "app").exists() and kept.exists()


def test_shared_dir_follows_the_session(spark):
    assert shared_dir(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_top_k_plans_limit_before_the_shuffle(spark, plan, sf_dir):
    from textlode.plans.queries import QUERIES

    for name in ["knn_ip", "bm25_top_n", "dedup_ranked"]:
        text = plan(QUERIES[name](spark, sf_dir))
        assert "WindowGroupLimit" in text, name


def test_no_plan_has_a_cross_join(spark, plan, sf_dir):
    from textlode.plans.queries import QUERIES

    for name in ["bm25_top_n", "hybrid_v1", "knn_ip", "containing_doc", "dedup_first", "phrase_positions"]:
        text = plan(QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name

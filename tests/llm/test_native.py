import duckdb
import pytest
from pyspark.sql import functions as F

from textlode.llm.oracles import ORACLES
from textlode.llm.queries import QUERIES
from textlode.llm import url_reputation
from textlode.llm.sharding import shard_by_splitters
from textlode.llm.url_reputation import filter_urls, host_reputation, label_outcomes


def no_python(df):
    plan = df._jdf.queryExecution().toString()
    return not any(word in plan for word in ("Python", "Arrow", "Pandas"))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equal_to_sql(spark, name):
    """On a larger table than the tests of all registered queries use."""
    sf_dir = "/root/testdata/sf0.01"
    found = QUERIES[name](spark, sf_dir)
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "pages", "benchmark", "labels"):
        duck.sql(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = duck.sql(ORACLES[name])
    columns = sorted(want.columns)
    assert sorted(found.columns) == columns
    rows = sorted(map(repr, (tuple(r[c] for c in columns) for r in found.collect())))
    assert rows == sorted(map(repr, want.select(*columns).fetchall()))


def test_urls(spark):
    urls = [
        "http://www.EXAMPLE.com/en/x?a#b",
        "https://example.com/en/",
        "https://a.example.com/en",
        "x://m.y.net/fr/1",
        "x://net/es/",
        "x://notnet/es/",
        "no scheme",
        None,
        "http://h?q=/es/",
    ]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, n int")
    none = spark.createDataFrame([], "page_id long, bad int")
    rows = filter_urls(pages, none).orderBy("page_id").collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [
        ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        ("example.com", "/en/", "example.com/en/", "block"),
        ("a.example.com", "/en", "com/", "allow"),
        ("m.y.net", "/fr/1", "net/fr/", "block"),
        ("net", "/es/", "net/es/", "block"),
        ("notnet", "/es/", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("h", "", None, "allow"),
    ]
    assert filter_urls(pages.limit(0), none).count() == 0


def test_bad_host_is_blocked_and_a_single_bad_page_is_not(spark):
    rows = [(i, "x://bad.a.org/p") for i in range(60)] + [(100 + i, "x://ok.a.org/p") for i in range(60)]
    rows += [(200, "x://new.a.org/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    marks = [(i, 1) for i in range(60)] + [(100 + i, int(i == 0)) for i in range(60)] + [(200, 1), (None, 1), (5, None)]
    outcomes = spark.createDataFrame(marks, "page_id long, bad int")
    found = {r.host: r.verdict for r in filter_urls(pages, outcomes).collect()}
    assert found == {"bad.a.org": "block", "ok.a.org": "allow", "new.a.org": "allow"}
    parts = pages.selectExpr("page_id", "split(url, '/')[2] host")
    rate = {r.host: r for r in host_reputation(parts, outcomes).collect()}
    assert rate["bad.a.org"].n == 60 and rate["bad.a.org"].bad == 60
    assert rate["ok.a.org"].mean < rate["new.a.org"].mean < rate["bad.a.org"].mean


def test_labels_with_nulls(spark):
    labels = spark.createDataFrame([(1, None, 1), (2, 0, None), (3, None, None)], "doc_id long, quality int, toxic int")
    assert [r.bad for r in label_outcomes(labels).orderBy("page_id").collect()] == [1, 1, 0]


@pytest.mark.parametrize("hot", [False, True])
def test_shards(spark, hot):
    text = F.when(F.lit(hot) & (F.col("id") % 3 == 0), F.lit("same text")).otherwise(
        F.repeat(F.lit("ä"), (F.col("id") * 37 % 400).cast("int"))
    )
    docs = spark.range(3000).select(
        F.when(F.col("id") % 50 != 1, F.col("id")).alias("doc_id"),
        F.when(F.col("id") % 40 != 2, text).alias("text"),
        F.lit("x").alias("size"),
        F.lit(1).alias("shard"),
    )
    found = shard_by_splitters(docs, 40)
    assert no_python(found)
    rows = found.collect()
    assert len(rows) == 3000 and {r.law for r in rows} == {"bytes"} and {r.grown_shard for r in rows} == {None}
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r)
    assert sorted(by) == list(range(40))
    for group in by.values():
        assert sorted(r.slot for r in group) == list(range(len(group)))
    sums = [sum(r.size for r in group) for group in by.values()]
    assert max(sums) - min(sums) <= 2 * max(r.size for r in rows)
    assert sum(sums) == docs.selectExpr("sum(coalesce(octet_length(text), 0) + 16)").first()[0]


def test_ranges_follow_the_rows_and_change_nothing(spark):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.repeat(F.lit("x"), (F.col("id") % 97).cast("int"))).alias("text")
    ).coalesce(2)
    found = sorted(map(tuple, shard_by_splitters(docs, 7).collect()))
    assert sorted(map(tuple, shard_by_splitters(docs, 7, range_rows=2).collect())) == found
    # The law, row by row: a record lies where the middle of its bytes does, all records in one order.
    total, before = sum(r[1] for r in found), 0
    for doc_id, size, crc, law, shard, slot, grown in sorted(found, key=lambda r: (r[4], r[5])):
        assert shard == min(6, (2 * before + size) * 7 // (2 * total))
        before += size
    # Equal texts are neighbours.
    texts = [r[2] for r in sorted(found, key=lambda r: (r[4], r[5]))]
    assert sum(a != b for a, b in zip(texts, texts[1:])) == len(set(texts)) - 1


def test_levels_of_hosts(spark):
    levels = {
        "a.b.gov.uk": ("b.gov.uk", "gov.uk"), "gov.uk": ("gov.uk", "gov.uk"), "me.github.io": ("me.github.io", "github.io"),
        "x.y.com": ("y.com", "com"), "y.com:8443": ("y.com", "com"), "y.com.": ("y.com", "com"), "u:p@www.y.com:80": ("y.com", "com"),
        "192.168.10.7": ("192.168.10.7", "192.168.10.7"), "10.9.10.7:80": ("10.9.10.7", "10.9.10.7"), "[::1]:80": ("[::1]", "[::1]"),
        "localhost": ("localhost", "localhost"), "": ("", ""), "a.b.s3.amazonaws.com": ("b.s3.amazonaws.com", "s3.amazonaws.com"),
        "q.b.example": ("q.b.example", "b.example"),
    }
    hosts = spark.createDataFrame([(h,) for h in levels], "host string")
    own = (*url_reputation.SUFFIXES, "b.example", "example")
    found = hosts.select("host", url_reputation.domain_of(F.col("host"), own), url_reputation.suffix_of(F.col("host"), own)).collect()
    assert {r[0]: (r[1], r[2]) for r in found} == levels


def test_shards_of_little(spark):
    schema = "doc_id long, text string"
    assert shard_by_splitters(spark.createDataFrame([], schema)).count() == 0
    rows = shard_by_splitters(spark.createDataFrame([(1, None), (1, None), (None, "")], schema)).collect()
    assert sorted((r.size, r.text_crc32) for r in rows if r.text_crc32 is None) == [(16, None), (16, None)]
    assert {r.text_crc32 for r in rows} == {None, 0}
    repeated = spark.createDataFrame([(7, "again")] * 800, schema)
    counts = [r["count"] for r in shard_by_splitters(repeated).groupBy("shard").count().collect()]
    assert len(counts) == 40 and max(counts) - min(counts) <= 2

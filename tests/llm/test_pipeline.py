import collections

import pytest
from brute import components as brute_components
from pyspark.sql import functions as F
from test_decontamination import brute as brute_leaks
from test_packing import tokenizer, verify  # noqa: F401
from test_secrets import brute as brute_secrets

import __spark_entry__
import corpus_pipeline
from textlode.llm.secret_scan import BASE, MORE
from textlode.llm.toxicity import fit_severity, score_severity

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark, sf_dir, tmp_path_factory):
    """Rows before and after each stage, written and read as the pipeline does."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(kept):
    assert [name for name, _ in corpus_pipeline.STAGES] == list(kept)
    for name, (before, after) in list(kept.items())[:-1]:
        assert before.columns == after.columns == COLUMNS and before.schema == after.schema, name


def test_toxicity(spark, sf_dir, kept):
    before, after = kept["toxicity"]
    model = fit_severity(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    fine = [r.doc_id for r in score_severity(before, model).collect() if not r.rejected]
    assert sorted(fine) == sorted(r[0] for r in rows(after))


def test_near_copies(kept):
    before, after = kept["near_copies"]
    group = collections.defaultdict(list)
    for i, n, c in brute_components(rows(before), 5, 4, 5):
        group[c if n else (i,)].append(i)
    assert sorted(min(ids) for ids in group.values()) == sorted(r[0] for r in rows(after))


def test_decontamination(spark, sf_dir, kept):
    before, after = kept["decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {r[0] for r in brute_leaks(rows(before), items)}
    assert leaks and sorted(r for r in rows(before) if r[0] not in leaks) == sorted(rows(after))


def test_secrets(kept):
    before, after = kept["secrets"]
    new = dict(rows(after))
    assert len(new) == before.count()
    for i, text in rows(before):
        if not brute_secrets(text, BASE + MORE):
            assert new[i] == text
    assert after.filter(F.col("n_chars") != F.length("text")).count() == 0


def test_packing(kept, tokenizer):  # noqa: F811
    before, after = kept["packing"]
    verify(after.collect(), rows(before), tokenizer)


def test_registered(spark, sf_dir, kept):
    queries = __spark_entry__.queries()
    numbers = sorted(int(name[2:].split("_")[0]) for name in queries if name.startswith("op") and name[2].isdigit())
    assert numbers == list(range(1, 14))
    found = queries["pipeline"](spark, sf_dir)
    pick = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, found.select(*pick).collect())) == sorted(map(tuple, kept["packing"][1].select(*pick).collect()))


def test_stages_on_odd_rows(spark, sf_dir):
    schema = "doc_id long, text string, lang string, source string, n_chars long, severity string, node long, _copy int"
    fox = "the quick brown fox jumps over the lazy dog near the river bank"
    odd = [(1, None), (2, ""), (None, fox), (3, fox), (3, fox), (3, fox + " x y z w"), (None, None), (4, fox.upper())]
    docs = spark.createDataFrame([(i, t, "en", None, None, "s", 1, 2) for i, t in odd], schema)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf_dir)
        assert after.columns == docs.columns, name
        assert stage(spark, docs.limit(0), sf_dir).count() == 0, name
        if name == "near_copies":
            got = sorted(((r.doc_id, r.text) for r in after.collect()), key=repr)
            assert got == sorted([(1, None), (2, ""), (None, None), (3, fox), (3, fox + " x y z w")], key=repr)
        else:
            assert after.count() == len(odd), name

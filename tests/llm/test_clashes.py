"""Columns of the input that are named like the operators' own, or oddly."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from textlode.llm.common import spread_join
from textlode.llm.disclosure import sanitise
from textlode.llm.partenum import one_per_group

ODD = ["_key", "_KEY_", "_row", "_spans", "_salt", "a`b", "a.b", "root", "node", "grp", "rejected", "_toxicity_x"]


@pytest.fixture
def odd(spark):
    texts = ["one two three four five six"] * 3 + ["one two three four five six seven", None, "", "write to ann@mail.org", "write to ann@mail.org now"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return docs.select("*", *[F.concat(F.lit(f"{n}-"), F.col("doc_id")).alias(c) for n, c in enumerate(ODD)])


def told(df):
    return {r["doc_id"]: tuple(r)[2:] for r in df.collect()}


def test_columns_come_back_as_they_were(spark, odd):
    before = told(odd)
    for made in (one_per_group(odd, k=5, num=4, den=5), sanitise(odd)):
        after = told(made)
        assert made.columns == odd.columns and after and all(before[i] == row for i, row in after.items())
    assert set(told(one_per_group(odd, k=5, num=4, den=5))) == {0, 3, 4, 5, 6, 7}


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_of_the_pipeline(spark, sf_dir, odd, name):
    before = told(odd)
    made = dict(corpus_pipeline.STAGES)[name](spark, odd, sf_dir)
    after = told(made)
    assert made.columns == odd.columns and len(after) >= 5 and all(before[i] == row for i, row in after.items())


@pytest.mark.parametrize("fits", [True, False])
def test_spread_join_hides_no_column(spark, odd, fits):
    names = spark.createDataFrame([(1, "x"), (2, "y")], "doc_id long, _salt_ string")
    found = spread_join(odd, names, "doc_id", "left", fits)
    assert set(found.columns) == {*odd.columns, "_salt_"} and found.count() == odd.count()
    assert {r["_salt"] for r in found.collect()} == {r["_salt"] for r in odd.collect()}

"""Every registered query against its SQL, on whole tables."""

import math

import duckdb
import pandas as pd
import pytest

from __spark_entry__ import entry, oracle_sql, queries

TABLES = ["documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def spelled(value):
    if value is None or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return "NULL"
    return repr(value.item() if hasattr(value, "item") else value)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(spelled, row)) for row in frame.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equal_to_sql(spark, duck, sf_dir, name):
    found = queries()[name](spark, sf_dir).toPandas()
    expected = duck.sql(oracle_sql()[name]).df()
    assert sorted(found.columns) == sorted(expected.columns)
    assert rows(found) == rows(expected)
    assert len(found) > 0


@pytest.mark.parametrize("name", sorted(set(queries()) - set(oracle_sql())))
def test_without_sql_gives_rows(spark, sf_dir, name):
    assert queries()[name](spark, sf_dir).count() > 0


def test_entry(spark):
    hits = entry(spark)
    assert hits.columns == ["query_id", "rank", "doc_id", "score"]
    assert hits.count() > 0

"""Annotators that come as batch functions."""

import pytest

from textlode.operators.annotate import annotate_forms, annotate_texts, entity_rows
from textlode.operators.tokens import extract_triples


def test_every_form_is_annotated_once(spark):
    def strict_forms():
        seen = set()

        def model(forms):
            # Every form once, never a blank one, and no more than the batch size.
            assert len(forms) <= 2 and all(f and f.strip() for f in forms) and not seen & set(forms)
            seen.update(forms)
            return [(None if f == "odd" else f.upper(), "X") for f in forms]

        return model

    words = ["a", "b", None, "a", " ", "", "odd", "c", "a", "d", "e"]
    rows = spark.createDataFrame(list(enumerate(words)), "n int, token string").selectExpr("*", "'old' AS lemma", "n AS form").repartition(3)
    found = annotate_forms(rows, strict_forms, batch_size=2)
    assert found.columns == ["token", "n", "form", "lemma", "pos"]
    told = {r.n: (r.token, r.lemma, r.pos) for r in found.collect()}
    assert told == {n: (w, w if w in ("odd", " ", "", None) else w.upper(), "X" if w and w.strip() else None) for n, w in enumerate(words)}


def test_texts_stay_aligned_with_their_rows(spark):
    def strict_texts():
        def model(texts):
            assert 0 < len(texts) <= 2 and all(t and t.strip() for t in texts)
            return [
                ([{"text": w, "lemma": w, "rel": r} for w, r in zip(t.split(), ("nsubj", "root", "obj"))], [{"text": t, "type": "ORG", "start": 0}] if "x" in t else [])
                for t in texts
            ]

        return model

    texts = ["s v o", None, "", "x y", "  ", "p q r", "x", None, "k l m"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").selectExpr("*", "1 AS tokens", "2 AS _stripped")
    found = annotate_texts(rows.coalesce(1), "text", strict_texts, batch_size=2)
    assert found.columns == ["doc_id", "text", "_stripped", "tokens", "entities"]
    told = {r.doc_id: (r.text, [t.text for t in r.tokens], [e.text for e in r.entities]) for r in found.collect()}
    assert told == {n: (t, (t or "").split(), [t] if t and "x" in t else []) for n, t in enumerate(texts)}
    triples = sorted(map(tuple, extract_triples(found, "doc_id").collect()))
    assert triples == [(0, "s", "v", "o"), (5, "p", "q", "r"), (8, "k", "l", "m")]
    assert sorted((r.doc_id, r.text, r.type, r.length) for r in entity_rows(found, "doc_id").collect()) == [(3, "x y", "ORG", 2), (6, "x", "ORG", 1)]


def test_a_model_that_loses_rows_is_an_error(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id int, text string").coalesce(1)
    with pytest.raises(Exception, match="returned 1 rows for 2"):
        annotate_texts(rows, "text", lambda: lambda texts: [([], [])]).collect()


def test_answers_of_few_texts_are_held_at_a_time(spark):
    def counting():
        live = [0]

        class Answer(dict):
            def __init__(self, **fields):
                super().__init__(**fields)
                live[0] += 1

            def __del__(self):
                live[0] -= 1

        def model(texts):
            # Those of the batch before may still be on their way.
            assert live[0] <= 4, live
            return [([Answer(text=t)], []) for t in texts]

        return model

    texts = [None if n % 7 == 3 else f"t{n}" for n in range(200)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").coalesce(1)
    found = annotate_texts(rows, "text", counting, batch_size=4)
    assert {r.doc_id: [t.text for t in r.tokens] for r in found.collect()} == {n: [t] if t else [] for n, t in enumerate(texts)}

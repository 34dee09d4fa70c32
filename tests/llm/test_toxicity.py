import math

import numpy as np

from textlode.llm.queries import QUERIES
from textlode.llm.toxicity import SeverityModel, fit_severity, fit_thresholds, score_severity, words_of

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").repartition(8)
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = fit_severity(docs, labels.filter("doc_id % 2 = 0"))
    rows = score_severity(docs, model).join(labels.filter("doc_id % 2 = 1").select("doc_id", "toxic"), "doc_id").collect()
    caught = [r.rejected for r in rows if r.toxic]
    wrong = [r.rejected for r in rows if not r.toxic]
    assert np.mean(caught) >= 0.9 and np.mean(wrong) <= 0.005
    assert np.mean([r.severity for r in rows if r.toxic]) > np.mean([r.severity for r in rows if not r.toxic]) + 0.7


def test_query_scores_every_row(spark):
    rows = QUERIES["op1_toxicity"](spark, SF).collect()
    ids = [r.doc_id for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()]
    assert sorted(r.doc_id for r in rows) == sorted(ids)
    assert all(0 <= r.severity <= 3 and r.rejected == (r.severity >= 0.5) for r in rows)


def test_scores_equal_a_plain_computation(spark):
    """All documents by the model's weights, feature by feature."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = fit_severity(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    assert model.weights and model.thresholds[0] < model.thresholds[1] < model.thresholds[2]

    def plain(text):
        seen, word = {}, ""
        for c in (text or "").lower() + " ":
            if c.isalpha():
                word += c
                continue
            for f in [word, *[word[:k] + "-" for k in (4, 5, 6) if len(word) > k]]:
                seen[f] = seen.get(f, 0) + 1
            word = ""
        eta = sum(math.log(1 + n) * model.weights[f] for f, n in seen.items() if f in model.weights)
        return sum(1 / (1 + math.exp(min(500, t - eta))) for t in model.thresholds)

    for r in score_severity(docs, model).collect():
        want = plain(r.text)
        assert abs(r.severity - want) < 2e-6 and r.rejected == (r.severity >= 0.5) and r.grade == min(3, int(r.severity + 0.5))


def test_thresholds_are_ordered_and_grades_recovered():
    rng = np.random.default_rng(0)
    strength = rng.integers(0, 4, 600)
    row = np.arange(600)
    weights, cuts = fit_thresholds(row, np.zeros(600, int), strength.astype(float), strength, 1, rounds=800)
    assert weights[0] > 0 and cuts[0] < cuts[1] < cuts[2]
    eta = strength * weights[0]
    assert np.mean((eta[:, None] > cuts).sum(1) == strength) > 0.99


def test_edges(spark):
    model = SeverityModel({"bad": 4.0, "awfu-": 9.0}, (2.0, 4.0, 6.0))
    docs = spark.createDataFrame(
        [(1, None, 5), (2, "", 5), (3, "BAD, bad!", None), (None, "awfully", 5), (3, "BAD, bad!", 5), (4, "ok " * 90_000, 5)],
        "doc_id long, text string, grade int",
    )
    rows = score_severity(docs, model).collect()
    assert len(rows) == 6 and rows[0].asDict().keys() == {"doc_id", "text", "severity", "grade", "rejected"}
    by = {r.doc_id: r for r in rows}
    assert by[1].severity == by[2].severity == by[4].severity == round(model.severity(0.0), 6) and not by[4].rejected
    assert by[3].rejected and by[None].rejected
    assert score_severity(docs.limit(0), model).count() == 0
    assert words_of(None) == {} and words_of("Ärger über_alles")["ärger"] == 1


def test_without_both_classes_nothing_is_rejected(spark):
    docs = spark.createDataFrame([(1, "idiot"), (None, None)], "doc_id long, text string")
    for rows in ([], [(1, 1), (None, 1), (7, None)]):
        labels = spark.createDataFrame(rows, "doc_id long, toxic int")
        model = fit_severity(docs, labels)
        assert [r.rejected for r in score_severity(docs, model).collect()] == [False, False]


def test_the_sample_is_bounded_whatever_repeats(spark):
    from textlode.llm.toxicity import labelled_sample

    docs = spark.createDataFrame([(i % 40, f"text {i}") for i in range(400)] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i % 40, i % 2) for i in range(80)] + [(None, 1)], "doc_id long, toxic int")
    rows = labelled_sample(docs, labels, 7).collect()
    assert len(rows) == 14 and sum(r.toxic for r in rows) == 7

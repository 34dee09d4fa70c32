"""Toxicity grades by cumulative-link ordinal regression over sparse text features.

Features are words and word beginnings.  A bounded sample of labelled
documents selects those that tell toxic from clean texts; one weight vector
shared by all ordered thresholds is fitted to grades 0 (clean) to 3; every
text gets its expected grade.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlode.llm.common import small_batches
from textlode.operators.joins import numbered
from textlode.sources.store import settle

# Labelled documents of each class that the fit sees at most, chosen by a hash of their id.
SAMPLE = 8_192
# Features that the model keeps at most, and what one must show: documents, log-likelihood ratio, log odds.
FEATURES, LEAST_DOCS, LEAST_RATIO, LEAST_ODDS = 8_192, 3, 12.0, 1.5
BEGINNINGS = (4, 5, 6)
GRADES = 4
# Expected grade from which a document is rejected.
REJECT = 0.5

WORD = re.compile(r"[^\W\d_]+")


class SeverityModel(NamedTuple):
    """Weights shared by all thresholds; P(grade >= k) = sigmoid(weights · x - thresholds[k - 1])."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def severity(self, eta: float) -> float:
        return float(sum(1 / (1 + np.exp(np.clip(t - eta, -500, 500))) for t in self.thresholds))


def features_of(word: str) -> list[str]:
    """The word, and its beginnings marked by a hyphen."""
    return [word, *[word[:k] + "-" for k in BEGINNINGS if len(word) > k]]


def words_of(text: str | None) -> Counter:
    return Counter(WORD.findall(text.lower())) if text else Counter()


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """`(text, toxic)` for at most `sample` labelled documents of each class.

    A document with several labels is toxic if one says so; null ids and null
    marks are left out.  Of rows that share an id the smallest text counts.
    Written once, for several passes go over it.
    """
    marks = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    order = [F.xxhash64("doc_id", F.lit(11)), F.col("doc_id")]
    chosen = [marks.filter(F.col("toxic") == y).orderBy(*order).limit(sample) for y in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])
    # At most 2 * sample rows of two numbers.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    once = rows.groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    return settle(once.select("text", "toxic"))


def select_features(sample: DataFrame) -> dict[str, float]:
    """Features with a strong log-likelihood ratio between the classes, and their log odds."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        n = [0, 0]
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {f for word in words_of(text) for f in features_of(word)}
                seen[toxic].update(own)
                n[toxic] += 1
        names = [*(seen[0].keys() | seen[1].keys()), ""]
        rows = [[s[f] for f in names[:-1]] + [k] for s, k in zip(seen, n, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *[pa.array(r, pa.int64()) for r in rows]], ["feature", "clean", "toxic"]
        )

    counts = (
        sample.mapInArrow(count, "feature string, clean long, toxic long")
        .groupBy("feature")
        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
        .filter(F.col("clean") + F.col("toxic") >= LEAST_DOCS)
    )
    whole = sample.agg(F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0)), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    n0, n1 = float(whole[0]), float(whole[1])
    if not n0 or not n1:
        return {}
    a, b = F.col("toxic"), F.col("clean")
    odds = F.log(((a + 0.1) / (n1 + 0.2)) / ((b + 0.1) / (n0 + 0.2)))
    rate = (a + b) / F.lit(n0 + n1)

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    ratio = 2 * (part(a, rate * n1) + part(b, rate * n0))
    strong = (
        counts.filter(F.col("feature") != "")
        .select("feature", odds.alias("odds"), ratio.alias("ratio"))
        .filter((F.col("ratio") >= LEAST_RATIO) & (F.abs("odds") >= LEAST_ODDS))
        .orderBy(F.desc("ratio"), "feature")
        .limit(FEATURES)
    )
    return {row.feature: row.odds for row in strong.collect()}


def _vectors(sample: DataFrame, index: dict[str, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of the sample's features, and its classes."""
    import pyarrow as pa

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns, values = [], []
            for text in batch.column(0).to_pylist():
                found = Counter()
                for word, n in words_of(text).items():
                    for f in features_of(word):
                        if f in index:
                            found[index[f]] += n
                columns.append(np.array(list(found), "<i4").tobytes())
                values.append(np.log1p(np.array(list(found.values()), "<f4")).astype("<f4").tobytes())
            arrays = [batch.column(1), pa.array(columns, pa.binary()), pa.array(values, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["toxic", "columns", "amounts"])

    # At most 2 * SAMPLE rows of at most FEATURES numbers, commonly a few dozen.
    rows = sample.mapInArrow(count, "toxic int, columns binary, amounts binary").collect()
    columns = [np.frombuffer(r.columns, "<i4") for r in rows]
    row = np.repeat(np.arange(len(rows)), [len(c) for c in columns])
    amounts = [np.frombuffer(r.amounts, "<f4") for r in rows]
    empty = [np.empty(0, np.int32)]
    return (
        row,
        np.concatenate(columns or empty).astype(np.int64),
        np.concatenate(amounts or empty).astype(float),
        np.array([r.toxic for r in rows], np.int64),
    )


def _grades(row, column, value, toxic, odds) -> np.ndarray:
    """Grade 0 for clean documents; toxic ones in three equal parts by their amount of telling features."""
    n = len(toxic)
    amount = np.bincount(row, value * np.maximum(0, odds[column]), n)
    grade = np.zeros(n, np.int64)
    bad = np.flatnonzero(toxic)
    cuts = np.quantile(amount[bad], [1 / 3, 2 / 3]) if len(bad) else [0, 0]
    grade[bad] = 1 + (amount[bad] > cuts[0]) + (amount[bad] > cuts[1])
    return grade


def fit_thresholds(row, column, value, grade, width, rounds: int = 400, decay: float = 1e-4):
    """Weights and ascending thresholds of the cumulative logit model, by Adam on the whole sample."""
    n, k = max(len(grade), 1), GRADES - 1
    weights, base = np.zeros(width), np.array([1.0] + [0.0] * (k - 1))
    means, squares = [np.zeros(width), np.zeros(k)], [np.zeros(width), np.zeros(k)]
    sigmoid = lambda z: 1 / (1 + np.exp(-np.clip(z, -500, 500)))
    at = np.arange(len(grade))
    for t in range(1, rounds + 1):
        steps = np.exp(base[1:])
        thresholds = np.concatenate([base[:1], base[0] + np.cumsum(steps)])
        eta = np.bincount(row, value * weights[column], len(grade))
        above = sigmoid(eta[:, None] - thresholds)  # P(grade > j)
        full = np.concatenate([np.ones((len(grade), 1)), above, np.zeros((len(grade), 1))], 1)
        p = np.maximum(full[at, grade] - full[at, grade + 1], 1e-12)
        slope = above * (1 - above)
        slopes = np.concatenate([np.zeros((len(grade), 1)), slope, np.zeros((len(grade), 1))], 1)
        d_eta = -(slopes[at, grade] - slopes[at, grade + 1]) / p / n
        d_cut = np.zeros((len(grade), k + 2))
        d_cut[at, grade] += slopes[at, grade] / p / n
        d_cut[at, grade + 1] -= slopes[at, grade + 1] / p / n
        d_thresholds = d_cut[:, 1:-1].sum(0)
        d_base = np.concatenate([[d_thresholds.sum()], np.cumsum(d_thresholds[::-1])[::-1][1:] * steps])
        d_weights = np.bincount(column, value * d_eta[row], width) + decay * weights
        for i, (x, g) in enumerate(((weights, d_weights), (base, d_base))):
            means[i] = 0.9 * means[i] + 0.1 * g
            squares[i] = 0.999 * squares[i] + 0.001 * g * g
            x -= 0.05 * (means[i] / (1 - 0.9**t)) / (np.sqrt(squares[i] / (1 - 0.999**t)) + 1e-8)
    return weights, np.concatenate([base[:1], base[0] + np.cumsum(np.exp(base[1:]))])


def fit_severity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> SeverityModel:
    """A model from `docs(doc_id, text)` and `labels(doc_id, toxic)`; without both classes it calls all texts clean."""
    small_batches(docs.sparkSession)
    rows = labelled_sample(docs, labels, sample)
    odds = select_features(rows)
    if not odds:
        return SeverityModel({}, (50.0, 51.0, 52.0))
    names = sorted(odds)
    row, column, value, toxic = _vectors(rows, {f: i for i, f in enumerate(names)})
    grade = _grades(row, column, value, toxic, np.array([odds[f] for f in names]))
    weights, thresholds = fit_thresholds(row, column, value, grade, len(names))
    return SeverityModel(dict(zip(names, weights.tolist(), strict=True)), tuple(thresholds.tolist()))


def score_severity(
    docs: DataFrame, model: SeverityModel, reject: float = REJECT, text_col: str = "text", prefix: str = ""
) -> DataFrame:
    """`docs` with `severity` (expected grade, six digits), `grade` (the nearest) and `rejected`.

    Names are preceded by `prefix`; input columns of the same names are
    replaced.  Null and empty texts have the severity of a text without
    features and are never rejected.
    """
    import pyarrow as pa

    small_batches(docs.sparkSession)
    taken = [f"{prefix}{name}" for name in ("severity", "grade", "rejected")]
    kept = docs.drop(*taken)
    at = kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights = model.weights
        known: dict[str, tuple[int, ...]] = {}
        names = list(weights)
        index = {f: i for i, f in enumerate(names)}
        amounts = np.array([weights[f] for f in names])

        def ids(word: str) -> tuple[int, ...]:
            if len(known) > 100_000:
                known.clear()
            found = known[word] = tuple(index[f] for f in features_of(word) if f in index)
            return found

        for batch in batches:
            severity = []
            for text in batch.column(at):
                found: dict[int, int] = {}
                for word, n in words_of(text.as_py()).items():
                    own = known.get(word)
                    for i in ids(word) if own is None else own:
                        found[i] = found.get(i, 0) + n
                eta = float(np.log1p(np.fromiter(found.values(), float)) @ amounts[list(found)]) if found else 0.0
                severity.append(round(model.severity(eta), 6))
            values = np.array(severity, float)
            grades = np.minimum(GRADES - 1, np.floor(values + 0.5)).astype(np.int32)
            columns = [pa.array(values), pa.array(grades), pa.array(values >= reject)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], [*batch.schema.names, "t0", "t1", "t2"])

    plain, kinds = numbered(kept), (T.DoubleType(), T.IntegerType(), T.BooleanType())
    schema = T.StructType([*plain.schema.fields, *[T.StructField(f"t{i}", kind) for i, kind in enumerate(kinds)]])
    return plain.mapInArrow(run, schema).toDF(*kept.columns, *taken)

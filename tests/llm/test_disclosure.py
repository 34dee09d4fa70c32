import hashlib
import re

from pyspark.sql import functions as F

from textlode.llm.disclosure import digest, find_disclosures, sanitise
from textlode.llm.queries import QUERIES

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text):
    spans = []
    for order, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            if valid(kind, m.group()):
                spans.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}"))
    return [s for *_, s in sorted(spans)]


def check(rows, pairs):
    """rows of the query against (doc_id, text)."""
    key = lambda r: (r[0] is None, r[0] or 0, r[-2])
    want = []
    for doc_id, text in pairs:
        spans = brute(text)
        counts = [sum(s.startswith(k + ":") for s in spans) for k in BASE]
        want.append((doc_id, *counts, hashlib.sha256(",".join(spans).encode()).hexdigest(), ",".join(spans)))
    got = [(*r[:6], ",".join(s for s in r.spans.split(",") if not s.startswith("term:"))) for r in rows]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_base_spans_of_the_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op4_disclosure"](spark, sf_dir)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    check(found.collect(), docs)


def test_edges(spark):
    texts = [
        None,
        "",
        "a@b.c.d@e.f a@b.c_x@e.f @b.c a@b a@b..c",
        "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 00255.0.0.1 0000256.0.0.1 " + "9" * 40 + ".1.1.1",
        "4111 1111 1111 1111 4111-1111-1111-1112 4111  1111 0000000000000000000000",
        "+49 (30) 123-4567, +1 23 + 4 +12345678901234567 +1 2345678901(",
        "😀ä 😀 x.y@z.de 4111111111111111😀 10.0.0.1",
        "a" * 60_000 + " " + "1" * 60_000 + " " + "." * 1000 + "@" * 1000 + "+" * 1000,
        "1.2.3.4 " * 400,
    ]
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, texts[3], "s"), (3, texts[3], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    check(digest(find_disclosures(docs)).collect(), [r[:2] for r in rows])
    assert digest(find_disclosures(docs.limit(0))).count() == 0


def test_a_telling_word_is_found_and_common_ones_are_not(spark):
    filler = [f"the common words number {chr(97 + i % 26) * 5} stand here" for i in range(200)]
    near = [f"the {w} called Zorblat with ann@mail.org for the {w}" for w in ("budget", "answer", "weather")]
    texts = filler + near + [near[0]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in digest(find_disclosures(docs)).collect()}
    at = near[0].index("Zorblat")
    assert f"term:{at}:{at + 7}" in rows[200].spans
    said = {texts[i][int(a) : int(b)].lower() for i, r in rows.items() for k, a, b in
            (s.split(":") for s in r.spans.split(",") if s) if k == "term"}
    assert "zorblat" in said and not said & {"the", "common", "budget", "answer", "weather"}
    assert all(rows[i].spans == "" for i in range(200))
    clean = {r.doc_id: r.text for r in sanitise(docs.withColumn("_spans_", F.lit(1))).collect()}
    assert len(clean) == len(texts) and clean[0] == texts[0]
    assert "Zorblat" not in clean[200] and "ann@" not in clean[200] and "[email]" in clean[200]


def test_copies_change_no_estimate(spark):
    """Every document, or only those that tell, 1, 60 and 300 times: the same words are found."""
    filler = [f"the common words number {chr(97 + i % 26) * 5} stand here {i}" for i in range(400)]
    near = [f"the {w} called Zorblat with ann@mail.org for the {w}" for w in ("budget", "answer")]

    def said(texts):
        frame = spark.createDataFrame([(t,) for t in texts], "text string").repartition(4).selectExpr("1L AS doc_id", "text")
        found = find_disclosures(frame.withColumn("doc_id", F.xxhash64("text"))).distinct().collect()
        by_id = {r.doc_id: r.spans for r in found}
        ids = spark.createDataFrame([(t,) for t in set(texts)], "text string").select(F.xxhash64("text"), "text").collect()
        return {(t, t[s.start : s.end]) for i, t in ids for s in by_id[i] if s.kind == 4}

    want = said(filler + near)
    assert {w for _, w in want} >= {"Zorblat"} and not {w for _, w in want} & {"the", "budget"}
    for times in (60, 300):
        assert said(filler + near * times) == want, times
    assert said((filler + near) * 60) == want


def test_one_context_is_no_estimate(spark):
    same = "only ever Quuxly before bob@mail.org once"
    docs = spark.createDataFrame([(i, same) for i in range(5)], "doc_id long, text string")
    assert all(r.n_email == 1 and "term" not in r.spans for r in digest(find_disclosures(docs)).collect())

import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from textlode.llm.queries import QUERIES
from textlode.llm.secret_scan import BASE, MORE, redact_secrets, scan_secrets
from textlode.llm.trigrams import check, trigram_query


def brute(text, rules):
    spans = []
    for order, rule in enumerate(rules):
        for m in re.finditer(rule.pattern, text, rule.flags):
            if len(m.group(rule.group)) >= rule.least:
                spans.append((m.start(), order, rule.kind, m.end()))
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(spans)]


def expected(doc_id, text):
    base = brute(text or "", BASE)
    n = [sum(s.startswith(r.kind + ":") for s in base) for r in BASE]
    digest = hashlib.sha256(",".join(base).encode()).hexdigest()
    return (doc_id, *n, digest, ",".join(brute(text or "", BASE + MORE)))


def test_query_equals_plain_search(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    found = QUERIES["op9_trigram_secrets"](spark, sf_dir).collect()
    assert sorted(map(tuple, found)) == sorted(expected(*r) for r in docs)


def test_edges(spark):
    texts = [
        None,
        "",
        "PassWord = 'abcdef' and token:xyz",
        "äö😀 api_key=\"A1b2C3d4\" apikey:12345",
        "AKIA" + "A" * 16 + " AKIAB AKIA" + "0" * 15,
        "f" * 23 + " " + "0" * 24 + "g" + "a" * 30,
        "-----BEGIN RSA PRIVATE KEY----- ghp_" + "a" * 36,
        "paſſword=abcdefgh to\u212aen=abcdefgh",
        "x" * 200_000 + " secret=abcdef",
        "ab",
    ]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(None, texts[2], "x"), (2, texts[2], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = scan_secrets(docs).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    assert sorted(map(tuple, found), key=key) == sorted((expected(r[0], r[1]) for r in rows), key=key)
    assert scan_secrets(docs.limit(0)).count() == 0


def test_redacted(spark):
    rows = [(1, "a token=abcdef b", 16), (2, None, 0), (3, "clean", 5), (4, "token=" + "a" * 30 + ".", 37)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    clean = redact_secrets(docs)
    assert clean.columns == docs.columns
    got = {r.doc_id: (r.text, r.n_chars) for r in clean.collect()}
    assert got == {1: ("a [assign] b", 12), 2: (None, None), 3: ("clean", 5), 4: ("[assign]", 8)}
    assert sum(r.n_assign + r.n_access + r.n_hex for r in scan_secrets(clean).collect()) == 0


def test_queries_of_rules():
    assert trigram_query("AKIA[A-Z0-9]+") == ("and", (b"aki", b"kia"))
    assert trigram_query("[0-9a-f]+") is True
    assert set(trigram_query("a(bc|bd)e")[1]) == {("and", (b"abc", b"bce")), ("and", (b"abd", b"bde"))}
    named = trigram_query(BASE[0].pattern, BASE[0].flags)
    assert named[0] == "or" and (("and", (b"tok", b"oke", b"ken"))) in named[1]
    assert all(trigram_query(r.pattern, r.flags) is not True for r in MORE)


@settings(max_examples=300, deadline=None)
@given(st.text("passwordtkeni_=:AKI'\" xgh0", max_size=40), st.sampled_from(BASE + MORE))
def test_the_index_loses_no_match(text, rule):
    assert check(rule.pattern, rule.flags, text)


@pytest.mark.parametrize("pattern,text", [("(ab|abcd)+xyz", "ababcdxyz"), ("a?bc{2}d", "bccd"), ("(foo)?bar|qux", "qux")])
def test_other_expressions(pattern, text):
    assert re.search(pattern, text) and check(pattern, 0, text)

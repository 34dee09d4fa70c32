"""Literal texts for what a second SQL spelling might get wrong in the same way."""

import random

import pytest
from pyspark.sql import functions as F

from textlode.functions import cleaning as C
from textlode.functions import tokens as T


def values(spark, texts, clean):
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = frame.select("id", clean(F.col("text")).alias("out")).collect()
    return [row.out for row in sorted(rows)]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("Мёд, ЁЖ и 3 слона!", "мед еж и слона"),
        ("see https://t.me/a_b?x=1&amp;y now", "see now"),
        ("WWW.Site.org/x end", "end"),
        ("a&amp;b & c &b;;", "a b c"),
        ("@bot /start go", "bot start go"),
        ("naïve café 😀 中文", "na ve caf"),
        ("  \t\n ", ""),
        ("", ""),
        (None, None),
        ("one  two three", "one two three"),
        ("!!&amp;!!x&lt;y", "x y"),
    ],
)
def test_clear_text(spark, text, expected):
    assert values(spark, [text], C.clear_text) == [expected]


def test_fused_cleaning_equals_the_chain(spark):
    pieces = ["http://", "https://x", "www.", "&amp;", "&", ";", "a", "Я", "ё", " ", "  ", " ",
              "😀", "@u", "/c", "#", "1", "é", "\n", "中", "&lt", "w", "ww.", ":", "//"]
    pick = random.Random(5)
    texts = ["".join(pick.choices(pieces, k=pick.randint(0, 25))) for _ in range(3000)]
    assert values(spark, texts, C.clear_text) == values(spark, texts, C.preprocess)


def test_cleaning_is_idempotent(spark):
    texts = ["Some Text, with 12 things & www.x.y links", "Ёлка &nbsp; @a"]
    once = values(spark, texts, C.clear_text)
    assert values(spark, once, C.clear_text) == once


def test_flags_keep_what_they_should(spark):
    text = "Hi 😀 @me /go www.x.y Ё."
    assert values(spark, [text], C.clean_for_display) == ["Hi 😀 www.x.y Ё."]
    assert values(spark, [text], C.clean_for_search) == ["hi @me /go е."]
    assert values(spark, [text], C.clean_social) == ["hi go ё."]


def test_social_cleaning_cuts_without_a_space(spark):
    assert values(spark, ["a#tag b", "x http://y z", None], C.clean_social) == ["a b", "x z", ""]


def test_simple_cleaning_is_not_trimmed(spark):
    assert values(spark, [" A-b,  C_d! "], C.clean_simple) == [" ab c_d "]
    assert values(spark, [" A-b,  C_d! "], C.clean_words) == ["ab c_d"]
    assert values(spark, ["A_b--C "], C.clean_underscore) == ["a b c "]
    assert values(spark, ["É1\t-x"], C.clean_alnum) == ["é1 x"]


def test_processed_text(spark):
    texts = [None, " NaN ", "", "x" * 600, "nan x"]
    assert values(spark, texts, C.processed_text) == ["", "", "", "x" * 500, "nan x"]
    assert values(spark, ["y" * 600], lambda c: C.processed_text(c, None)) == ["y" * 600]


def test_merge_skips_empty_fields(spark):
    frame = spark.createDataFrame([("A!", None, "#x"), (None, None, None)], "a string, b string, c string")
    merged = frame.select(C.merge_fields(F.col("a"), F.col("b"), F.col("c")).alias("m")).collect()
    assert [row.m for row in merged] == ["a!", ""]


def test_word_counts(spark):
    assert values(spark, ["", " ", "a", " a  b "], T.word_count) == [0, 0, 1, 2]


def test_sentences(spark):
    assert values(spark, ["A b. C?  D.e"], T.sentences) == [["A b.", "C?", "D.e"]]


def test_token_spans(spark):
    frame = spark.createDataFrame([("ab c def",), ("",), ("x",)], "t string")
    spans = [
        [(s.token, s.start_clean, s.end_clean) for s in row.s]
        for row in frame.select(T.token_spans(F.col("t")).alias("s")).collect()
    ]
    assert spans == [[("ab", 0, 2), ("c", 3, 4), ("def", 5, 8)], [], [("x", 0, 1)]]


def test_positions_fold_yo_and_run_out_to_the_end(spark):
    assert T.match_positions("Мёд ёж", "мед еж") == [0, 1, 2, 3, 4, 5]
    assert T.match_positions("ab", "abz") == [0, 1, 1]
    assert T.match_positions("x, y", "x y") == [0, 2, 3]
    assert T.match_positions("", "") == []
    # A letter whose lower case is two characters must not shift the rest.
    assert T.match_positions("İab", "ab") == [1, 2]


def test_span_to_original(spark):
    frame = spark.createDataFrame(
        [(0, 2, [0, 3, 7]), (1, 5, [0, 3, 7]), (3, 4, [0, 3, 7]), (0, 1, [])],
        "s int, e int, m array<int>",
    )
    spans = frame.select(T.span_to_original(F.col("s"), F.col("e"), F.col("m")).alias("o")).collect()
    assert [(r.o.start_orig, r.o.end_orig) for r in spans] == [(0, 4), (3, 9), (-1, -1), (-1, -1)]


@pytest.mark.parametrize("table", ["documents", "conversations"])
def test_slices_fold_to_their_tokens(spark, sf_dir, table):
    """Every word of every text, wherever line breaks, links and marks stand."""
    from textlode.operators.tokens import analyze

    analyzed = analyze(spark.read.parquet(f"{sf_dir}/{table}.parquet").select("text"))
    words = analyzed.select("text", F.explode("tokens").alias("t"))
    cut = words.select("t.token", T.slice_text(F.col("text"), F.col("t.start_orig"), F.col("t.end_orig")).alias("cut"))
    assert cut.count() > 5000
    assert cut.filter(F.lower("cut") != F.col("token")).count() == 0
    assert analyzed.filter(F.col("cleaned_text") != C.clear_text(F.col("text"))).count() == 0
    assert analyzed.filter(F.size("mapping") != F.length("cleaned_text")).count() == 0


def test_exact_places(spark):
    from textlode.operators.tokens import analyze

    texts = ["see HTTPS://t.me/cat?x\nthe&nbsp;cat, Ёж!", "😀 a\n\nb", "", None, "İab c", "www.x.y"]
    frame = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    rows = {r.id: r for r in analyze(frame).collect()}
    spans = lambda i: [(t.token, t.start_clean, t.end_clean, t.start_orig, t.end_orig) for t in rows[i].tokens]
    assert spans(0) == [("see", 0, 3, 0, 3), ("the", 4, 7, 23, 26), ("cat", 8, 11, 32, 35), ("еж", 12, 14, 37, 39)]
    assert rows[0].mapping == [0, 1, 2, 22, 23, 24, 25, 31, 32, 33, 34, 36, 37, 38]
    assert spans(1) == [("a", 0, 1, 2, 3), ("b", 2, 3, 5, 6)]
    assert spans(2) == spans(3) == spans(5) == [] and rows[2].mapping == []
    assert [t.token for t in rows[4].tokens] == ["ab", "c"]


def test_spans_of_a_batch_are_those_of_each_text(spark, monkeypatch):
    """spans found in the bytes of many texts at once, in slices of any size, equal those of one text by its characters."""
    import pyarrow as pa

    texts = ["", " ", None, "a", "ab  éж 😀x ", " zß", "www.a.b q", "x &amp; Ёy\tİc http://u v", None, "last one"] * 3
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    plain = frame.select(T.token_spans(T.aligned_text(F.col("text"))).alias("old"), T.analyzed_spans(F.col("text")).alias("new"))
    for row in plain.collect():
        found = None if row.new is None else [(t.token, t.start_orig, t.end_orig) for t in row.new]
        assert found == (None if row.old is None else [tuple(t) for t in row.old])
        joined = " ".join(t.token for t in row.new or [])
        assert all(joined[t.start_clean : t.end_clean] == t.token for t in row.new or [])
    whole = T._spans(pa.array(texts, pa.string())).to_pylist()
    assert T._spans(pa.array(["q r", *texts, "s"], pa.string()).slice(1, len(texts))).to_pylist() == whole
    for size in (1, 9, 10**6):
        monkeypatch.setattr(T, "SPAN_BYTES", size)
        array = pa.array(texts, pa.string())
        assert [x for low, high in T._slices(array) for x in T._spans(array.slice(low, high - low)).to_pylist()] == whole


def test_long_texts_take_linear_time(spark):
    import time

    text = "word and http://a.b/c more &amp; " * 3200
    frame = spark.createDataFrame([(text,)], "text string")
    frame.select(F.size(T.original_spans(F.col("text")))).collect()
    started = time.time()
    assert frame.select(F.size(T.original_spans(F.col("text")))).head()[0] == 3 * 3200
    assert time.time() - started < 5


def test_context_window(spark):
    doc = " ".join(f"w{i}" for i in range(20))
    frame = spark.createDataFrame(
        [(doc, "w8 w9"), (doc, "w0"), (doc, "w19"), (doc, "w9 w8"), ("a b", "a b c")], "d string, f string"
    )
    windows = frame.select(T.context_window(F.col("d"), F.col("f"), 2).alias("w")).collect()
    assert [r.w for r in windows] == ["w6 w7 w8 w9 w10 w11", "w0 w1 w2", "w17 w18 w19", "w9 w8", "a b c"]

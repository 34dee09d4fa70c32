"""Tokens, sentences and spans as row-local Column expressions.

A text is one row, so everything about its tokens is computed inside that
row: no explode, shuffle or window is needed to number or pair tokens.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textlode.functions.cleaning import ALPHABET, ENTITY, URL, WS, clear_text, let


def words(col: Column) -> Column:
    """White-space tokens of any text; a blank text has none."""
    return F.filter(F.split(col, f"[{WS}]+"), lambda w: w != "")


def clean_words_of(col: Column) -> Column:
    """Tokens of an already cleaned (single-spaced, trimmed) text."""
    return F.when(col == "", F.array().cast("array<string>")).otherwise(F.split(col, " "))


def word_counts(words: Column) -> Column:
    """`array<struct<word, n>>`: every different word and its number, by the runs of the sorted words."""

    def runs(s: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(s) - 1)
        starts = F.filter(places, lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(
            starts,
            lambda st: F.zip_with(
                st,
                F.concat(F.slice(st, F.lit(2), F.size(st)), F.array(F.size(s))),
                lambda a, b: F.struct(F.get(s, a).alias("word"), (b - a).alias("n")),
            ),
        )

    none = F.array().cast("array<struct<word:string,n:int>>")
    return let(F.sort_array(words), lambda s: F.when(F.size(s) > 0, runs(s)).otherwise(none))


def word_count(col: Column) -> Column:
    return F.size(words(col))


def sentences(col: Column) -> Column:
    """Split after `.`, `!` or `?` followed by white space."""
    return F.split(col, rf"(?<=[.!?])[{WS}]+")


def token_spans(col: Column) -> Column:
    """Tokens of a cleaned text with their character range.

    `array<struct<token, start_clean, end_clean>>`.  One pass over the
    characters finds the spaces; the ranges lie between them.
    """
    chars = F.split(col, "")
    spaces = F.filter(
        F.transform(chars, lambda c, i: F.when(c == " ", i)), lambda i: i.isNotNull()
    )
    starts = F.concat(F.array(F.lit(0)), F.transform(spaces, lambda i: i + 1))
    ends = F.concat(spaces, F.array(F.length(col)))
    ranges = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("s"), e.alias("e")))
    spans = F.zip_with(
        F.split(col, " "),
        ranges,
        lambda t, r: F.struct(
            t.alias("token"), r["s"].alias("start_clean"), r["e"].alias("end_clean")
        ),
    )
    return F.filter(spans, lambda s: s["token"] != "")


def adjacent_pairs(tokens: Column) -> Column:
    """`array<struct<first, second, position>>` of neighbouring elements."""
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    zipped = F.zip_with(
        F.slice(tokens, 1, pairs),
        F.slice(tokens, 2, pairs),
        lambda a, b: F.struct(a.alias("first"), b.alias("second")),
    )
    return F.transform(
        zipped,
        lambda p, i: F.struct(
            p["first"].alias("first"), p["second"].alias("second"), i.alias("position")
        ),
    )


def unigrams_bigrams(tokens: Column) -> Column:
    """All tokens, then all neighbouring pairs, with the position of the first word."""
    unigrams = F.transform(
        tokens,
        lambda t, i: F.struct(
            t.alias("token"), i.alias("position"), F.lit("unigram").alias("type")
        ),
    )
    bigrams = F.transform(
        adjacent_pairs(tokens),
        lambda p: F.struct(
            F.concat_ws(" ", p["first"], p["second"]).alias("token"),
            p["position"].alias("position"),
            F.lit("bigram").alias("type"),
        ),
    )
    return F.concat(unigrams, bigrams)


def phrases(tokens: Column) -> Column:
    """One- and two-word phrases of `array<struct<text, lemma, start, stop>>`.

    A pair spans from the start of its first word to the end of its second.
    Applied to the tokens of one sentence, no pair crosses the sentence end.
    """
    single = F.transform(
        tokens,
        lambda t: F.struct(
            F.lit("word").alias("type"),
            t["text"].alias("text"),
            t["lemma"].alias("lemma"),
            t["start"].alias("start"),
            t["stop"].alias("stop"),
            F.lit(1).alias("length"),
        ),
    )
    pairs = F.transform(
        adjacent_pairs(tokens),
        lambda p: F.struct(
            F.lit("phrase").alias("type"),
            F.concat_ws(" ", p["first"]["text"], p["second"]["text"]).alias("text"),
            F.concat_ws(" ", p["first"]["lemma"], p["second"]["lemma"]).alias("lemma"),
            p["first"]["start"].alias("start"),
            p["second"]["stop"].alias("stop"),
            F.lit(2).alias("length"),
        ),
    )
    return F.concat(single, pairs)


def runs_of(tokens: Column, lengths: list[int], begins: list[str] | None = None) -> Column:
    """All runs of so many words of `array<struct<text, lemma, start, stop>>`.

    With `begins`, only runs whose lemmas, joined, begin with one of these: the first two words, or the only one, of the wanted.
    """

    def heads(t: Column, words: int) -> Column:
        """Places of runs of at least so many words, one or two."""
        every = F.sequence(F.lit(1), F.greatest(F.size(t) - words + 1, F.lit(1)))
        if begins is None:
            return every

        def wanted(i: Column) -> Column:
            lemmas = [F.get(t, i + (n - 1))["lemma"] for n in range(words)]
            start = F.substring_index(F.concat(*[x for m in lemmas for x in (F.lit(" "), m)][1:]), " ", 2)
            # A lemma that is missing is left out of the joined ones.
            return start.isNull() | start.isin(begins)

        return F.filter(every, wanted)

    def runs(t: Column, at: Column, length: int) -> Column:
        made = F.transform(
            at,
            lambda i: F.struct(
                F.array_join(F.transform(F.slice(t, i, length), lambda w: w["text"]), " ").alias("text"),
                F.array_join(F.transform(F.slice(t, i, length), lambda w: w["lemma"]), " ").alias("lemma"),
                F.get(t, i - 1)["start"].alias("start"),
                F.get(t, i + (length - 2))["stop"].alias("stop"),
                F.lit(length).alias("length"),
            ),
        )
        return F.filter(made, lambda r: r["stop"].isNotNull())

    def of_words(t: Column, words: int, own: list[int]) -> Column:
        return let(heads(t, words), lambda at: F.concat(*[runs(t, at, n) for n in own]))

    parts = [(1, [n for n in lengths if n == 1]), (2, [n for n in lengths if n != 1])]
    return let(tokens, lambda t: F.concat(*[of_words(t, words, own) for words, own in parts if own]))


def _fold(text: str) -> str:
    lowered = text.lower()
    if len(lowered) != len(text):
        lowered = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    return lowered.replace("ё", "е")


def match_positions(original: str, cleaned: str) -> list[int]:
    """Greedy position in `original` of every character of `cleaned`.

    Each character takes the next equal (case- and ё-folded) one; once the
    text is used up, all remaining characters map to its last position.
    """
    folded = _fold(original)
    last = len(original) - 1
    at = 0
    found = []
    for char in cleaned:
        hit = folded.find(char, at) if at >= 0 else -1
        found.append(hit if hit >= 0 else last)
        at = hit + 1 if hit >= 0 else -1
    return found


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _positions(original: pd.Series, cleaned: pd.Series) -> pd.Series:
    return pd.Series(
        [
            None if o is None or c is None else match_positions(o, c)
            for o, c in zip(original, cleaned)
        ]
    )


def _blanked(col: Column, pattern: str) -> Column:
    """Every match replaced by as many spaces as it has characters."""
    spaces = F.transform(F.regexp_extract_all(col, F.lit(pattern), F.lit(0)), lambda m: F.repeat(F.lit(" "), F.length(m)))
    parts = F.zip_with(F.split(col, pattern, -1), spaces, lambda gap, blank: F.concat(gap, F.coalesce(blank, F.lit(""))))
    return F.array_join(parts, "")


def aligned_text(col: Column, alphabet: str = ALPHABET) -> Column:
    """The text, character by character, with a space for all that the full cleaning removes.

    Its letter runs are the tokens of `clear_text`, in the places they have in
    the original.  The one letter that is no single character in lower case,
    the dotted capital I, counts as removed.
    """
    folded = F.replace(F.lower(F.replace(col, F.lit("İ"), F.lit(" "))), F.lit("ё"), F.lit("е"))
    # Most texts have neither; looking for the letters that both begin with is far cheaper than a pattern.
    without = let(folded, lambda t: F.when(F.contains(t, F.lit("http")) | F.contains(t, F.lit("www.")), _blanked(t, URL)).otherwise(t))
    bare = let(without, lambda t: F.when(F.contains(t, F.lit("&")), _blanked(t, ENTITY)).otherwise(t))
    return F.regexp_replace(bare, f"[^{alphabet}]", " ")


def original_spans(col: Column) -> Column:
    """`array<struct<token, start_clean, end_clean>>` of the cleaned words, with their places in the original."""
    return let(aligned_text(col), token_spans)


# Bytes of text that spans are found in at a time.
SPAN_BYTES = 4_000_000


def _slices(texts: pa.Array) -> list[tuple[int, int]]:
    """Ranges of rows of about SPAN_BYTES each."""
    offsets = _offsets(texts)
    cuts = [0]
    while cuts[-1] < len(texts):
        upto = int(np.searchsorted(offsets, offsets[cuts[-1]] + SPAN_BYTES, side="right")) - 1
        cuts.append(max(cuts[-1] + 1, min(upto, len(texts))))
    return list(zip(cuts, cuts[1:]))


def _offsets(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]


def _spans(texts: pa.Array) -> pa.Array:
    """Runs between spaces with their places, by code points, and those that they have once joined by one space."""
    offsets = _offsets(texts).astype(np.int64)
    low, high = int(offsets[0]), int(offsets[-1])
    offsets -= low
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[low:high] if raw is not None else np.zeros(0, np.uint8)
    letter = data != 0x20
    before = np.empty(len(data) + 1, bool)
    before[0], before[1:] = False, letter
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    starts = np.flatnonzero(letter & (~before[:-1] | edge[:-1]))
    after = np.append(~letter[1:], True) | edge[1:]
    stops = np.flatnonzero(letter & after) + 1
    # Code points that begin before each byte.
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=points[1:])
    first = np.searchsorted(starts, offsets)
    row = np.repeat(np.arange(len(texts)), np.diff(first))
    begin = points[offsets[:-1]][row]
    start, stop = points[starts] - begin, points[stops] - begin
    words = pa.StringArray.from_buffers(
        len(starts), pa.py_buffer(np.append(0, np.cumsum(stops - starts)).astype(np.int32)), pa.py_buffer(data[letter])
    )
    length = np.append(0, np.cumsum(stop - start + 1))
    joined = length[:-1] - length[first[:-1]][row]
    places = [joined, joined + stop - start, start, stop]
    tokens = pa.StructArray.from_arrays([words, *[pa.array(p.astype(np.int32)) for p in places]], ["token", *_PLACES])
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), tokens, mask=texts.is_null())


_PLACES = ["start_clean", "end_clean", "start_orig", "end_orig"]
_SPAN = T.StructType([T.StructField("token", T.StringType()), *[T.StructField(name, T.IntegerType()) for name in _PLACES]])


@F.arrow_udf(T.ArrayType(_SPAN, False))
def _analyzed_spans(texts: pa.Array) -> pa.Array:
    texts = texts.cast(pa.string())
    parts = [_spans(texts.slice(low, high - low)) for low, high in _slices(texts)]
    return pa.concat_arrays(parts) if parts else _spans(texts)


def analyzed_spans(col: Column) -> Column:
    """`array<struct<token, start_clean, end_clean, start_orig, end_orig>>`: the cleaned words of a text, their places in the cleaned text and in the original.

    An Arrow batch function: the bytes of many texts are looked through at once, instead of one character after the other.
    """
    return _analyzed_spans(aligned_text(col))


def exact_map(spans: Column) -> Column:
    """Index in the original of every character of the cleaned text, from the spans in the original.

    The space before a word has the place of the character before it.
    """
    places = F.flatten(F.transform(spans, lambda s: F.sequence(s["start_orig"] - 1, s["end_orig"] - 1)))
    return F.slice(places, F.lit(2), F.size(places))


def greedy_map(original: Column, cleaned: Column | None = None) -> Column:
    """Index of every cleaned character in the original text, each the next equal letter.

    Not exact: a letter inside a removed URL or entity is as good as any, and
    a gap goes to the next space (`exact_map` has the right places).  A running position cannot be kept by the array functions without copying
    the array per step, so this is an Arrow batch function, linear per text.
    """
    return _positions(original, clear_text(original) if cleaned is None else cleaned)


def span_to_original(start: Column, end: Column, mapping: Column) -> Column:
    """Range in the cleaned text -> `struct<start_orig, end_orig>` in the original.

    No map, or a start beyond it: (-1, -1). An end beyond it: last entry + 2.
    """
    size = F.size(mapping)
    outside = mapping.isNull() | (size == 0) | (start >= size)
    start_orig = F.when(outside, F.lit(-1)).otherwise(F.get(mapping, start))
    end_orig = (
        F.when(outside, F.lit(-1))
        .when(end - 1 >= size, F.get(mapping, size - 1) + 2)
        .otherwise(F.get(mapping, end - 1) + 1)
    )
    return F.struct(start_orig.alias("start_orig"), end_orig.alias("end_orig"))


def slice_text(original: Column, start: Column, stop: Column) -> Column:
    """The characters of `original` in [start, stop)."""
    return F.substring(original, start + 1, stop - start)


def slices(original: Column, spans: Column, make: Callable[[Column, Column], Column]) -> Column:
    """`make(span, slice)` for every span with `start_orig` and `end_orig`; the text is cut into characters once."""

    def cut(chars: Column) -> Column:
        def one(span: Column) -> Column:
            length = span["end_orig"] - span["start_orig"]
            return make(span, F.array_join(F.slice(chars, span["start_orig"] + 1, length), ""))

        return F.transform(spans, one)

    return let(F.split(original, ""), cut)


def context_window(doc: Column, fragment: Column, around: int = 5) -> Column:
    """First occurrence of the fragment's words in `doc`, with `around` words on each side.

    Without a match the fragment itself is returned.
    """

    def window(doc_words: Column, frag_words: Column) -> Column:
        size = F.size(frag_words)
        starts = F.filter(
            F.sequence(F.lit(1), F.greatest(F.size(doc_words) - size + 1, F.lit(1))),
            lambda i: F.slice(doc_words, i, size) == frag_words,
        )
        return let(
            F.get(starts, F.lit(0)),
            lambda first: F.when(
                first.isNotNull(),
                F.array_join(
                    F.slice(
                        doc_words,
                        F.greatest(first - around, F.lit(1)),
                        F.least(first + size - 1 + around, F.size(doc_words))
                        - F.greatest(first - around, F.lit(1))
                        + 1,
                    ),
                    " ",
                ),
            ),
        )

    found = let(words(doc), lambda d: let(words(fragment), lambda f: window(d, f)))
    return F.coalesce(found, fragment)


def truncate_tokens(tokens: Column, limit: int = 30) -> Column:
    """The first `limit` elements of a token array."""
    return F.slice(tokens, 1, limit)

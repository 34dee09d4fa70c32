"""Text cleaning as Column -> Column expressions.

Java's `\\s` and `\\w` are ASCII-only, so the Unicode classes are written out;
with them the results equal those of a Unicode-aware regex engine.
All expressions are deterministic and stay in the JVM.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Unicode white space and word characters (contents of a class).
WS = (
    r"\s\x{000B}\x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WORD = r"\p{L}\p{N}_"

# The emoji and symbol blocks that are removed. The last range
# runs from the circled letters to the enclosed ideographs and so also takes
# CJK, Hangul and private-use characters.
EMOJI = (
    r"\x{1F600}-\x{1F64F}"
    r"\x{1F300}-\x{1F5FF}"
    r"\x{1F680}-\x{1F6FF}"
    r"\x{1F700}-\x{1F77F}"
    r"\x{1F780}-\x{1F7FF}"
    r"\x{1F800}-\x{1F8FF}"
    r"\x{1F900}-\x{1F9FF}"
    r"\x{1FA00}-\x{1FA6F}"
    r"\x{1FA70}-\x{1FAFF}"
    r"\x{2702}-\x{27B0}"
    r"\x{24C2}-\x{1F251}"
)

# Letters kept by the full cleaning: Latin a-z and Cyrillic а-я.
ALPHABET = "a-zа-я"

URL = rf"https?://[^{WS}]+|www\.[^{WS}]+"
ENTITY = r"&[a-z]+;"
MENTION = rf"@[{WORD}]+|/[{WORD}]+"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row.

    An expression used several times may be evaluated as often, and one that
    is captured by the lambda of an array function once per element; bound as
    a lambda argument it is evaluated once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def collapse(col: Column) -> Column:
    """Runs of white space become one space, ends are trimmed."""
    return F.trim(F.regexp_replace(col, f"[{WS}]+", " "))


def preprocess(
    col: Column,
    lowercase: bool = True,
    replace_yo: bool = True,
    remove_urls: bool = True,
    remove_emoji: bool = True,
    remove_html: bool = True,
    remove_punctuation: bool = True,
    remove_telegram: bool = True,
    alphabet: str = ALPHABET,
) -> Column:
    """The configurable cleaning chain; every removal leaves one space behind."""
    if lowercase:
        col = F.lower(col)
    if replace_yo:
        col = F.replace(col, F.lit("ё"), F.lit("е"))
    removals = [
        (remove_urls, URL),
        (remove_emoji, f"[{EMOJI}]+"),
        (remove_html, ENTITY),
        (remove_punctuation, f"[^{alphabet}{WS}]"),
        (remove_telegram, MENTION),
    ]
    for wanted, pattern in removals:
        if wanted:
            col = F.regexp_replace(col, pattern, " ")
    return collapse(col)


def clear_text(col: Column, alphabet: str = ALPHABET) -> Column:
    """Full cleaning: only letters of `alphabet` and single spaces remain.

    Equal to `preprocess` with every flag on.  Once URLs and entities are
    gone, whatever is not a letter ends up as a space, so one replacement of
    whole runs does the rest: emoji are no letters, mentions cannot occur
    without `@` and `/`, and the runs include the white space to collapse.
    """
    folded = F.replace(F.lower(col), F.lit("ё"), F.lit("е"))
    bare = F.regexp_replace(F.regexp_replace(folded, URL, " "), ENTITY, " ")
    return F.trim(F.regexp_replace(bare, f"[^{alphabet}]+", " "))


def clean_for_search(col: Column) -> Column:
    """Lower-case text without URLs, emoji and entities; punctuation stays."""
    return preprocess(col, remove_punctuation=False, remove_telegram=False)


def clean_for_embedding(col: Column) -> Column:
    """The embedding input is the fully cleaned text."""
    return clear_text(col)


def clean_for_display(col: Column) -> Column:
    """Light cleaning for people: entities and mentions go, the rest stays."""
    return preprocess(
        col,
        lowercase=False,
        replace_yo=False,
        remove_urls=False,
        remove_emoji=False,
        remove_punctuation=False,
    )


def clean_social(col: Column) -> Column:
    """Social-media cleaning: links, mentions and tags are cut, `.,!?` stay; null becomes ''."""
    cut = F.regexp_replace(
        F.coalesce(col, F.lit("")), rf"http[^{WS}]+|www[^{WS}]+|@[{WORD}]+|#[{WORD}]+", ""
    )
    return F.lower(F.trim(F.regexp_replace(cut, f"[^{WORD}.,!?]+", " ")))


def clean_simple(col: Column) -> Column:
    """Lower-case, punctuation deleted, white space collapsed but not trimmed."""
    return F.regexp_replace(
        F.regexp_replace(F.lower(col), f"[^{WORD}{WS}]", ""), f"[{WS}]+", " "
    )


def clean_words(col: Column) -> Column:
    """`clean_simple` with trimmed ends."""
    return F.trim(clean_simple(col))


def clean_underscore(col: Column) -> Column:
    """Lower-case; every run of non-alphanumeric characters becomes one space."""
    return F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]+", " ")


def clean_alnum(col: Column) -> Column:
    """Alphanumerics lower-cased, each white-space character a space, the rest dropped."""
    kept = F.regexp_replace(col, rf"[^\p{{L}}\p{{N}}{WS}]", "")
    return F.lower(F.regexp_replace(kept, f"[{WS}]", " "))


def processed_text(col: Column, max_chars: int | None = 500) -> Column:
    """Index form of a post: cleaned, and cut to `max_chars` (None keeps all).

    Missing, blank and literal "nan" texts give ''.
    """
    text = F.coalesce(col, F.lit(""))
    missing = F.rlike(text, F.lit(rf"(?i)\A[{WS}]*(nan)?[{WS}]*\z"))
    cleaned = clear_text(text)
    if max_chars is not None:
        cleaned = F.substring(cleaned, 1, max_chars)
    return F.when(missing, F.lit("")).otherwise(cleaned)


def collapse_ends(col: Column) -> Column:
    """Strip Unicode white space from both ends."""
    return F.regexp_replace(col, f"^[{WS}]+|[{WS}]+$", "")


def merge_fields(*cols: Column) -> Column:
    """Socially cleaned fields, the non-empty ones joined by a space."""
    return F.concat_ws(" ", *[F.nullif(clean_social(c), F.lit("")) for c in cols])


def clean_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """`clear_text` on each of `cols` the frame has; null stays null."""
    present = [c for c in cols if c in df.columns]
    return df.withColumns({c: clear_text(F.col(c)) for c in present})


def fill_nulls(df: DataFrame) -> DataFrame:
    """Null strings become ''."""
    return df.fillna("")

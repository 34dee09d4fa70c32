"""Corpus profiling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from textlode.functions.cleaning import clear_text, let
from textlode.functions.tokens import clean_words_of, word_counts, words
from textlode.operators.joins import top_per_group


def _two_decimals(x: Column) -> Column:
    """`x` >= 1 rounded to two decimals by its exact binary value, halves to even.

    The built-in rounding goes by the shortest decimal spelling and so takes
    5.025, whose binary value lies above the half, for a half.  Scaled by a
    power of two, the double becomes a whole number without loss.
    """

    def rounded(shift: Column) -> Column:
        scaled = (x * F.pow(F.lit(2.0), shift)).cast("long") * 100
        unit = F.pow(F.lit(2.0), shift).cast("long")
        whole = F.floor(scaled / unit)
        # The division above is inexact, so the remainder settles the last unit.
        whole = whole - F.when(whole * unit > scaled, 1).otherwise(0)
        rest = (scaled - whole * unit) * 2
        up = (rest > unit) | ((rest == unit) & (whole % 2 == 1))
        return (whole + F.when(up, 1).otherwise(0)) / 100

    return let((53 - F.floor(F.log2(x))).cast("int"), rounded)


def text_stats(df: DataFrame, col: str) -> DataFrame:
    """Adds length and word statistics of the cleaned text; null or '' gives zeros."""
    clean = df.withColumn("_clean", clear_text(F.coalesce(F.col(col), F.lit(""))))
    split = clean.withColumn("_words", clean_words_of(F.col("_clean")))
    sizes = split.withColumn("_sizes", F.transform("_words", F.length))
    n_words = F.size("_words")
    chars = F.aggregate("_sizes", F.lit(0), lambda acc, n: acc + n)
    average = F.when(n_words > 0, _two_decimals(chars / n_words)).otherwise(F.lit(0.0))
    return sizes.withColumns(
        {
            "length": F.length("_clean"),
            "word_count": n_words,
            "unique_word_count": F.size(F.array_distinct("_words")),
            "avg_word_length": average,
            "short_words_count": F.size(F.filter("_sizes", lambda n: n < 4)),
            "long_words_count": F.size(F.filter("_sizes", lambda n: n > 7)),
        }
    ).drop("_clean", "_words", "_sizes")


def word_frequencies(df: DataFrame, col: str, *keys: str) -> DataFrame:
    """`(keys.., word, n)`: occurrences of each cleaned word per row; counted inside the row."""
    counts = df.select(*keys, word_counts(clean_words_of(clear_text(F.col(col)))).alias("counts"))
    # Without the outer form a filter for non-empty lists would count once more.
    rows = counts.select(*keys, F.explode_outer("counts").alias("c")).filter(F.col("c").isNotNull())
    return rows.select(*keys, "c.word", F.col("c.n").cast("long").alias("n"))


def word_frequency_maps(df: DataFrame, col: str, *keys: str) -> DataFrame:
    """The same as one map per row."""
    counts = word_counts(clean_words_of(clear_text(F.col(col))))
    return df.select(*keys, F.map_from_entries(counts).alias("word_frequencies"))


def top_words(df: DataFrame, cols: list[str], n: int = 10) -> DataFrame:
    """The `n` most frequent white-space words of each column, as `(column, word, n, rank)`."""
    named = F.array(
        *[F.struct(F.lit(c).alias("column"), F.col(c).alias("text")) for c in cols]
    )
    counts = (
        df.select(F.inline(named))
        .select("column", F.explode(words(F.col("text"))).alias("word"))
        .groupBy("column", "word")
        .agg(F.count("*").alias("n"))
    )
    return top_per_group(counts, ["column"], [F.desc("n"), F.asc("word")], n)


def null_counts(df: DataFrame) -> DataFrame:
    """One row with the number of nulls of each column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def duplicate_row_count(df: DataFrame) -> DataFrame:
    """Number of rows that equal an earlier row; groups by a 32-byte key of the whole row."""
    row = F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})
    groups = df.groupBy(F.unhex(F.sha2(row, 256)).alias("key")).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def unique_values(df: DataFrame, col: str, order_col: str, n: int = 10) -> DataFrame:
    """The first `n` distinct values in row order, with the row they first occur in."""
    firsts = df.groupBy(F.col(col).alias("value")).agg(F.min(order_col).alias("first_at"))
    return firsts.orderBy("first_at").limit(n)


def length_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum of the text lengths.

    Lengths are first counted per value, so the exact quartiles are taken
    from the few distinct lengths and not from all rows.
    """
    named = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.length(F.coalesce(F.col(c), F.lit(""))).alias("len"))
            for c in cols
        ]
    )
    counts = df.select(F.inline(named)).groupBy("column", "len").agg(F.count("*").alias("n"))
    n, size = F.col("n"), F.col("len").cast("double")
    total = F.sum(n)
    mean = F.sum(size * n) / total
    squares = F.sum(size * size * n)
    spread = F.sqrt(F.greatest(squares - total * mean * mean, F.lit(0.0)) / (total - 1))
    return counts.groupBy("column").agg(
        total.alias("count"),
        mean.alias("mean"),
        F.when(total > 1, spread).alias("std"),
        F.min("len").alias("min"),
        F.percentile("len", F.lit(0.25), n).alias("p25"),
        F.percentile("len", F.lit(0.5), n).alias("p50"),
        F.percentile("len", F.lit(0.75), n).alias("p75"),
        F.max("len").alias("max"),
    )


def dataset_stats(df: DataFrame) -> DataFrame:
    """One row per column: its position, name, type, non-null count and the row count."""
    counts = df.agg(
        F.count("*").alias("n_rows"),
        *[F.count(F.col(name)).alias(f"c{i}") for i, name in enumerate(df.columns)],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(name).alias("column"),
                F.lit(kind).alias("dtype"),
                F.col(f"c{i}").alias("non_null"),
                F.col("n_rows"),
            )
            for i, (name, kind) in enumerate(df.dtypes)
        ]
    )
    return counts.select(F.inline(rows))


def head_rows(df: DataFrame, order_col: str, n: int = 5) -> DataFrame:
    return df.orderBy(order_col).limit(n)


def sample_rows(df: DataFrame, n: int = 1, seed: int | None = None) -> DataFrame:
    """`n` random rows: every task keeps its `n` smallest random numbers, no full sort."""
    return df.orderBy(F.rand(seed)).limit(n)


# The sentiment word lists and labels.
POSITIVE = ["хороший", "прекрасный", "люблю", "счастлив", "красивый"]
NEGATIVE = ["плохой", "ужасный", "ненавижу", "грустный", "разочарован"]
SENTIMENT_LABELS = ("Положительный", "Отрицательный", "Нейтральный")


def sentiment(
    col: Column,
    positive: list[str] = POSITIVE,
    negative: list[str] = NEGATIVE,
    labels: tuple[str, str, str] = SENTIMENT_LABELS,
) -> Column:
    """Positive, negative or neutral label by how many listed words occur in the text.

    A word counts once however often it occurs, also inside other words.
    """
    text = F.lower(F.coalesce(col, F.lit("")))

    def hits(lexicon: list[str]) -> Column:
        total = F.lit(0)
        for word in lexicon:
            total = total + F.contains(text, F.lit(word)).cast("int")
        return total

    lead = hits(positive) - hits(negative)
    for_positive, for_negative, for_neutral = (F.lit(label) for label in labels)
    return F.when(lead > 0, for_positive).when(lead < 0, for_negative).otherwise(for_neutral)


def _counters(status: Column) -> list[Column]:
    return [
        F.count_if(status == "stored").alias("success"),
        F.count_if(status == "duplicate").alias("duplicates"),
        F.count_if(status == "skipped").alias("skipped"),
        F.count_if(status == "error").alias("errors"),
    ]


def ingest_summary(statuses: DataFrame, status_col: str = "status") -> DataFrame:
    """Counters of an ingest: one row with success, duplicates, skipped and errors."""
    return statuses.agg(*_counters(F.col(status_col)))


def write_with_summary(statuses: DataFrame, path: str, status_col: str = "status") -> dict[str, int]:
    """Writes the rows as Parquet and returns the counters of `ingest_summary`, which the write itself observes: no second job."""
    seen = Observation()
    statuses.observe(seen, *_counters(F.col(status_col))).write.parquet(path)
    return {name: int(n) for name, n in seen.get.items()}

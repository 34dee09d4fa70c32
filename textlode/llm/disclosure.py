"""Information-theoretic sanitisation of personal data.

Fixed patterns find the protected entities.  The words around an entity that
recurs in different contexts are weighed by what they reveal about it:
pointwise mutual information of word and entity over the corpus, against the
information content of the entity.  Words above the threshold are disclosing
and are generalised with the entity.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textlode.llm.common import fits, spread_join
from textlode.operators.joins import quoted, unused
from textlode.sources.store import settle

KINDS = ("email", "ip", "card", "phone", "term")
TERM = len(KINDS) - 1

# The base patterns.  A match may start where the last one ended (\G) or where no character of its first class
# precedes, and runs are never given back: the same leftmost matches, in time linear in the text.
PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
WORD = r"\p{L}{3,}"

# Code points on each side of an entity in which words count as its context.
REACH = 40
# Contexts of an entity, and contexts of it with a word, that an estimate needs at least.
SUPPORT = 2
# Share of the entity's information that a word may reveal.
RATIO = 0.5


def _luhn(digits: Column) -> Column:
    def add(total, i):
        digit = F.substr(digits, -i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _small_part(part: Column) -> Column:
    number = F.ltrim(part, F.lit("0"))
    return (F.length(number) <= 3) & (F.coalesce(F.try_to_number(number, F.lit("999")), F.lit(0)) <= 255)


def _valid(kind: Column, value: Column) -> Column:
    """Whether a match of a base pattern is an entity."""
    digits = F.translate(value, "+ ().-", "")
    long = F.length(digits)
    return (
        F.when(kind == 0, True)
        .when(kind == 1, F.forall(F.split(value, r"\."), _small_part))
        .when(kind == 2, F.when(long.between(14, 19), _luhn(digits)).otherwise(False))
        .otherwise(long.between(10, 15))
    )


def _matches(kind: int, hits: Column, gaps: Column) -> Column:
    """Per match its value, the characters since the last one, and the text around it."""

    def one(hit, i):
        before, after = F.element_at(gaps, i + 1), F.element_at(gaps, i + 2)
        return F.struct(
            F.lit(kind).alias("kind"),
            i.alias("nth"),
            hit.alias("value"),
            F.length(before).alias("gap"),
            F.right(before, F.lit(REACH)).alias("left"),
            F.left(after, F.lit(REACH)).alias("right"),
        )

    return F.transform(hits, one)


def _found(rows: DataFrame) -> DataFrame:
    """`(rid, doc_id, matches)`: one scan of the texts, every match of the base patterns with its context."""
    text = F.col("text")
    guards = (F.contains(text, F.lit("@")), F.lit(True), F.lit(True), F.contains(text, F.lit("+")))
    none = F.array().cast("array<string>")
    hits = rows.select(
        "*",
        *[
            F.when(guard, F.regexp_extract_all("text", F.lit(p), F.lit(0))).otherwise(none).alias(f"hits{k}")
            for k, (p, guard) in enumerate(zip(PATTERNS, guards, strict=True))
        ],
    )
    cut = hits.select(
        "*",
        *[
            F.when(F.size(f"hits{k}") > 0, F.split("text", p, -1)).otherwise(none).alias(f"gaps{k}")
            for k, p in enumerate(PATTERNS)
        ],
    )
    parts = [_matches(k, F.col(f"hits{k}"), F.col(f"gaps{k}")) for k in range(len(PATTERNS))]
    return cut.select("rid", "doc_id", F.concat(*parts).alias("matches"))


def _entities(found: DataFrame) -> DataFrame:
    """`(rid, kind, start, end, entity, left, right)` for every valid match."""
    order = Window.partitionBy("rid", "kind").orderBy("nth")
    hits = found.select("rid", F.inline("matches"))
    size = F.length("value")
    placed = hits.withColumn("end", F.sum(F.col("gap") + size).over(order)).withColumn("start", F.col("end") - size)
    name = F.when(F.col("kind") == 0, F.translate("value", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    name = name.when(F.col("kind") == 1, F.col("value")).otherwise(F.translate("value", "+ ().-", ""))
    return placed.filter(_valid(F.col("kind"), F.col("value"))).select(
        "rid", "kind", "start", "end", F.concat(F.col("kind"), F.lit(":"), name).alias("entity"), "left", "right"
    )


def _words(context: Column) -> Column:
    """`(word, at)` for the words of a short string."""
    words, gaps = F.regexp_extract_all(context, F.lit(WORD), F.lit(0)), F.split(context, WORD, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<word:string,at:int>>").alias("out"))

    def step(acc, pair):
        at = acc["at"] + F.length(pair["gap"])
        seen = F.array(F.struct(pair["word"].alias("word"), at.alias("at")))
        return F.struct((at + F.length(pair["word"])).alias("at"), F.concat(acc["out"], seen).alias("out"))

    pairs = F.zip_with(
        F.slice(gaps, F.lit(1), F.size(words)), words, lambda g, w: F.struct(g.alias("gap"), w.alias("word"))
    )
    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def _contexts(entities: DataFrame) -> DataFrame:
    """`(rid, entity, context, term, start, end)` for every whole word near an entity."""
    uncut_left = lambda w: (F.length("left") < REACH) | (w["at"] > 0)
    uncut_right = lambda w: (F.length("right") < REACH) | (w["at"] + F.length(w["word"]) < REACH)
    shifted = lambda base: lambda w: F.struct(F.lower(w["word"]).alias("term"), (base + w["at"]).alias("start"))
    left = F.transform(F.filter(F.col("l"), uncut_left), shifted(F.col("start") - F.length("left")))
    right = F.transform(F.filter(F.col("r"), uncut_right), shifted(F.col("end")))
    return (
        entities.withColumn("l", _words(F.col("left")))
        .withColumn("r", _words(F.col("right")))
        .select("rid", "entity", F.xxhash64("left", "right").alias("context"), F.concat(left, right).alias("near"))
        .select("rid", "entity", "context", F.inline("near"))
        .withColumn("end", F.col("start") + F.length("term"))
    )


def document_frequencies(texts: DataFrame) -> DataFrame:
    """`(term, df)`: number of texts that hold the lower-cased word; over all texts, whole."""
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(0)))
    return texts.select(F.explode(words).alias("term")).groupBy("term").agg(F.count("*").alias("df"))


def disclosing_terms(entities: DataFrame, frequencies: DataFrame, documents: int, ratio: float, support: int) -> DataFrame:
    """`(entity, term, pmi, information)` for words that reveal at least `ratio` of an entity's information.

    PMI is ln(n(e,t) N / (n(e) df(t))), the information content of the entity ln(N / n(e)).  All four numbers count documents,
    so copying all documents, or those of an entity, changes no ratio.  An entity, and an entity with a word, needs `support`
    different contexts (copies of a context once).
    """
    met = entities.select("rid", "entity", "left", "right").distinct()
    context = F.xxhash64("left", "right")
    counted = met.groupBy("entity").agg(F.countDistinct("rid").alias("n_e"), F.countDistinct(context).alias("contexts"))
    counted = settle(counted.filter(F.col("contexts") >= support).select("entity", "n_e"))
    recurring = spread_join(met, counted.select("entity"), "entity", "left_semi", fits(counted, F.octet_length("entity")))
    near = _contexts(recurring.selectExpr("rid", "entity", "0 start", "0 end", "left", "right"))
    together = (
        near.groupBy("entity", "term")
        .agg(F.countDistinct("rid").alias("n_et"), F.countDistinct("context").alias("contexts"))
        .filter(F.col("contexts") >= support)
    )
    n = F.lit(float(max(documents, 1)))
    return (
        together.join(counted, "entity")
        .join(frequencies, "term")
        .withColumn("pmi", F.log(F.col("n_et") * n / (F.col("n_e") * F.col("df"))))
        .withColumn("information", F.log(n / F.col("n_e")))
        .filter((F.col("pmi") > 0) & (F.col("pmi") >= F.col("information") * ratio))
        .select("entity", "term", "pmi", "information")
    )


def _spans(rows: DataFrame, ratio: float, support: int) -> DataFrame:
    """`(rid, doc_id, spans)` from `rows(rid, doc_id, text)` with settled rids."""
    found = settle(_found(rows))
    entities = settle(_entities(found))
    terms = disclosing_terms(entities, document_frequencies(rows), found.count(), ratio, support)
    key = F.concat_ws("\n", "entity", "term")
    terms = settle(terms.select(key.alias("key")))
    named = terms.select(F.substring_index("key", "\n", 1).alias("entity")).distinct()
    some = spread_join(entities, named, "entity", "left_semi", fits(named, F.octet_length("entity")))
    near = _contexts(some).select("rid", "start", "end", key.alias("key"))
    extra = spread_join(near, terms, "key", "left_semi", fits(terms, F.octet_length("key")))
    spans = entities.select("rid", "start", "kind", "end").unionByName(
        extra.select("rid", "start", F.lit(TERM).alias("kind"), "end").distinct()
    )
    # Named as the result's own, so that no column of the input can clash.
    span = F.struct(F.col("start").cast("int").alias("start"), F.col("kind"), F.col("end").cast("int").alias("end"))
    by_row = spans.groupBy("rid").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    return (
        found.select("rid", "doc_id")
        .join(by_row, "rid", "left")
        .select("rid", "doc_id", F.coalesce("spans", none).alias("spans"))
    )


def find_disclosures(
    docs: DataFrame, ratio: float = RATIO, support: int = SUPPORT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """`(doc_id, spans)`, one row per row of `docs`; a span is `(start, kind, end)`, ascending.

    Kinds are numbers into `KINDS`; positions are code points, the end is
    exclusive.  Spans of the base patterns are always there; kind `term` holds
    the words that disclose an entity.  Null and empty texts have no spans,
    null and repeated ids are kept, no rows give no rows.
    """
    rows = docs.select(
        F.monotonically_increasing_id().alias("rid"),
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    return _spans(rows, ratio, support).drop("rid")


def generalised(text: Column, spans: Column) -> Column:
    """The text with every span replaced by `[kind]`; overlapping spans become one, named by the first."""
    names = F.array(*map(F.lit, KINDS))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, s):
        begun = s["start"] >= acc["at"]
        kept = F.substr(text, acc["at"] + 1, s["start"] - acc["at"])
        tag = F.concat(kept, F.lit("["), F.element_at(names, s["kind"] + 1), F.lit("]"))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(begun, F.concat(acc["out"], tag)).otherwise(acc["out"]).alias("out"),
        )

    rest = lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text)))
    return F.aggregate(spans, start, step, rest)


def sanitise(docs: DataFrame, ratio: float = RATIO, support: int = SUPPORT, text_col: str = "text") -> DataFrame:
    """`docs` with every disclosure generalised; all columns and rows stay, a null text stays null."""
    row, found = unused("_row", *docs.columns), unused("_spans", *docs.columns)
    kept = settle(docs.withColumn(row, F.monotonically_increasing_id()))
    text = quoted(text_col)
    rows = kept.select(F.col(row).alias("rid"), F.col(row).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    spans = _spans(rows, ratio, support).filter(F.size("spans") > 0).select(F.col("rid").alias(row), F.col("spans").alias(found))
    new = F.when(F.col(found).isNull(), text).otherwise(generalised(text, F.col(found)))
    return kept.join(spans, row, "left").withColumn(text_col, new).select(*map(quoted, docs.columns))


def digest(found: DataFrame) -> DataFrame:
    """Counts, digest and spelling of the spans of `find_disclosures`."""
    names = F.array(*map(F.lit, KINDS))
    spelled = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])
    joined = lambda spans: F.array_join(F.transform(spans, spelled), ",")
    spans = F.col("spans")

    def count(kind: int) -> Column:
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}")

    counts = [count(kind) for kind in range(TERM)]
    base = joined(F.filter(spans, lambda s: s["kind"] < TERM))
    return found.select("doc_id", *counts, F.sha2(base, 256).alias("base_sha256"), joined(spans).alias("spans"))

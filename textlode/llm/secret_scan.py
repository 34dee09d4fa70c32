"""Secret scan through a trigram inverted index.

Every task indexes its texts batch by batch: postings of just the trigrams that
the rules' Boolean queries name.  A rule is verified on the texts its query
leaves; a rule without mandatory trigrams is verified on all.  Nothing is
shuffled, and a task holds one batch.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textlode.llm.common import small_batches
from textlode.llm.trigrams import candidates, postings, text_buffer, trigram_query, trigrams_of
from textlode.operators.joins import numbered


class Rule(NamedTuple):
    """A match counts when group `group` has at least `least` characters."""

    kind: str
    pattern: str
    flags: int = re.ASCII
    group: int = 0
    least: int = 0


# The base kinds, then well-known credential formats.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.ASCII | re.IGNORECASE,
        2,
        6,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]+", least=24),
)
MORE = (
    Rule("github", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
)


def _quick(rule: Rule) -> re.Pattern:
    """The rule's expression; a run of one class is only tried where it is long enough."""
    if rule.kind == "hex":
        return re.compile(rf"[0-9a-f]{{{rule.least},}}", rule.flags)
    return re.compile(rule.pattern, rule.flags)


def find_spans(texts, rules: tuple[Rule, ...]) -> list[list[tuple[int, int, int]]]:
    """For each text of an Arrow column its (start, rule number, end), ascending."""
    buffer, starts = text_buffer(texts)
    queries = [trigram_query(r.pattern, r.flags) for r in rules]
    lists = postings(buffer, starts, sorted(set().union(*map(trigrams_of, queries))))
    found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
    values: dict[int, str] = {}
    for number, (rule, query) in enumerate(zip(rules, queries, strict=True)):
        pattern = _quick(rule)
        for i in candidates(query, lists, len(texts)).tolist():
            if (text := values.get(i)) is None:
                text = values[i] = texts[i].as_py()
            for m in pattern.finditer(text):
                if m.end(rule.group) - m.start(rule.group) >= rule.least:
                    found[i].append((m.start(), number, m.end()))
    for spans in found:
        spans.sort()
    return found


def scan_secrets(
    docs: DataFrame,
    rules: tuple[Rule, ...] = BASE + MORE,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """`(doc_id, n_assign, n_access, n_hex, base_sha256, spans)`, one row per row of `docs`.

    Spans are `kind:start:end` in code points, end exclusive, by start and then
    by the kinds' order, joined by commas; `base_sha256` digests those of the
    three base kinds.  Null and empty texts have no spans; null ids are kept.
    """
    import pyarrow as pa

    small_batches(docs.sparkSession)
    base = len(BASE)
    kinds = [r.kind for r in rules]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = {"doc_id": batch.column(0), **{f"n_{r.kind}": [] for r in rules[:base]}, "base_sha256": [], "spans": []}
            for spans in find_spans(batch.column(1), rules):
                words = [(n, f"{kinds[n]}:{start}:{end}") for start, n, end in spans]
                for n in range(base):
                    rows[f"n_{kinds[n]}"].append(sum(k == n for k, _ in words))
                own = ",".join(w for k, w in words if k < base)
                rows["base_sha256"].append(hashlib.sha256(own.encode()).hexdigest())
                rows["spans"].append(",".join(w for _, w in words))
            counts = [pa.array(rows[f"n_{k}"], pa.int64()) for k in kinds[:base]]
            texts = [pa.array(rows[k], pa.string()) for k in ("base_sha256", "spans")]
            yield pa.RecordBatch.from_arrays([rows["doc_id"], *counts, *texts], [*rows])

    taken = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(text_col, F.lit("")).alias("text"))
    return taken.mapInArrow(
        run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, text_col: str = "text") -> DataFrame:
    """`docs` with every secret replaced by `[kind]`; of overlapping spans the first, and of these the longest, names it.

    All columns stay; a null text stays null.  `n_chars`, where there is one, follows the new text.
    """
    import pyarrow as pa

    small_batches(docs.sparkSession)
    kinds = [r.kind for r in rules]
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts = batch.column(at)
            new = texts.to_pylist()
            for i, spans in enumerate(find_spans(texts.fill_null(""), rules)):
                if not spans:
                    continue
                out, done = [], 0
                for start, number, end in merged(spans):
                    out += [new[i][done:start], f"[{kinds[number]}]"]
                    done = end
                new[i] = "".join(out) + new[i][done:]
            yield batch.set_column(at, batch.schema.field(at), pa.array(new, texts.type))

    plain = numbered(docs)
    clean = plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
    if "n_chars" in docs.columns and text_col == "text":
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.char_length("text").cast(kind))
    return clean


def merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Overlapping spans made one, under the kind that starts first."""
    out: list[tuple[int, int, int]] = []
    for start, number, end in spans:
        if out and start < out[-1][2]:
            out[-1] = (*out[-1][:2], max(end, out[-1][2]))
        else:
            out.append((start, number, end))
    return out

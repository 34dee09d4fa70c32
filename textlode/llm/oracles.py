"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from textlode.llm.url_reputation import SUFFIXES

ORACLES: dict[str, str] = {}

# Host reputation: rules first, then the lower bound of the host's posterior, as in url_reputation.py.
def _level(more: int) -> str:
    """The longest listed suffix of `name`, or its last label, and `more` labels before; an address is its own."""

    def last(labels: int) -> str:
        return f"array_to_string((string_split(name, '.'))[-{labels}:], '.')"

    found = last(1 + more)
    for labels in sorted({s.count(".") + 1 for s in SUFFIXES}):
        own = ", ".join(f"'{s}'" for s in SUFFIXES if s.count(".") + 1 == labels)
        found = f"CASE WHEN {last(labels)} IN ({own}) THEN {last(labels + more)} ELSE {found} END"
    return f"CASE WHEN regexp_matches(name, '^[0-9]+(\\.[0-9]+){{3}}$|^\\[|:') THEN name ELSE {found} END"


def _strength(children: str) -> str:
    """One row `(strength)` from `children(n, bad)` by the method of moments."""
    return f"""
    SELECT CASE WHEN coalesce(n, 0) = 0 OR k < 2 OR between_ <= 1e-12 THEN 10000.0
                ELSE least(10000.0, greatest(1.0, chance / between_ - 1)) END AS strength
    FROM (
        SELECT n, k, chance,
               (mm / n - mean * mean - chance * (k - 1) / n) / greatest(1e-9, 1 - nn / (n * n)) AS between_
        FROM (
            SELECT *, m / n AS mean, (m / n) * (1 - m / n) AS chance
            FROM (
                SELECT sum(n)::DOUBLE AS n, sum(n * n)::DOUBLE AS nn, count(*) AS k,
                       sum(bad)::DOUBLE AS m, sum(bad * bad / n::DOUBLE) AS mm
                FROM {children} WHERE n > 0
            )
        )
    )"""


ORACLES["op2_host_reputation"] = rf"""
WITH rests AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
parts AS (
    SELECT page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rests
),
outcomes AS (
    SELECT doc_id AS page_id, count(*) AS n,
           sum(CASE WHEN coalesce(toxic = 1, false) OR coalesce(quality = 0, false) THEN 1 ELSE 0 END) AS bad
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
),
counted AS (
    SELECT host, coalesce(sum(n), 0) AS n, coalesce(sum(bad), 0) AS bad
    FROM parts LEFT JOIN outcomes USING (page_id) GROUP BY host
),
hosts AS (
    SELECT *, regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '\.$', '') AS name FROM counted
),
named AS (SELECT host, n, bad, {_level(0)} AS suffix, {_level(1)} AS domain FROM hosts),
domains AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM named GROUP BY suffix, domain),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
base AS (SELECT (coalesce(sum(bad), 0) + 1.0) / (coalesce(sum(n), 0) + 2.0) AS rate FROM suffixes),
by_suffix AS ({_strength("suffixes")}),
by_domain AS ({_strength("domains")}),
by_host AS ({_strength("named")}),
suffix_rates AS (
    SELECT suffix, (bad + rate * strength) / (n + strength) AS suffix_rate FROM suffixes, base, by_suffix
),
domain_rates AS (
    SELECT domain, (bad + suffix_rate * strength) / (n + strength) AS domain_rate
    FROM domains JOIN suffix_rates USING (suffix), by_domain
),
posterior AS (
    SELECT host, bad + domain_rate * strength AS a, n - bad + (1 - domain_rate) * strength AS b
    FROM named JOIN domain_rates USING (domain), by_host
),
blocked AS (
    SELECT host FROM posterior
    WHERE a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5
),
ruled AS (
    SELECT *, CASE
        WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
        WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
    FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
            WHEN rule IS NOT NULL THEN 'block'
            WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""

# Sets of four-word shingles, all pairs that share one, links, and the smallest id that links reach.
ORACLES["op7_partenum"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
    FROM words
),
features AS (SELECT doc_id, len(s) AS n, unnest(s) AS f FROM sets),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common, any_value(a.n) + any_value(b.n) - count(*) AS total
    FROM features a JOIN features b USING (f) WHERE a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id
),
links AS (SELECT x, y FROM pairs WHERE 100 * common >= 85 * total),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM sets
    UNION
    SELECT r.doc_id, b.y FROM reach r JOIN both_ways b ON b.x = r.other
)
SELECT doc_id, any_value(len(s))::BIGINT AS n_shingles, min(other) AS component_id
FROM sets JOIN reach USING (doc_id) GROUP BY doc_id
"""

# Secrets: the rules as (kind, expression, group that is measured, characters it needs), in the kinds' order.
_SECRETS = [
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 20),
    ("hex", r"[0-9a-f]+", 0, 24),
    ("github", r"gh[opsru]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("google", r"AIza[A-Za-z0-9_-]{35}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("private", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 0),
]


def _matches(order: int, kind: str, pattern: str, group: int, least: int) -> str:
    """Matches of one rule: what stands between them and the matches themselves add up to the places."""
    return f"""
    SELECT doc_id, {order} AS kind, '{kind}' AS name, (upto - length(hit))::BIGINT AS start, upto::BIGINT AS stop
    FROM (
        SELECT doc_id, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY nth) AS upto
        FROM (
            SELECT doc_id, unnest(range(len(hits))) AS nth, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap
            FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') AS hits,
                         regexp_split_to_array(coalesce(text, ''), '{pattern}') AS gaps FROM documents)
        )
    )
    WHERE length(regexp_extract(hit, '{pattern}', {group})) >= {least}"""


_BASE = "FILTER (WHERE kind < 3)"
ORACLES["op9_trigram_secrets"] = f"""
WITH found AS ({' UNION ALL '.join(_matches(n, *rule) for n, rule in enumerate(_SECRETS))}),
spelled AS (SELECT *, name || ':' || start || ':' || stop AS span FROM found),
lists AS (
    SELECT doc_id, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access,
           count(*) FILTER (WHERE kind = 2) AS n_hex,
           coalesce(string_agg(span, ',' ORDER BY start, kind) {_BASE}, '') AS base,
           string_agg(span, ',' ORDER BY start, kind) AS spans
    FROM spelled GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN lists USING (doc_id)
"""

# Personal data: the base kinds in their order, and the words that tell of an entity.
_PERSONAL = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def _personal(kind: int, pattern: str) -> str:
    return f"""
    SELECT doc_id, {kind} AS kind, nth, hit, gap, after,
           sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id ORDER BY nth) AS stop
    FROM (
        SELECT doc_id, unnest(range(len(hits))) AS nth, unnest(hits) AS hit, unnest(gaps[:len(hits)]) AS gap, unnest(gaps[2:]) AS after
        FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{pattern}') AS hits,
                     regexp_split_to_array(coalesce(text, ''), '{pattern}') AS gaps FROM documents)
        WHERE len(hits) > 0
    )"""


_LETTERS = r"[\p{L}]{3,}"


def _near(side: str, base: str, whole: str) -> str:
    """Words of one side of every entity with their places in the text."""
    return f"""
    SELECT doc_id, entity, l, r, lower(word) AS term, ({base} + upto - length(word))::BIGINT AS start, ({base} + upto)::BIGINT AS stop
    FROM (
        SELECT *, sum(length(gap) + length(word)) OVER (PARTITION BY doc_id, kind, nth ORDER BY place) AS upto
        FROM (
            SELECT doc_id, kind, nth, entity, l, r, start, stop, unnest(range(len(w))) AS place, unnest(w) AS word, unnest(g[:len(w)]) AS gap
            FROM (SELECT *, regexp_extract_all({side}, '{_LETTERS}') AS w, regexp_split_to_array({side}, '{_LETTERS}') AS g FROM entities)
        )
    )
    WHERE length({side}) < 40 OR {whole}"""


ORACLES["op4_disclosure"] = f"""
WITH hits AS ({' UNION ALL '.join(_personal(k, p) for k, p in enumerate(_PERSONAL))}),
numbered AS (SELECT *, regexp_replace(hit, '[^0-9]', '', 'g') AS digits FROM hits),
valid AS (
    SELECT * FROM numbered WHERE CASE kind
        WHEN 0 THEN true
        WHEN 1 THEN list_bool_and(list_transform(string_split(hit, '.'),
            lambda p: length(ltrim(p, '0')) <= 3 AND coalesce(try_cast(ltrim(p, '0') AS INTEGER), 0) <= 255))
        WHEN 2 THEN length(digits) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, length(digits) + 1), lambda i:
            CASE WHEN i % 2 = 1 THEN substr(digits, length(digits) - i + 1, 1)::INTEGER
                 ELSE 2 * substr(digits, length(digits) - i + 1, 1)::INTEGER
                      - CASE WHEN substr(digits, length(digits) - i + 1, 1) > '4' THEN 9 ELSE 0 END END)) % 10 = 0
        ELSE length(digits) BETWEEN 10 AND 15 END
),
entities AS (
    SELECT doc_id, kind, nth, (stop - length(hit))::BIGINT AS start, stop::BIGINT AS stop, right(gap, 40) AS l, left(after, 40) AS r,
           kind || ':' || CASE kind WHEN 0 THEN translate(hit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                               WHEN 1 THEN hit ELSE digits END AS entity
    FROM valid
),
near AS ({_near('l', 'start - length(l)', 'upto - length(word) > 0')}
    UNION ALL {_near('r', 'stop', 'upto < 40')}),
recurring AS (
    SELECT entity, count(DISTINCT doc_id) AS n_e FROM entities GROUP BY entity HAVING count(DISTINCT (l, r)) >= 2
),
together AS (
    SELECT entity, term, count(DISTINCT doc_id) AS n_et FROM near GROUP BY entity, term HAVING count(DISTINCT (l, r)) >= 2
),
frequencies AS (
    SELECT term, count(*) AS df
    FROM (SELECT unnest(list_distinct(regexp_extract_all(lower(coalesce(text, '')), '{_LETTERS}'))) AS term FROM documents) GROUP BY term
),
size AS (SELECT count(*)::DOUBLE AS n FROM documents),
telling AS (
    SELECT entity, term FROM (
        SELECT entity, term, ln(n_et * n / (n_e * df)) AS pmi, ln(n / n_e) AS information
        FROM together JOIN recurring USING (entity) JOIN frequencies USING (term), size
    ) WHERE pmi > 0 AND pmi >= information * 0.5
),
spans AS (
    SELECT doc_id, start, kind, stop FROM entities
    UNION ALL SELECT DISTINCT doc_id, start, 4, stop FROM near SEMI JOIN telling USING (entity, term)
),
spelled AS (SELECT *, (['email', 'ip', 'card', 'phone', 'term'])[kind + 1] || ':' || start || ':' || stop AS span FROM spans),
lists AS (
    SELECT doc_id, {', '.join(f'count(*) FILTER (WHERE kind = {k}) AS n_{n}' for k, n in enumerate(('email', 'ip', 'card', 'phone')))},
           string_agg(span, ',' ORDER BY start, kind, stop) FILTER (WHERE kind < 4) AS base,
           string_agg(span, ',' ORDER BY start, kind, stop) AS spans
    FROM spelled GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card,
       coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents d LEFT JOIN lists USING (doc_id)
"""

# Ranked lexical search: terms of all documents, weights, scores, ten per item, as in mask_search.py.
_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

ORACLES["op12_presence_masks"] = f"""
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS terms FROM documents WHERE text IS NOT NULL),
sizes AS (SELECT r, doc_id, len(terms)::BIGINT AS n FROM texts WHERE len(terms) > 0),
whole AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
items AS (SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL)),
asked AS (SELECT item_id, term, count(*)::BIGINT AS repeats FROM items GROUP BY item_id, term),
spelt AS (SELECT r, unnest(terms) AS term FROM texts),
counts AS (
    SELECT r, term, count(*)::BIGINT AS tf FROM spelt WHERE term IN (SELECT term FROM asked) GROUP BY r, term
),
weights AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
    FROM counts, whole GROUP BY term
),
parts AS (
    SELECT r, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_terms))) AS part
    FROM counts JOIN weights USING (term) JOIN sizes USING (r), whole
),
scores AS (SELECT item_id, r, sum(repeats * part)::BIGINT AS score FROM asked JOIN parts USING (term) GROUP BY item_id, r),
ranked AS (
    SELECT item_id, doc_id, score,
           row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank
    FROM scores JOIN sizes USING (r) WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

# Hard negatives: all scores of all anchors, as in hard_negatives.py.
ORACLES["op11_shared_lists"] = """
WITH cast_ AS (SELECT vec_id, label, embedding::DOUBLE[] AS vec FROM embeddings),
rows_ AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(vec, lambda x: floor(256 * x)) AS vec
    FROM cast_
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND vec IS NOT NULL
      AND len(list_filter(vec, lambda x: x IS NOT NULL AND isfinite(x))) = len(vec)
),
scores AS (
    SELECT a.vec_id AS anchor_id, a.label AS own, r.vec_id, r.label, list_inner_product(a.vec, r.vec)::BIGINT AS score
    FROM rows_ a JOIN rows_ r ON a.vec_id % 50 = 0 AND r.vec_id <> a.vec_id AND len(r.vec) = len(a.vec)
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE label = own
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
negatives AS (
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
           row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank
    FROM positives JOIN scores USING (anchor_id)
    WHERE label <> own AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT * FROM negatives WHERE rank <= 3
"""

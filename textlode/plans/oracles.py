"""The registered queries as DuckDB SQL, written independently of the Spark plans.

Cleaning is spelt step by step here, where the library fuses steps; windows,
self joins and recursive queries stand for its row-local array functions.
"""

from __future__ import annotations

from collections.abc import Callable

from textlode.plans import fixtures as X

# Unicode white space and word characters (contents of a class).
WS = (
    r"\s\x{000B}\x{001C}-\x{001F}\x{0085}\x{00A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
WORD = r"\p{L}\p{N}_"

# The emoji and symbol blocks.
EMOJI = (
    r"\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F700}-\x{1F77F}"
    r"\x{1F780}-\x{1F7FF}\x{1F800}-\x{1F8FF}\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FA6F}"
    r"\x{1FA70}-\x{1FAFF}\x{2702}-\x{27B0}\x{24C2}-\x{1F251}"
)


def sub(x: str, pattern: str, to: str = " ") -> str:
    return f"regexp_replace({x}, '{pattern}', '{to}', 'g')"


def collapse(x: str) -> str:
    return f"trim({sub(x, f'[{WS}]+')})"


def strip(x: str) -> str:
    return sub(x, f"^[{WS}]+|[{WS}]+$", "")


def chain(x: str, lower=1, yo=1, urls=1, emoji=1, html=1, punct=1, telegram=1) -> str:
    if lower:
        x = f"lower({x})"
    if yo:
        x = f"replace({x}, 'ё', 'е')"
    if urls:
        x = sub(x, rf"https?://[^{WS}]+|www\.[^{WS}]+")
    if emoji:
        x = sub(x, f"[{EMOJI}]+")
    if html:
        x = sub(x, "&[a-z]+;")
    if punct:
        x = sub(x, f"[^a-zа-я{WS}]")
    if telegram:
        x = sub(x, f"@[{WORD}]+|/[{WORD}]+")
    return collapse(x)


def clear(x: str) -> str:
    return chain(x)


def social(x: str) -> str:
    cut = sub(f"coalesce({x}, '')", rf"http[^{WS}]+|www[^{WS}]+|@[{WORD}]+|#[{WORD}]+", "")
    return f"lower({collapse(sub(cut, f'[^{WORD}{WS}.,!?]'))})"


def simple(x: str) -> str:
    return sub(sub(f"lower({x})", f"[^{WORD}{WS}]", ""), f"[{WS}]+")


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[{WS}]+'), lambda w: w <> '')"


def processed(x: str) -> str:
    text = strip(f"coalesce({x}, '')")
    return (
        f"CASE WHEN lower({text}) IN ('', 'nan') THEN '' "
        f"ELSE substr({clear(text)}, 1, 500) END"
    )


def split_sentences(x: str) -> str:
    """No look-behind here: a marker character replaces the white space after `.!?`."""
    marked = rf"regexp_replace({x}, '([.!?])[{WS}]+', concat('\1', chr(1)), 'g')"
    return f"string_split({marked}, chr(1))"


def numbered(key: str, items: str, source: str, at: str, item: str, base: int = 0) -> str:
    """One row per list element, with its index."""
    return (
        f"SELECT {key}, unnest(range(len({items})))::INTEGER + {base} AS {at}, "
        f"unnest({items}) AS {item} FROM {source}"
    )


TURNS = "turns AS (SELECT conv_id * 1000 + turn AS doc_id, role, text FROM conversations)"
CLEAN_TURNS = f"{TURNS}, docs AS (SELECT doc_id, {clear('text')} AS clean FROM turns)"
CLEAN_DOCS = f"docs AS (SELECT doc_id, {clear('text')} AS clean FROM documents)"
PAGE = "concat_ws(' ', url, html)"


POSTS3 = (
    "posts3 AS (SELECT conv_id * 1000 + turn AS post_id, CASE role WHEN 'user' THEN text END AS doc_text, "
    "CASE role WHEN 'assistant' THEN text END AS image2text, CASE role WHEN 'system' THEN text END AS speech2text "
    "FROM conversations)"
)
POST_COLUMNS = ["doc_text", "image2text", "speech2text"]

# Spans of the tokens of docs(doc_id, clean).
SPANS = """
toks AS (SELECT doc_id, unnest(range(len(string_split(clean, ' '))))::INTEGER AS position,
                unnest(string_split(clean, ' ')) AS token FROM docs WHERE clean <> ''),
spans AS (SELECT doc_id, position, token,
                 (upto - length(token) - 1)::INTEGER AS start_clean, (upto - 1)::INTEGER AS end_clean
          FROM (SELECT *, (sum(length(token) + 1) OVER (PARTITION BY doc_id ORDER BY position))::BIGINT AS upto
                FROM toks))"""

LEXICON = f"lexicon AS ({X.LEMMA_LEXICON})"
SYNONYMS = f"synonyms AS ({X.SYNONYMS})"

# Position in the original of every character of the cleaned turns.
CHAR_MAP = """
folded AS (SELECT t.doc_id, replace(lower(t.text), 'ё', 'е') AS f, d.clean, length(t.text) AS n
           FROM turns t JOIN docs d USING (doc_id)),
steps(doc_id, k, p) AS (
  SELECT doc_id, 0, instr(f, substr(clean, 1, 1)) FROM folded WHERE clean <> ''
  UNION ALL
  SELECT s.doc_id, s.k + 1,
         CASE WHEN s.p = 0 THEN 0
              WHEN instr(substr(f, s.p + 1), substr(clean, s.k + 2, 1)) = 0 THEN 0
              ELSE s.p + instr(substr(f, s.p + 1), substr(clean, s.k + 2, 1)) END
  FROM steps s JOIN folded USING (doc_id) WHERE s.k + 1 < length(clean)),
charmap AS (SELECT doc_id, k::INTEGER AS clean_at,
                   (CASE WHEN p = 0 THEN n - 1 ELSE p - 1 END)::INTEGER AS original
            FROM steps JOIN folded USING (doc_id))"""



def blanked(x: str, pattern: str) -> str:
    """Every match replaced by as many spaces as it has characters."""
    return (
        f"array_to_string(list_transform(list_zip(regexp_split_to_array({x}, '{pattern}'), "
        f"regexp_extract_all({x}, '{pattern}')), lambda z: z[1] || repeat(' ', length(coalesce(z[2], '')))), '')"
    )


# Words of the turns where they stand in the original: letter runs once URLs and entities are blank.
ORIGINAL_SPANS = f"""
folded_text AS (SELECT doc_id, replace(lower(replace(text, 'İ', ' ')), 'ё', 'е') AS f FROM turns),
no_urls AS (SELECT doc_id, {blanked('f', rf"https?://[^{WS}]+|www\.[^{WS}]+")} AS f FROM folded_text),
no_entities AS (SELECT doc_id, {blanked('f', '&[a-z]+;')} AS f FROM no_urls),
otoks AS (SELECT doc_id, unnest(range(len(w)))::INTEGER AS position, unnest(w) AS token, unnest(g[:len(w)]) AS gap
          FROM (SELECT doc_id, regexp_extract_all(f, '[a-zа-я]+') AS w, regexp_split_to_array(f, '[a-zа-я]+') AS g
                FROM no_entities)),
origspans AS (SELECT doc_id, position, token, (upto - length(token))::INTEGER AS start_orig, upto::INTEGER AS end_orig
              FROM (SELECT *, (sum(length(gap) + length(token)) OVER (PARTITION BY doc_id ORDER BY position))::BIGINT AS upto
                    FROM otoks))"""

# Words with their lemmas.
LEMMA_SPANS = """
lspans AS (SELECT s.*, coalesce(lemma, token) AS lemma FROM spans s LEFT JOIN lexicon ON form = token)"""

QUERY_TOKENS = f"""
qclean AS (SELECT item_id AS query_id, {clear('text')} AS clean FROM benchmark),
qtoks AS (SELECT query_id, unnest(range(len(string_split(clean, ' '))))::INTEGER AS position,
                 unnest(string_split(clean, ' ')) AS token FROM qclean WHERE clean <> '')"""

QUERY_LEMMAS = f"""{LEXICON}, {SYNONYMS}, {QUERY_TOKENS},
qlemmas AS (SELECT query_id, position, coalesce(lemma, token) AS term
            FROM qtoks LEFT JOIN lexicon ON form = token)"""

EXPANDED = """
expanded AS (SELECT DISTINCT query_id, term FROM (
  SELECT query_id, term FROM qlemmas
  UNION ALL SELECT query_id, lower(sense) FROM qlemmas JOIN synonyms ON word = term))"""

CAPPED = """
firsts AS (SELECT word, sense, min((synset_rank, sense_rank)) AS place FROM synonyms
           WHERE synset_rank <= 2 AND sense <> word GROUP BY word, sense),
capped AS (SELECT word, rank, sense FROM (
  SELECT word, sense, (row_number() OVER (PARTITION BY word ORDER BY place))::INTEGER AS rank FROM firsts)
  WHERE rank <= 3),
terms AS (SELECT query_id, position, 0 AS rank, term FROM qlemmas
          UNION ALL SELECT query_id, position, rank, sense FROM qlemmas JOIN capped ON word = term)"""


def bm25(dterms: str, qterms: str) -> str:
    """BM25 of docs(doc_id, ..) from dterms(doc_id, term) and qterms(query_id, term)."""
    return f"""
dterms AS ({dterms}),
lengths AS (SELECT docs.doc_id, count(term) AS dl FROM docs LEFT JOIN dterms USING (doc_id) GROUP BY 1),
stats AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM lengths),
tf AS (SELECT doc_id, term, count(*) AS tf FROM dterms GROUP BY ALL),
raws AS (SELECT term, ln(n - df + 0.5) - ln(df + 0.5) AS raw
         FROM (SELECT term, count(*) AS df FROM tf GROUP BY 1), stats),
idfs AS (SELECT term, CASE WHEN raw < 0 THEN 0.25 * (SELECT avg(raw) FROM raws) ELSE raw END AS idf FROM raws),
qtf AS (SELECT query_id, term, count(*) AS qtf FROM ({qterms}) GROUP BY ALL),
bm AS (SELECT query_id, doc_id, dl,
              round(sum(qtf * idf * tf * 2.5 / (tf + 1.5 * (1 - 0.75 + 0.75 * dl / avgdl))), 6) AS score
       FROM qtf JOIN tf USING (term) JOIN idfs USING (term) JOIN lengths USING (doc_id), stats
       GROUP BY ALL)"""


DOC_TERMS = "SELECT doc_id, unnest(string_split(clean, ' ')) AS term FROM docs WHERE clean <> ''"
PLAIN_BM25 = f"{QUERY_TOKENS}, " + bm25(DOC_TERMS, "SELECT query_id, token AS term FROM qtoks")
LEMMA_BM25 = f"{QUERY_LEMMAS}, {EXPANDED}, " + bm25(
    f"SELECT doc_id, coalesce(lemma, t.term) AS term FROM ({DOC_TERMS}) t LEFT JOIN lexicon ON form = t.term",
    "SELECT query_id, term FROM expanded",
)


def lemma_runs(keys: str, last: str, source: str, group: str, lemma: str) -> str:
    """Runs of three to six neighbouring lemmas with `<last>` of their last word as `stop`."""

    def run(n: int) -> str:
        ahead = [f"lead({lemma}, {k}) OVER w" for k in range(1, n)]
        return (
            f"SELECT * FROM (SELECT {keys}{' || '.join([lemma, *[chr(39) + ' ' + chr(39) + ' || ' + a for a in ahead]])} AS phrase, "
            f"lead({last}, {n - 1}) OVER w AS stop FROM {source} WINDOW w AS (PARTITION BY {group} ORDER BY position)) WHERE phrase IS NOT NULL"
        )

    return " UNION ALL ".join(run(n) for n in range(3, 7))


def lemma_run(n: int) -> str:
    """All runs of `n` words of lspans, as text and as lemmas."""

    def run(col: str) -> str:
        return " || ' ' || ".join([col, *[f"lead({col}, {k}) OVER w" for k in range(1, n)]])

    return (
        f"SELECT doc_id, {run('token')} AS text, {run('lemma')} AS lemma, start_clean AS start, "
        f"lead(end_clean, {n - 1}) OVER w AS stop, {n} AS length FROM lspans WINDOW w AS (PARTITION BY doc_id ORDER BY position)"
    )


def best(source: str, n: int, order: str = "score DESC, doc_id") -> str:
    return (
        f"SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY {order}))::INTEGER AS rank "
        f"FROM {source} QUALIFY rank <= {n}"
    )


def buckets(name: str, key: str, source: str) -> str:
    """Sparse hashed word counts `(key, bucket, weight)` of source(key, clean)."""
    return f"""
{name} AS (SELECT {key}, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS bucket, count(*)::DOUBLE AS weight
  FROM (SELECT {key}, unnest(string_split(clean, ' ')) AS term FROM {source} WHERE clean <> '') GROUP BY ALL)"""


# Cosine of candidates cands(query_id, doc_id, ..) by hashed word counts.
COSINES = f"""{buckets('dvec', 'doc_id', 'docs')}, {buckets('qvec', 'query_id', 'qclean')},
dnorm AS (SELECT doc_id, sum(weight * weight) AS dd FROM dvec GROUP BY 1),
qnorm AS (SELECT query_id, sum(weight * weight) AS qq FROM qvec GROUP BY 1),
dots AS (SELECT query_id, doc_id, sum(q.weight * d.weight) AS dot
         FROM cands JOIN qvec q USING (query_id) JOIN dvec d USING (doc_id, bucket) GROUP BY ALL),
cosines AS (SELECT c.*, coalesce(dot, 0) / (sqrt(qq) * sqrt(dd)) AS cosine, qq + dd - 2 * coalesce(dot, 0) AS distance
            FROM cands c JOIN dnorm USING (doc_id) JOIN qnorm USING (query_id)
            LEFT JOIN dots USING (query_id, doc_id))"""


def triples(key: str, source: str) -> str:
    split = f"SELECT {key}, {split_sentences('text')} AS ss FROM {source}"
    role = lambda n: f"array_to_string(list_filter(w, lambda x, i: i % 3 = {n}), ' ')"
    return f"""SELECT {key}, sent, {role(1)} AS subj, {role(2)} AS verb, {role(0)} AS obj FROM (
  SELECT {key}, sent, string_split({clear('sentence')}, ' ') AS w
  FROM ({numbered(key, 'ss', f'({split})', 'sent', 'sentence')})) WHERE len(w) >= 3"""


TRIPLES = (
    f"dtriples AS ({triples('doc_id', 'documents')}), "
    f"qtriples AS ({triples('query_id', '(SELECT item_id AS query_id, text FROM benchmark)')})"
)

# Components of the vectors; the mean per label is one query vector.
COMPONENTS = """
comps AS (SELECT vec_id, label, unnest(range(len(embedding)))::INTEGER AS dim,
                 unnest(embedding)::DOUBLE AS x FROM embeddings),
centroids AS (SELECT label AS query_id, dim, avg(x) AS q FROM comps GROUP BY ALL)"""

NEAR = f"""{COMPONENTS},
near AS (SELECT query_id, vec_id, round(sum(q * x), 6) + 0.0 AS ip,
                round(sum((q - x) * (q - x)), 6) + 0.0 AS l2,
                round(sum(q * x) / (sqrt(sum(q * q)) * sqrt(sum(x * x))), 6) + 0.0 AS cosine
         FROM centroids JOIN comps USING (dim) GROUP BY ALL)"""

SENTENCES = numbered(
    "doc_id", "ss", f"(SELECT doc_id, {split_sentences('text')} AS ss FROM documents)", "sent", "sentence"
)

PHRASES = """
phrases AS (
  SELECT {keys}, 'word' AS type, token AS text, lemma, start_clean AS start, end_clean AS stop, 1 AS length
  FROM lspans
  UNION ALL
  SELECT {keys}, 'phrase', token || ' ' || next, lemma || ' ' || next_lemma, start_clean, next_end, 2
  FROM (SELECT *, lead(token) OVER w AS next, lead(lemma) OVER w AS next_lemma, lead(end_clean) OVER w AS next_end FROM lspans
        WINDOW w AS (PARTITION BY {keys} ORDER BY position)) WHERE next IS NOT NULL)"""

DEDUP = "row_number() OVER (PARTITION BY md5(clean) ORDER BY doc_id) = 1"

HOMES = f"""{CLEAN_DOCS},
frags AS (SELECT DISTINCT {clear('text')} AS fragment FROM benchmark),
homes AS (SELECT fragment, min(doc_id) AS doc_id FROM frags JOIN docs ON contains(clean, fragment)
          WHERE fragment <> '' GROUP BY 1)"""

PAIRS = f"""{CLEAN_TURNS}, {buckets('vec', 'doc_id', 'docs')},
norms AS (SELECT doc_id, sum(weight * weight) AS dd FROM vec GROUP BY 1),
pairs AS (SELECT a.doc_id, a.clean AS c, b.clean AS d FROM docs a JOIN docs b ON a.doc_id = b.doc_id + 1),
dots AS (SELECT p.doc_id, sum(a.weight * b.weight) AS dot FROM pairs p JOIN vec a ON a.doc_id = p.doc_id
         JOIN vec b ON b.doc_id = p.doc_id - 1 AND b.bucket = a.bucket GROUP BY 1),
ratios AS (SELECT p.doc_id, 1 - levenshtein(c, d) / greatest(length(c), length(d)) AS text_ratio,
                  coalesce(dot, 0) / (sqrt(a.dd) * sqrt(b.dd)) AS cosine
           FROM pairs p JOIN norms a ON a.doc_id = p.doc_id JOIN norms b ON b.doc_id = p.doc_id - 1
           LEFT JOIN dots ON dots.doc_id = p.doc_id)"""

SPLIT_TURNS = numbered(
    "doc_id", "ss", f"(SELECT doc_id, {split_sentences('text')} AS ss FROM turns)", "sent", "sentence"
)


def cleaned(expr: str) -> str:
    return f"SELECT doc_id, {expr} AS clean FROM documents"


def cleaned_pages(**flags) -> str:
    return f"SELECT page_id, {chain(PAGE, **flags)} AS clean FROM pages"


def sentiment_hits(lexicon: list[str]) -> str:
    return " + ".join(f"contains(lower(text), '{w}')::INTEGER" for w in lexicon)


def filled(c: str) -> str:
    return f"coalesce({c}, '')"


def per_column(select: Callable[[str], str]) -> str:
    return " UNION ALL ".join(select(c) for c in POST_COLUMNS)


ORACLES: dict[str, str] = {
    "scan_csv_union": "SELECT conv_id, turn, CASE WHEN role <> 'user' THEN role END AS role, text FROM conversations",
    "scan_pruned": f"WITH {POSTS3} SELECT doc_text FROM posts3",
    "scan_headerless": f"WITH {POSTS3} SELECT {', '.join(POST_COLUMNS)} FROM posts3",
    "scan_file_filter": f"WITH {TURNS} SELECT doc_id, text FROM turns",
    "rows_per_file": "SELECT role, count(*) AS n FROM conversations GROUP BY role",
    "sink_csv_roundtrip": f"WITH {POSTS3} SELECT {', '.join(f'{clear(c)} AS {c}' for c in POST_COLUMNS)} FROM posts3",
    "write_corpus": f"""WITH {TURNS}, docs AS (SELECT doc_id, {clear('text')} AS clean FROM turns WHERE {clear('text')} <> ''
         QUALIFY row_number() OVER (PARTITION BY md5({clear('text')}) ORDER BY doc_id) = 1),
{SPANS}, {LEXICON}, {ORIGINAL_SPANS}
SELECT s.doc_id, docs.clean AS cleaned_text, s.position, s.token, coalesce(lemma, s.token) AS lemma, pos,
  start_clean, end_clean, start_orig, end_orig
FROM spans s JOIN docs USING (doc_id) JOIN origspans USING (doc_id, position) LEFT JOIN lexicon ON form = s.token""",
    "append_corpus": """SELECT doc_id, text, len(embedding)::INTEGER AS width
FROM documents LEFT JOIN embeddings ON vec_id = doc_id""",
    "delete_version": """SELECT doc_id, text, (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)) AS n_deleted
FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "vectors_load_or_create": f"WITH {COMPONENTS} SELECT vec_id AS doc_id, dim, round(x, 6) + 0.0 AS x FROM comps",
    "search_log": f"""WITH {NEAR} SELECT query_id, vec_id AS doc_id, cosine AS score, rank
FROM ({best('near', 5, 'cosine DESC, vec_id')}) WHERE cosine >= 0.4""",
    "nested_document": f"""WITH {CLEAN_TURNS}, {SPANS}, {LEXICON}, {LEMMA_SPANS}, {PHRASES.format(keys='doc_id')}, gazetteer AS ({X.GAZETTEER}),
found AS (SELECT doc_id, normal, start, stop FROM phrases JOIN gazetteer g ON lemma = phrase_lemma
  WHERE g.type IN ('PER', 'LOC', 'ORG') QUALIFY row_number() OVER (PARTITION BY doc_id, start ORDER BY length DESC, g.type DESC) = 1),
lists AS (SELECT doc_id, string_agg(normal, ' ' ORDER BY start, stop) AS entities FROM found GROUP BY 1),
split AS ({SPLIT_TURNS}),
counts AS (SELECT doc_id, count(*)::INTEGER AS n_sentences,
  coalesce(string_agg(nullif({clear('sentence')}, ''), ' ' ORDER BY sent), '') AS words FROM split GROUP BY 1)
SELECT docs.doc_id, docs.clean AS clean_text, n_sentences, words, entities
FROM docs JOIN counts USING (doc_id) LEFT JOIN lists USING (doc_id)""",
    "vectors_roundtrip": f"WITH {COMPONENTS} SELECT vec_id AS doc_id, dim, round(x, 6) + 0.0 AS x FROM comps",
    "clean_flags": cleaned_pages(yo=0, emoji=0, punct=0),
    "clear_text": cleaned(clear("text")),
    "clean_for_search": cleaned_pages(punct=0, telegram=0),
    "clean_for_embedding": cleaned_pages(),
    "clean_for_display": cleaned_pages(lower=0, yo=0, urls=0, emoji=0, punct=0),
    "clean_social": f"SELECT page_id, {social(PAGE)} AS clean FROM pages",
    "clean_simple": cleaned(simple("text")),
    "clean_words": cleaned(f"trim({simple('text')})"),
    "clean_underscore": f"SELECT page_id, {sub(f'lower({PAGE})', '[^\\p{L}\\p{N}]+')} AS clean FROM pages",
    "clean_alnum": cleaned(f"lower({sub(sub('text', f'[^\\p{{L}}\\p{{N}}{WS}]', ''), f'[{WS}]')})"),
    "clean_columns": f"WITH {POSTS3} SELECT post_id, {', '.join(f'{clear(c)} AS {c}' for c in POST_COLUMNS)} FROM posts3",
    "processed_text": cleaned(processed("text")),
    "merge_fields": f"""WITH {POSTS3} SELECT post_id,
concat_ws(' ', {', '.join(f"nullif({social(c)}, '')" for c in POST_COLUMNS)}) AS merged FROM posts3""",
    "fill_nulls": f"""WITH {POSTS3} SELECT post_id, {', '.join(f"coalesce({c}, '') AS {c}" for c in POST_COLUMNS)} FROM posts3""",
    "slang_normalise": f"""WITH {CLEAN_DOCS}, slang AS ({X.SLANG}),
toks AS ({numbered('doc_id', "string_split(clean, ' ')", 'docs', 'position', 'token')})
SELECT doc_id, string_agg(coalesce(replacement, token), ' ' ORDER BY position) AS normalised
FROM toks LEFT JOIN slang ON term = token GROUP BY doc_id""",
    "filter_words": f"""WITH {TURNS}, limited AS (SELECT doc_id, {processed('text')} AS clean FROM turns)
SELECT * FROM limited WHERE clean <> '' AND len(string_split(clean, ' ')) BETWEEN 1 AND 30""",
    "filter_min_chars": f"SELECT * FROM ({SENTENCES}) WHERE length(sentence) > 10",
    "filter_min_words": f"SELECT * FROM ({SENTENCES}) WHERE len({words('sentence')}) >= 3",
    "validate_max_words": f"""WITH {TURNS}, counted AS (SELECT doc_id, len({words('text')})::INTEGER AS n_words FROM turns)
SELECT *, CASE WHEN n_words > 30 THEN 'more than 30 words' END AS reason FROM counted""",
    "search_any_column": r"""SELECT doc_id, source FROM documents
WHERE coalesce(regexp_matches(text, '(?i)^src1\d$|\bthe\s+and\b|ÉAU'), false)
   OR coalesce(regexp_matches(lang, '(?i)^src1\d$|\bthe\s+and\b|ÉAU'), false)
   OR coalesce(regexp_matches(source, '(?i)^src1\d$|\bthe\s+and\b|ÉAU'), false)""",
    "drop_punct": f"SELECT doc_id, {collapse(sub('text', '[.,!?]'))} AS kept FROM documents",
    "vector_dim_check": """SELECT vec_id, CASE WHEN label = 3 THEN 32 ELSE len(embedding) END::INTEGER AS dim,
label <> 3 AS ok FROM embeddings""",
    "validate_pos": f"""WITH {CLEAN_TURNS}, {LEXICON}, {PLAIN_BM25}, top AS ({best('bm', 10)})
SELECT query_id, doc_id, rank FROM top WHERE EXISTS (
  SELECT 1 FROM qtoks JOIN lexicon q ON q.form = qtoks.token JOIN lexicon d ON d.lemma = q.lemma AND d.pos = q.pos
  JOIN dterms ON dterms.term = d.form
  WHERE q.pos = 'VERB' AND qtoks.query_id = top.query_id AND dterms.doc_id = top.doc_id)""",
    "tokenize": numbered("doc_id", words("text"), "documents", "position", "token"),
    "sentences": SENTENCES,
    "token_spans": f"WITH {CLEAN_DOCS}, {SPANS} SELECT * FROM spans",
    "char_map": f"WITH RECURSIVE {CLEAN_TURNS}, {CHAR_MAP} SELECT * FROM charmap",
    "span_to_original": f"""WITH {TURNS}, {ORIGINAL_SPANS}
SELECT doc_id, position, start_orig, end_orig FROM origspans""",
    "lemmatize_lexicon": f"""WITH {CLEAN_TURNS}, {SPANS}, {LEXICON}
SELECT doc_id, position, token, coalesce(lemma, token) AS lemma, pos FROM spans LEFT JOIN lexicon ON form = token""",
    "truncate_tokens": f"""WITH {CLEAN_DOCS}, w AS (SELECT doc_id, list_filter(string_split(clean, ' '), lambda x: x <> '')[1:30] AS t FROM docs)
SELECT doc_id, len(t)::INTEGER AS n, array_to_string(t, ' ') AS clean FROM w""",
    "unigram_bigram": f"""WITH {CLEAN_TURNS}, {SPANS}, {LEXICON}, {LEMMA_SPANS}
SELECT doc_id, lemma AS token, position, 'unigram' AS type FROM lspans
UNION ALL
SELECT doc_id, lemma || ' ' || next, position, 'bigram'
FROM (SELECT *, lead(lemma) OVER (PARTITION BY doc_id ORDER BY position) AS next FROM lspans) WHERE next IS NOT NULL""",
    "phrases": f"WITH {CLEAN_TURNS}, {SPANS}, {LEXICON}, {LEMMA_SPANS}, {PHRASES.format(keys='doc_id')} SELECT * FROM phrases",
    "phrases_in_sentence": f"""WITH {TURNS}, split AS ({SPLIT_TURNS}),
docs AS (SELECT doc_id * 10000 + sent AS doc_id, {clear('sentence')} AS clean FROM split),
{SPANS}, {LEXICON}, {LEMMA_SPANS}, {PHRASES.format(keys='doc_id')}
SELECT doc_id // 10000 AS doc_id, (doc_id % 10000)::INTEGER AS sent, type, text, lemma, start, stop, length FROM phrases""",
    "entities_gazetteer": f"""WITH {CLEAN_TURNS}, {SPANS}, {LEXICON}, {LEMMA_SPANS}, {PHRASES.format(keys='doc_id')}, gazetteer AS ({X.GAZETTEER})
SELECT doc_id, text, normal AS lemma, g.type, start, stop, length FROM phrases p JOIN gazetteer g ON lemma = phrase_lemma
WHERE g.type IN ('PER', 'LOC', 'ORG') QUALIFY row_number() OVER (PARTITION BY doc_id, start ORDER BY length DESC, g.type DESC) = 1""",
    "entities_any_length": f"""WITH {CLEAN_DOCS}, {SPANS}, {QUERY_LEMMAS}, {LEMMA_SPANS},
begins AS (SELECT n, kind, query_id, string_agg(term, ' ' ORDER BY position) AS phrase
  FROM qlemmas, (VALUES (2, 'PER'), (3, 'LOC'), (5, 'ORG'), (7, 'ORG')) AS t(n, kind) WHERE position < n
  GROUP BY n, kind, query_id HAVING count(*) = n),
gazetteer AS (SELECT DISTINCT phrase, kind, n FROM begins),
runs AS ({" UNION ALL ".join(lemma_run(n) for n in (2, 3, 5, 7))})
SELECT doc_id, text, upper(phrase) AS lemma, kind AS type, start, stop, length FROM runs JOIN gazetteer ON lemma = phrase
QUALIFY row_number() OVER (PARTITION BY doc_id, start ORDER BY length DESC, kind DESC) = 1""",
    "triples_from_rel": triples("doc_id", "documents"),
    "tokens_json_roundtrip": f"""WITH {CLEAN_TURNS}, {SPANS}, {ORIGINAL_SPANS}
SELECT d.doc_id, length(clean)::INTEGER AS n_mapping, s.token, start_clean, end_clean, start_orig, end_orig
FROM docs d LEFT JOIN spans s ON s.doc_id = d.doc_id LEFT JOIN origspans o ON o.doc_id = s.doc_id AND o.position = s.position""",
    "slice_original": f"""WITH {TURNS}, {ORIGINAL_SPANS}
SELECT doc_id, position, substr(text, start_orig + 1, end_orig - start_orig) AS slice FROM origspans JOIN turns USING (doc_id)""",
    "expand_synonyms": f"WITH {QUERY_LEMMAS}, {EXPANDED} SELECT * FROM expanded",
    "expand_capped": f"WITH {QUERY_LEMMAS}, {CAPPED} SELECT * FROM terms",
    "process_query": f"""WITH {QUERY_LEMMAS}, {CAPPED}
SELECT query_id, any_value(clean) AS clean_query, string_agg(term, ' ' ORDER BY position) FILTER (WHERE rank = 0) AS lemmas,
  string_agg(term, ' ' ORDER BY (rank > 0), position, rank) AS expanded_terms
FROM terms JOIN qclean USING (query_id) GROUP BY query_id""",
    "synset_siblings": f"""WITH {CLEAN_TURNS}, {SYNONYMS}, vocabulary AS (SELECT DISTINCT term FROM ({DOC_TERMS}))
SELECT DISTINCT a.word, a.synset_id, lower(b.sense) AS sibling
FROM vocabulary JOIN synonyms a ON a.word = term JOIN synonyms b ON b.synset_id = a.synset_id""",
    "embed_hash": f"""WITH {CLEAN_DOCS}, {buckets('vec', 'doc_id', 'docs')},
grid AS (SELECT doc_id, unnest(range(64))::INTEGER AS dim FROM docs WHERE clean <> '')
SELECT grid.doc_id, dim, coalesce(weight, 0.0) AS x FROM grid LEFT JOIN vec ON vec.doc_id = grid.doc_id AND bucket = dim""",
    "mean_pool": f"""WITH {COMPONENTS}, masks AS (SELECT vec_id, (embedding[1] >= 0)::INTEGER AS m FROM embeddings)
SELECT label, dim, round(sum(x * m) / greatest(sum(m), 1e-9), 6) + 0.0 AS x FROM comps JOIN masks USING (vec_id) GROUP BY ALL""",
    "l2_normalize": f"""WITH {COMPONENTS}, norms AS (SELECT vec_id, sqrt(sum(power(x * label * 2, 2))) AS n FROM comps GROUP BY 1)
SELECT vec_id, dim, round(CASE WHEN n = 0 THEN 0.0 ELSE x * label * 2 / n END, 6) + 0.0 AS x FROM comps JOIN norms USING (vec_id)""",
    "knn_ip": f"WITH {NEAR} SELECT query_id, vec_id, ip AS score, rank FROM ({best('near', 10, 'ip DESC, vec_id')})",
    "knn_all": f"""WITH vecs AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
near AS (SELECT q.vec_id AS query_id, v.vec_id, round(list_aggregate(list_transform(list_zip(q.e, v.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])), 'sum'), 6) + 0.0 AS l2
  FROM vecs q, vecs v)
SELECT query_id, vec_id, l2 AS score, rank FROM ({best('near', 5, 'l2, vec_id')})""",
    "knn_l2": f"WITH {NEAR} SELECT query_id, vec_id, l2 AS score, rank FROM ({best('near', 10, 'l2, vec_id')})",
    "cosine_pairs": f"""WITH {NEAR} SELECT near.vec_id, label, cosine FROM near JOIN embeddings e
ON e.vec_id = near.vec_id AND e.label = near.query_id""",
    "vector_count": "SELECT count(*) AS n FROM embeddings",
    "semantic_search": f"""WITH {NEAR} SELECT query_id, vec_id, cosine AS score, rank
FROM ({best('near', 5, 'cosine DESC, vec_id')}) WHERE cosine >= 0.4""",
    "bm25_scores": f"WITH {CLEAN_DOCS}, {PLAIN_BM25} SELECT query_id, doc_id, dl::INTEGER AS dl, score FROM bm",
    "bm25_top_n": f"WITH {CLEAN_DOCS}, {PLAIN_BM25} SELECT query_id, doc_id, score, rank FROM ({best('bm', 10)})",
    "bm25_stored": f"WITH {CLEAN_DOCS}, {PLAIN_BM25} SELECT query_id, doc_id, score, rank FROM ({best('bm', 10)})",
    "stream_tables": f"""WITH {CLEAN_TURNS}, valid AS (SELECT * FROM docs WHERE clean <> ''),
kept AS (SELECT * FROM valid QUALIFY {DEDUP}),
counts AS (SELECT (SELECT count(*) FROM docs) AS received, (SELECT count(*) FROM kept) AS stored,
  (SELECT count(*) FROM valid) - (SELECT count(*) FROM kept) AS duplicates, (SELECT count(*) FROM docs) - (SELECT count(*) FROM valid) AS skipped)
SELECT doc_id, len(string_split(clean, ' '))::BIGINT AS n_tokens, 64::INTEGER AS width, counts.* FROM kept, counts""",
    "bm25_rerank": f"""WITH {CLEAN_DOCS}, {PLAIN_BM25}, cands AS (SELECT query_id, doc_id FROM ({best('bm', 10)})), {COSINES}
SELECT query_id, doc_id, round(distance, 6) AS distance, rank FROM ({best('cosines', 10, 'round(distance, 6), doc_id')})""",
    "hybrid_v1": f"""WITH {CLEAN_DOCS}, {PLAIN_BM25}, cands AS (SELECT query_id, doc_id, score FROM ({best('bm', 6)})), {COSINES}, {TRIPLES},
shared AS (SELECT DISTINCT query_id, doc_id, 1.2 AS boost FROM qtriples JOIN dtriples USING (subj, verb, obj)),
blend AS (SELECT query_id, doc_id, round((0.3::DOUBLE * c.score + 0.7::DOUBLE * cosine) * coalesce(boost, 1)::DOUBLE, 6) AS score
          FROM cosines c LEFT JOIN shared USING (query_id, doc_id))
{best('blend', 3)}""",
    "triple_match": f"""WITH {CLEAN_DOCS}, {PLAIN_BM25}, {TRIPLES}, top AS ({best('bm', 10)})
SELECT query_id, doc_id, rank FROM top WHERE EXISTS (SELECT 1 FROM qtriples q JOIN dtriples d USING (subj, verb, obj)
  WHERE q.query_id = top.query_id AND d.doc_id = top.doc_id)""",
    "hybrid_v2": f"""WITH {CLEAN_TURNS}, {LEMMA_BM25}, cands AS (SELECT query_id, doc_id, dl, score FROM ({best('bm', 6)})), {COSINES},
blend AS (SELECT query_id, doc_id, round((0.3::DOUBLE * c.score + 0.7::DOUBLE * cosine)
   * (CASE WHEN dl < 10 THEN 1.5 ELSE 1.0 END)::DOUBLE
   * (CASE WHEN EXISTS (SELECT 1 FROM dterms JOIN expanded e USING (term) WHERE dterms.doc_id = c.doc_id AND e.query_id = c.query_id)
      THEN 1.2 ELSE 1.0 END)::DOUBLE, 6) AS score FROM cosines c)
{best('blend', 3)}""",
    "relevance_levenshtein": f"""WITH {PAIRS} SELECT doc_id, round(text_ratio, 6) AS text_ratio,
round(0.6::DOUBLE * cosine + 0.4::DOUBLE * text_ratio, 6) AS relevance FROM ratios""",
    "containing_doc": f"WITH {HOMES} SELECT * FROM homes",
    "context_window": f"""WITH {HOMES},
placed AS (SELECT fragment, doc_id, string_split(clean, ' ') AS w, len(string_split(fragment, ' ')) AS m,
                  instr(' ' || clean || ' ', ' ' || fragment || ' ') AS p, clean FROM homes JOIN docs USING (doc_id)),
counted AS (SELECT *, length(substr(' ' || clean, 1, p)) - length(replace(substr(' ' || clean, 1, p), ' ', '')) - 1 AS i FROM placed)
SELECT fragment, doc_id, CASE WHEN p = 0 THEN fragment
  ELSE array_to_string(w[greatest(i - 5, 0) + 1 : least(i + m + 5, len(w))], ' ') END AS context FROM counted""",
    "token_vector_search": f"""WITH {CLEAN_TURNS}, {SPANS}, {NEAR},
occurrences AS (SELECT doc_id, token, position, 'unigram' AS type FROM spans
  UNION ALL SELECT doc_id, token || ' ' || next, position, 'bigram'
  FROM (SELECT *, lead(token) OVER (PARTITION BY doc_id ORDER BY position) AS next FROM spans) WHERE next IS NOT NULL),
vocabulary AS (SELECT token, ('0x' || substr(md5(token), 1, 8))::BIGINT % (SELECT count(*) FROM embeddings) AS vec_id
  FROM (SELECT DISTINCT token FROM occurrences)),
hits AS (SELECT query_id, doc_id, token, position, type, ip AS confidence
  FROM occurrences JOIN vocabulary USING (token) JOIN near USING (vec_id))
SELECT query_id, rank, doc_id, token, position, type = 'bigram' AS is_bigram, confidence
FROM ({best('hits', 5, 'confidence DESC, token, doc_id, position, type')}) WHERE confidence >= 0.05""",
    "dedup_ranked": f"""WITH {QUERY_TOKENS}, {TRIPLES}, best AS (SELECT query_id, doc_id, max(length(word))::DOUBLE AS score
  FROM (SELECT *, unnest(string_split(subj, ' ')) AS word FROM dtriples) JOIN qtoks ON token = word GROUP BY ALL) {best('best', 5)}""",
    "phrase_positions": f"""WITH {CLEAN_TURNS}, {ORIGINAL_SPANS}, {LEMMA_BM25}, top AS ({best('bm', 5)}),
ltoks AS (SELECT o.*, coalesce(lemma, token) AS lemma FROM origspans o LEFT JOIN lexicon ON form = token),
located AS (SELECT doc_id, 'word' AS type, lemma, start_orig AS start, end_orig AS stop FROM ltoks
  UNION ALL SELECT doc_id, 'phrase', lemma || ' ' || next, start_orig, next_end
  FROM (SELECT *, lead(lemma) OVER w AS next, lead(end_orig) OVER w AS next_end FROM ltoks
        WINDOW w AS (PARTITION BY doc_id ORDER BY position)) WHERE next IS NOT NULL),
asked AS (SELECT query_id, term FROM expanded
  UNION SELECT query_id, term || ' ' || next FROM (SELECT query_id, term, lead(term) OVER (PARTITION BY query_id ORDER BY position) AS next
  FROM qlemmas) WHERE next IS NOT NULL)
SELECT top.query_id, top.doc_id, type, lemma, start, stop, score
FROM located JOIN top USING (doc_id) JOIN asked e ON e.query_id = top.query_id AND e.term = lemma""",
    "phrase_any_length": f"""WITH turns AS (SELECT doc_id, text FROM documents), {ORIGINAL_SPANS}, {QUERY_LEMMAS},
ltoks AS (SELECT o.*, coalesce(lemma, token) AS lemma FROM origspans o LEFT JOIN lexicon ON form = token),
found AS ({lemma_runs('doc_id, start_orig AS start, ', 'end_orig', 'ltoks', 'doc_id', 'lemma')}),
asked AS (SELECT DISTINCT query_id, phrase FROM ({lemma_runs('query_id, ', 'position', 'qlemmas', 'query_id', 'term')}))
SELECT query_id, doc_id, phrase, start, stop FROM found JOIN asked USING (phrase)""",
    "token_lookup": f"""WITH {CLEAN_TURNS}, {SPANS}, {LEXICON}, {SYNONYMS},
annotated AS (SELECT doc_id, position, token, coalesce(lemma, token) AS lemma, pos FROM spans LEFT JOIN lexicon ON form = token)
SELECT * FROM annotated WHERE lemma IN (SELECT word FROM synonyms)""",
    "text_stats": f"""WITH {CLEAN_DOCS}, w AS (SELECT doc_id, clean, list_filter(string_split(clean, ' '), lambda x: x <> '') AS t FROM docs)
SELECT doc_id, length(clean)::INTEGER AS length, len(t)::INTEGER AS word_count, len(list_distinct(t))::INTEGER AS unique_word_count,
  CASE WHEN len(t) = 0 THEN 0.0 ELSE format('{{:.2f}}', length(replace(clean, ' ', ''))::DOUBLE / len(t))::DOUBLE END AS avg_word_length,
  len(list_filter(t, lambda x: length(x) < 4))::INTEGER AS short_words_count,
  len(list_filter(t, lambda x: length(x) > 7))::INTEGER AS long_words_count FROM w""",
    "word_frequencies": f"WITH {CLEAN_DOCS} SELECT doc_id, term AS word, count(*) AS n FROM ({DOC_TERMS}) GROUP BY ALL",
    "top_words": f"""WITH {POSTS3}, w AS ({per_column(lambda c: f"SELECT '{c}' AS col, unnest({words(simple(filled(c)))}) AS word FROM posts3")}),
counts AS (SELECT col, word, count(*) AS n FROM w GROUP BY ALL)
SELECT col AS "column", word, n, (row_number() OVER (PARTITION BY col ORDER BY n DESC, word))::INTEGER AS rank FROM counts QUALIFY rank <= 10""",
    "null_counts": f"""WITH {POSTS3} SELECT {', '.join(f'count(*) FILTER (WHERE {c} IS NULL) AS {c}' for c in ['post_id', *POST_COLUMNS])} FROM posts3""",
    "duplicate_rows": """SELECT (count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source, n_chars FROM documents)))::BIGINT AS duplicates FROM documents""",
    "unique_values": "SELECT source AS value, min(doc_id) AS first_at FROM documents GROUP BY source ORDER BY first_at LIMIT 10",
    "length_summary": f"""WITH {POSTS3}, l AS ({per_column(lambda c: f"SELECT '{c}' AS col, length({filled(c)}) AS n FROM posts3")})
SELECT col AS "column", count(*) AS count, round(avg(n), 4) AS mean, round(stddev_samp(n), 4) AS std, min(n)::INTEGER AS min,
  round(quantile_cont(n, 0.25), 4) AS p25, round(quantile_cont(n, 0.5), 4) AS p50, round(quantile_cont(n, 0.75), 4) AS p75,
  max(n)::INTEGER AS max FROM l GROUP BY col""",
    "dataset_stats": f"""WITH {POSTS3}
SELECT 0 AS position, 'post_id' AS column, 'bigint' AS dtype, count(post_id) AS non_null, count(*) AS n_rows FROM posts3
UNION ALL {per_column(lambda c: f"SELECT {POST_COLUMNS.index(c) + 1}, '{c}', 'string', count({c}), count(*) FROM posts3")}""",
    "sentiment": f"""WITH {TURNS}, hits AS (SELECT doc_id, {sentiment_hits(X.POSITIVE_WORDS)} AS p, {sentiment_hits(X.NEGATIVE_WORDS)} AS n FROM turns)
SELECT doc_id, CASE WHEN p > n THEN 'Положительный' WHEN n > p THEN 'Отрицательный' ELSE 'Нейтральный' END AS sentiment FROM hits""",
    "ingest_summary": f"""WITH {CLEAN_DOCS}, valid AS (SELECT * FROM docs WHERE clean <> '' AND len(string_split(clean, ' ')) BETWEEN 1 AND 300)
SELECT (SELECT count(DISTINCT clean) FROM valid) AS success, (SELECT count(*) - count(DISTINCT clean) FROM valid) AS duplicates,
  (SELECT count(*) FROM docs) - (SELECT count(*) FROM valid) AS skipped, 0::BIGINT AS errors""",
    "union_all": f"WITH {TURNS} SELECT doc_id, text, NULL AS role FROM documents UNION ALL SELECT doc_id, text, role FROM turns",
    "distinct_rows": "SELECT DISTINCT text, lang FROM documents",
    "dedup_first": f"WITH {CLEAN_DOCS} SELECT * FROM docs WHERE clean <> '' QUALIFY {DEDUP}",
    "distinct_fragments": f"SELECT DISTINCT sentence FROM ({SENTENCES})",
    "insert_new_only": "SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "delete_by_id": "SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)",
    "delete_cascade": f"""WITH {CLEAN_DOCS}, counts AS (SELECT doc_id, count(*) AS n_tokens FROM ({DOC_TERMS}) GROUP BY 1)
SELECT doc_id, n_tokens FROM docs LEFT JOIN counts USING (doc_id) WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "get_documents": f"""WITH {CLEAN_DOCS} SELECT d.doc_id, text, nullif(clean, '') AS tokens FROM documents d JOIN docs USING (doc_id)
WHERE d.doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)""",
    "stream_ingest": f"WITH {CLEAN_DOCS} SELECT doc_id, clean AS cleaned_text FROM docs WHERE clean <> '' QUALIFY {DEDUP}",
    "annotate_forms": f"""WITH {CLEAN_TURNS}, {SPANS}
SELECT doc_id, position, token, CASE WHEN token = 's' THEN 's' ELSE regexp_replace(token, 's$', '') END AS lemma,
  CASE WHEN length(token) % 2 = 1 THEN 'NOUN' ELSE 'VERB' END AS pos FROM spans""",
    "annotate_triples": f"""WITH {CLEAN_TURNS}, {SPANS}, roles AS (SELECT doc_id, position,
  CASE WHEN token = 's' THEN 's' ELSE regexp_replace(token, 's$', '') END AS lemma FROM spans)
SELECT doc_id, string_agg(lemma, ' ' ORDER BY position) FILTER (WHERE position % 3 = 0) AS subj,
  string_agg(lemma, ' ' ORDER BY position) FILTER (WHERE position % 3 = 1) AS verb,
  string_agg(lemma, ' ' ORDER BY position) FILTER (WHERE position % 3 = 2) AS obj FROM roles GROUP BY doc_id HAVING count(*) >= 3""",
    "annotate_entities": f"""WITH {CLEAN_TURNS}, {SPANS}
SELECT doc_id, token AS text, regexp_replace(token, 's$', '') AS lemma, 'ORG' AS type, start_clean AS start, end_clean AS stop, 1 AS length
FROM spans WHERE length(token) > 9""",
    "embed_tfidf": f"""WITH {CLEAN_DOCS}, tf AS (SELECT doc_id, term, count(*) AS tf FROM ({DOC_TERMS}) GROUP BY ALL),
idfs AS (SELECT term, ln((1 + (SELECT count(*) FROM docs)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY term),
vec AS (SELECT doc_id, ('0x' || substr(md5(term), 1, 8))::BIGINT % 64 AS bucket, sum(tf * idf) AS x FROM tf JOIN idfs USING (term) GROUP BY ALL),
grid AS (SELECT doc_id, unnest(range(64))::INTEGER AS dim FROM docs WHERE clean <> '')
SELECT grid.doc_id, dim, round(coalesce(x, 0.0), 6) + 0.0 AS x FROM grid LEFT JOIN vec ON vec.doc_id = grid.doc_id AND bucket = dim""",
}
ORACLES["phrase_positions_stored"] = ORACLES["phrase_positions"]
ORACLES["ingest_observed"] = ORACLES["ingest_summary"]
ORACLES["search_log_positions"] = f"""WITH places AS ({ORACLES['phrase_positions']}),
hits AS (SELECT query_id, doc_id, max(score) AS score FROM places GROUP BY ALL),
ranked AS ({best('hits', 5)})
SELECT DISTINCT r.query_id, b.text AS query_text, rank, r.doc_id, r.score, start, stop
FROM ranked r JOIN places p ON p.query_id = r.query_id AND p.doc_id = r.doc_id JOIN benchmark b ON b.item_id = r.query_id"""

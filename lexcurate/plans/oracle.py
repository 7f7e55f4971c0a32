"""DuckDB SQL for every catalogue query: the correctness oracle.

Each string runs on DuckDB with the driver tables registered as views
(``documents``, ``orders``, ``labels``, ...). Text expressions mirror the
Spark column functions; RE2 differences are spelled out (no ``(?U)``, ``\\1``
backreferences, ``g`` flag for global replace, ``ß`` upper-cased by hand).
"""

from __future__ import annotations

from lexcurate.functions.classify import HEAD_CHARS, JUDGMENT_MIN_WORDS, PROCEDURAL_MAX_WORDS, SHORT_MAX_WORDS
from lexcurate.functions.lexicons import get_lexicon
from lexcurate.functions.text import TOKEN_PATTERN, WHITESPACE_CLASS, WHITESPACE_RUN
from lexcurate.operators import chunking
from lexcurate.operators import sentence_model as SM
from lexcurate.operators.langid import SCALE
from lexcurate.plans import indexing as IX
from lexcurate.plans import standins as SI
from lexcurate.plans.catalogue import FREQUENT, HOT_KEY, RANKS
from lexcurate.operators import quality as Q
from lexcurate.operators.metadata import ITEM_SK


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# --------------------------------------------------------------------------- text expressions

def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit('^' + WHITESPACE_RUN + '|' + WHITESPACE_RUN + '$')}, '', 'g')"


def is_blank(x: str) -> str:
    return f"coalesce({strip(x)} = '', true)"


def words(x: str) -> str:
    st = strip(f"coalesce({x}, '')")
    return f"(CASE WHEN {st} = '' THEN []::VARCHAR[] ELSE regexp_split_to_array({st}, {lit(WHITESPACE_RUN)}) END)"


def word_count(x: str) -> str:
    return f"len({words(x)})"


def letter_tokens(x: str) -> str:
    cls = lit("[^\\p{L}" + WHITESPACE_CLASS[1:-1] + "]")
    return (f"regexp_extract_all(lower(regexp_replace(coalesce({x}, ''), {cls}, '', 'g')), "
            f"{lit('[\\p{L}\\p{M}]{2,}')})")


def word_ratio(x: str) -> str:
    return (f"(SELECT CASE WHEN len(t) = 0 THEN 0.0::DOUBLE ELSE "
            f"len(list_filter(t, lambda w: length(w) >= 3 AND regexp_matches(w, '[aeiou]')))::DOUBLE "
            f"/ len(t)::DOUBLE END FROM (SELECT {letter_tokens(x)} AS t))")


def upper(x: str) -> str:
    return f"upper(replace({strip(x)}, 'ß', 'SS'))"


def token_count(x: str) -> str:
    return f"coalesce(len(regexp_extract_all({x}, {lit(TOKEN_PATTERN)})), 0)"


def sentences(x: str) -> str:
    marked = f"regexp_replace({x}, {lit('([.!?])' + WHITESPACE_RUN)}, '\\1' || chr(30), 'g')"
    return (f"list_filter(list_transform(string_split({marked}, chr(30)), lambda s: {strip('s')}), "
            f"lambda s: s <> '')")


def _head_sql(patterns: list[str]) -> str:
    return lit("|".join(f"(?:{p})" for p in patterns))


def _any_contains(up: str, phrases: list[str]) -> str:
    return "(" + " OR ".join(f"contains({up}, {lit(p)})" for p in phrases) + ")"


def doc_type(x: str, lexicon: str = "latin") -> str:
    lex = get_lexicon(lexicon)
    up, n = "__up", "__n"
    head = f"substring({up}, 1, {HEAD_CHARS})"
    case = (f"CASE WHEN regexp_matches({head}, {_head_sql(lex.judgment)}) THEN 'judgment' "
            f"WHEN regexp_matches({head}, {_head_sql(lex.order)}) THEN 'order' "
            f"WHEN {n} > {JUDGMENT_MIN_WORDS} AND {_any_contains(up, lex.reasoning)} THEN 'judgment' "
            f"WHEN {n} < {PROCEDURAL_MAX_WORDS} AND {_any_contains(up, lex.procedural)} THEN 'order' "
            f"WHEN {n} < {SHORT_MAX_WORDS} THEN 'order' ELSE 'unknown' END")
    return f"(SELECT {case} FROM (SELECT {upper(f'coalesce({x}, {chr(39) * 2})')} AS __up, {word_count(x)} AS __n))"


# --------------------------------------------------------------------------- stand-ins

def _ext(i: str, mixed: bool = False) -> str:
    text = f" WHEN {i} % 9 = 1 THEN '.txt'" if mixed else ""
    return f"(CASE WHEN {i} % 9 = 0 THEN '.PDF'{text} ELSE '.pdf' END)"


PREFIX_LIST = "[" + ", ".join(lit(p) for p in SI.PREFIXES) + "]"

LISTING = f"""
listing AS (
  SELECT 'data/pdf/year=' || CAST(1995 + doc_id % 5 AS VARCHAR) || '/court=' || source || '/bench=' || lang
         || '/' || CAST(doc_id AS VARCHAR) || {_ext('doc_id')} AS key,
         CAST(1995 + doc_id % 5 AS VARCHAR) AS year, source AS court, lang AS bench, doc_id,
         {PREFIX_LIST}[doc_id % 7 + 1] || text AS text, lang
  FROM documents
),
stage1 AS (SELECT * FROM listing WHERE lower(key) LIKE '%.pdf'),
repaired AS (
  SELECT l.key, b.text AS text, CASE WHEN l.doc_id % 2 = 0 THEN 'en' ELSE l.lang END AS lang FROM listing l JOIN benchmark b ON b.item_id = l.doc_id % {SI.REPAIR_ITEMS}
)"""


def _in_allowed(x: str, allowed: list[str]) -> str:
    return f"(coalesce({x}, '') IN ({', '.join(lit(a) for a in allowed)}))"


def document_log_cte(lexicon: str = "latin") -> str:
    allowed = Q.parse_langs(SI.TEST_ALLOWED)
    mn = SI.TEST_MIN_RATIO
    return LISTING + f""",
scored AS (
  SELECT key, year, court, bench, {word_ratio('text')} AS wr, CASE WHEN {is_blank('text')} THEN NULL ELSE lang END AS lg,
         CASE WHEN {is_blank('text')} OR lang IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS pr,
         {is_blank('text')} AS blank, {doc_type('text', lexicon)} AS doc_type
  FROM stage1
),
gated AS (
  SELECT *, ((wr < {mn} AND NOT {_in_allowed('lg', allowed)}) OR blank) AS garbled FROM scored
),
rescored AS (
  SELECT r.key, {word_ratio('r.text')} AS wr_a,
         CASE WHEN {is_blank('r.text')} THEN NULL ELSE r.lang END AS lg_a,
         CASE WHEN {is_blank('r.text')} OR r.lang IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS pr_a
  FROM repaired r WHERE r.key IN (SELECT key FROM gated WHERE garbled)
),
doclog AS (
  SELECT g.key, g.year, g.court, g.bench,
    CASE WHEN NOT g.garbled THEN '{Q.OK_NO_OCR}'
         WHEN r.key IS NULL THEN '{Q.OCR_FAILED}'
         WHEN r.wr_a >= {mn} AND {_in_allowed('r.lg_a', allowed)} THEN '{Q.OK_AFTER_OCR}'
         ELSE '{Q.STILL_GARBLED}' END AS status,
    g.wr AS word_ratio_before, g.lg AS lang_before, g.pr AS prob_before,
    CASE WHEN g.garbled AND r.key IS NOT NULL THEN r.wr_a END AS word_ratio_after,
    CASE WHEN g.garbled AND r.key IS NOT NULL THEN r.lg_a END AS lang_after,
    CASE WHEN g.garbled AND r.key IS NOT NULL THEN r.pr_a END AS prob_after,
    (g.garbled AND r.key IS NOT NULL) AS did_ocr,
    g.doc_type
  FROM gated g LEFT JOIN rescored r ON g.key = r.key
)"""


def _doclog_cte(mn: float, allowed: list[str]) -> str:
    """``doclog`` from ``gated`` (key, year, court, bench, wr, lg, pr, garbled, doc_type) and
    ``rescored`` (key, wr_a, lg_a, pr_a)."""
    return f"""
doclog AS (
  SELECT g.key, g.year, g.court, g.bench,
    CASE WHEN NOT g.garbled THEN '{Q.OK_NO_OCR}'
         WHEN r.key IS NULL THEN '{Q.OCR_FAILED}'
         WHEN r.wr_a >= {mn} AND {_in_allowed('r.lg_a', allowed)} THEN '{Q.OK_AFTER_OCR}'
         ELSE '{Q.STILL_GARBLED}' END AS status,
    g.wr AS word_ratio_before, g.lg AS lang_before, g.pr AS prob_before,
    CASE WHEN g.garbled AND r.key IS NOT NULL THEN r.wr_a END AS word_ratio_after,
    CASE WHEN g.garbled AND r.key IS NOT NULL THEN r.lg_a END AS lang_after,
    CASE WHEN g.garbled AND r.key IS NOT NULL THEN r.pr_a END AS prob_after,
    (g.garbled AND r.key IS NOT NULL) AS did_ocr,
    g.doc_type
  FROM gated g LEFT JOIN rescored r ON g.key = r.key
)"""


def _known_words_cte() -> str:
    """``known`` tokens: zipf >= 2.0 in the frequency list built from ``benchmark``."""
    return f"""
btoks AS (SELECT unnest({letter_tokens('text')}) AS token FROM benchmark),
bfreq AS (SELECT token, count(*) AS n FROM btoks GROUP BY token),
btot AS (SELECT sum(n) AS total FROM bfreq),
known AS (SELECT token FROM bfreq, btot WHERE n * 1e9 >= {10.0 ** 2.0} * total)"""


def _freq_ratio_cte(name: str, src: str) -> str:
    """``{name}`` (id, wr): known-word ratio of ``src`` (id, text)."""
    return f"""
{name}_tok AS (SELECT id, unnest({letter_tokens('text')}) AS token FROM {src}),
{name}_agg AS (SELECT id, count(*) AS total, count(*) FILTER (WHERE token IN (SELECT token FROM known)) AS good
               FROM {name}_tok GROUP BY id),
{name} AS (SELECT s.id, CASE WHEN coalesce(a.total, 0) > 0 THEN a.good::DOUBLE / a.total::DOUBLE ELSE 0.0 END AS wr
           FROM {src} s LEFT JOIN {name}_agg a ON a.id = s.id)"""


def _model_cte() -> str:
    """Trigram profiles trained on ``documents``: ``weights`` (lang, gram, w), ``base`` (lang, base)."""
    return f"""
p_norm AS (SELECT lang, ' ' || regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{M}}]+', ' ', 'g') || ' ' AS t
           FROM documents),
p_grams AS (SELECT lang, substring(t, i, 3) AS gram FROM (SELECT lang, t, unnest(range(1, length(t) - 1)) AS i FROM p_norm)),
p_prof AS (SELECT lang, gram, count(*) AS n FROM p_grams WHERE lang IS NOT NULL GROUP BY lang, gram),
base AS (SELECT lang, CAST(round(ln(sum(n) + (SELECT count(DISTINCT gram) FROM p_prof)) * {SCALE}) AS BIGINT) AS base
         FROM p_prof GROUP BY lang),
weights AS (SELECT lang, gram, CAST(round(ln(n + 1) * {SCALE}) AS BIGINT) AS w FROM p_prof)"""


def _detect_cte(name: str, src: str) -> str:
    """``{name}`` (id, lang, prob): top language of each ``src`` (id, text) row."""
    return f"""
{name}_norm AS (SELECT id, ' ' || regexp_replace(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{M}}]+', ' ', 'g') || ' ' AS t
                FROM {src}),
{name}_grams AS (SELECT id, substring(t, i, 3) AS gram
                 FROM (SELECT id, t, unnest(range(1, length(t) - 1)) AS i FROM {name}_norm)),
{name}_m AS (SELECT g.id, w.lang, sum(w.w) AS sw FROM {name}_grams g JOIN weights w ON w.gram = g.gram
             GROUP BY g.id, w.lang),
{name}_sc AS (SELECT d.id, b.lang, regexp_matches(d.t, '\\p{{L}}') AS letters,
                     coalesce(m.sw, 0) - (length(d.t) - 2) * b.base AS score
              FROM {name}_norm d CROSS JOIN base b LEFT JOIN {name}_m m ON m.id = d.id AND m.lang = b.lang),
{name}_top AS (SELECT *, max(score) OVER (PARTITION BY id) AS top FROM {name}_sc),
{name}_rk AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, lang ASC) AS rk,
                     sum(exp((score - top) / {float(SCALE)})) OVER (PARTITION BY id) AS z
              FROM {name}_top),
{name} AS (SELECT id, CASE WHEN letters THEN lang END AS lang, CASE WHEN letters THEN 1.0 / z ELSE 0.0 END AS prob
           FROM {name}_rk WHERE rk = 1)"""


def document_log_models_sql() -> str:
    allowed = Q.parse_langs(SI.TEST_ALLOWED)
    mn = SI.TEST_MIN_RATIO
    return "WITH " + LISTING.strip() + "," + _known_words_cte() + "," + _model_cte() + f""",
s1 AS (SELECT key AS id, text FROM stage1),
r1 AS (SELECT key AS id, text FROM repaired),""" + _freq_ratio_cte("s1_wr", "s1") + "," + _detect_cte("s1_det", "s1") \
        + "," + _freq_ratio_cte("r1_wr", "r1") + "," + _detect_cte("r1_det", "r1") + f""",
gated AS (
  SELECT s.key, s.year, s.court, s.bench, w.wr, d.lang AS lg, d.prob AS pr, {doc_type('s.text', 'latin')} AS doc_type,
         ((w.wr < {mn} AND NOT {_in_allowed('d.lang', allowed)}) OR {is_blank('s.text')}) AS garbled
  FROM stage1 s JOIN s1_wr w ON w.id = s.key JOIN s1_det d ON d.id = s.key
),
rescored AS (
  SELECT r.key, w.wr AS wr_a, d.lang AS lg_a, d.prob AS pr_a
  FROM repaired r JOIN r1_wr w ON w.id = r.key JOIN r1_det d ON d.id = r.key
),""" + _doclog_cte(mn, allowed) + """
SELECT key, status, word_ratio_before, lang_before, round(prob_before, 6) AS prob_before, word_ratio_after,
       lang_after, round(prob_after, 6) AS prob_after, did_ocr, doc_type
FROM doclog"""


METADATA = """
meta AS (
  SELECT COALESCE(CAST(year(o.o_orderdate) AS VARCHAR), 'None') AS year, d.source AS court_code, d.lang AS bench,
    d.doc_id,
    CASE WHEN d.doc_id % 17 = 0 THEN NULL WHEN d.doc_id % 19 = 0 THEN ''
         ELSE 'CNR' || CAST(d.doc_id // 2 AS VARCHAR) END AS cnr,
    CASE WHEN d.doc_id % 13 = 0 THEN NULL ELSE 'Case ' || CAST(d.doc_id AS VARCHAR) END AS title,
    'High Court -- ' || d.source AS court,
    CASE WHEN d.doc_id % 11 = 0 THEN NULL WHEN d.doc_id % 11 = 1 THEN ''
         WHEN d.doc_id % 11 = 2 THEN strftime(o.o_orderdate, '%d-%m-%Y')
         WHEN d.doc_id % 11 = 3 THEN CAST(year(o.o_orderdate) AS VARCHAR) || '-' || CAST(month(o.o_orderdate) AS VARCHAR)
                                     || '-' || CAST(day(o.o_orderdate) AS VARCHAR)
         ELSE strftime(o.o_orderdate, '%Y-%m-%d') END AS decision_date,
    CAST(o.o_orderdate AS DATE) AS date_of_registration,
    CASE WHEN d.doc_id % 23 = 0 THEN 'links/' || d.source || '/'
         WHEN d.doc_id % 29 = 0 THEN NULL
         ELSE 'links/' || d.source || '/' || CAST(d.doc_id AS VARCHAR) || '.pdf' END AS pdf_link,
    '<p>' || d.source || '</p>' AS raw_html,
    o.o_orderpriority AS priority
  FROM documents d LEFT JOIN orders o ON o.o_orderkey = d.doc_id
),
keyed AS (
  SELECT *, 'data/pdf/year=' || year_val || '/court=' || court_code || '/bench=' || bench || '/' || filename AS s3_key
  FROM (
    SELECT *,
      CASE WHEN decision_date IS NULL OR decision_date = '' THEN 'None'
           ELSE COALESCE(CAST(year(try_strptime(decision_date, '%Y-%m-%d')) AS VARCHAR), year) END AS year_val,
      CASE WHEN pdf_link IS NULL OR pdf_link = '' THEN 'None' ELSE regexp_extract(pdf_link, '([^/]*)$', 1) END AS filename,
      COALESCE(pdf_link IS NOT NULL AND pdf_link <> '' AND regexp_extract(pdf_link, '([^/]*)$', 1) = '', false) AS skipped
    FROM meta)
),
header AS (
  SELECT year, court_code, bench, COALESCE(replace(min(court), ' ', '-'), 'unknown-court') AS court_name
  FROM meta GROUP BY year, court_code, bench
),
objects AS (
  SELECT key, arg_min_null(text, doc_id) AS text, arg_min_null(extract_error, doc_id) AS extract_error,
         arg_min_null(fetch_error, doc_id) AS fetch_error, arg_min_null(general_error, doc_id) AS general_error
  FROM (
    SELECT k.s3_key AS key, k.doc_id,
           CASE WHEN k.doc_id % 31 = 0 THEN '' ELSE d.text END AS text,
           CASE WHEN k.doc_id % 37 = 0 THEN 'unreadable page tree' END AS extract_error,
           CASE WHEN k.doc_id % 41 = 0 THEN 'access denied' END AS fetch_error,
           CASE WHEN k.doc_id % 43 = 0 THEN 'no space left' END AS general_error
    FROM keyed k JOIN documents d ON d.doc_id = k.doc_id
    WHERE NOT k.skipped AND k.doc_id % 25 <> 7)
  GROUP BY key
)"""


def _chunk_cte(name: str, src: str, max_tokens: int, overlap: int) -> str:
    """Recursive fold over sentence indexes; ``src`` has (id, text)."""
    return f"""
{name}_sent AS (
  SELECT id, S, list_transform(S, lambda s: {token_count('s')}) AS T
  FROM (SELECT id, {sentences('text')} AS S FROM {src})
),
{name}_fold AS (
  SELECT id, 0 AS i, 0 AS s, 0::BIGINT AS n, []::STRUCT(s INTEGER, e INTEGER)[] AS b FROM {name}_sent
  UNION ALL
  SELECT f.id, f.i + 1,
    CASE WHEN f.n + x.T[f.i + 1] > {max_tokens}
         THEN list_min(list_filter(range(f.s, f.i + 1), lambda j: coalesce(list_sum(x.T[j + 1:f.i]), 0) <= {overlap}))
         ELSE f.s END,
    CASE WHEN f.n + x.T[f.i + 1] > {max_tokens}
         THEN list_sum(x.T[list_min(list_filter(range(f.s, f.i + 1),
                   lambda j: coalesce(list_sum(x.T[j + 1:f.i]), 0) <= {overlap})) + 1:f.i + 1])
         ELSE f.n + x.T[f.i + 1] END,
    CASE WHEN f.n + x.T[f.i + 1] > {max_tokens}
         THEN list_append(f.b, {{'s': f.s::INTEGER, 'e': (f.i - 1)::INTEGER}})
         ELSE f.b END
  FROM {name}_fold f JOIN {name}_sent x ON f.id = x.id
  WHERE f.i < len(x.T)
),
{name}_bounds AS (
  SELECT x.id, x.S,
    CASE WHEN len(x.T) > 0 THEN list_append(f.b, {{'s': f.s::INTEGER, 'e': (len(x.T) - 1)::INTEGER}}) ELSE f.b END AS b
  FROM {name}_fold f JOIN {name}_sent x ON f.id = x.id AND f.i = len(x.T)
),
{name} AS (
  SELECT id, CAST(chunk_id AS INTEGER) AS chunk_id, array_to_string(S[bd.s + 1:bd.e + 1], ' ') AS content
  FROM (SELECT id, S, unnest(b) AS bd, generate_subscripts(b, 1) - 1 AS chunk_id FROM {name}_bounds)
)"""


def _embed_rows(src: str, dim: int) -> str:
    """(id, chunk_id, bucket, value) of the hashed embedding of ``src`` (id, chunk_id, content)."""
    return f"""
emb_tok AS (
  SELECT id, chunk_id, unnest(regexp_extract_all(content, {lit(TOKEN_PATTERN)})) AS tok FROM {src}
),
emb_cnt AS (
  SELECT id, chunk_id, (('0x' || substr(md5(tok), 1, 8))::BIGINT % {dim})::INTEGER AS bucket, count(*) AS c
  FROM emb_tok GROUP BY ALL
),
emb AS (
  SELECT id, chunk_id, bucket,
         round(CAST(CAST(c / sqrt(sum(c * c) OVER (PARTITION BY id, chunk_id)) AS FLOAT) AS DOUBLE), 6) AS value
  FROM emb_cnt
)"""


def stage2_cte(meta_where: str = "") -> str:
    mx, ov = chunking.DEFAULT_MAX_TOKENS, chunking.DEFAULT_OVERLAP
    return "WITH RECURSIVE " + METADATA.strip() + f""",
active AS (SELECT * FROM keyed WHERE NOT skipped {meta_where}),
looked AS (
  SELECT a.*, h.court_name, o.text AS otext, o.extract_error, o.general_error, o.key IS NOT NULL AS found,
    CASE WHEN o.key IS NULL THEN '{IX.KEY_NOT_FOUND}'
         WHEN o.fetch_error IS NOT NULL THEN '{IX.FETCH_ERROR}'
         WHEN o.extract_error IS NOT NULL THEN '{IX.EXTRACTION_ERROR}'
         WHEN {is_blank('o.text')} THEN '{IX.EMPTY_TEXT}'
         WHEN o.general_error IS NOT NULL THEN '{IX.GENERAL_ERROR}'
         ELSE '{IX.SUCCESS}' END AS outcome
  FROM active a LEFT JOIN objects o ON o.key = a.s3_key
  LEFT JOIN header h ON h.year = a.year AND h.court_code = a.court_code AND h.bench = a.bench
),
okdocs AS (SELECT doc_id AS id, otext AS text FROM looked WHERE outcome = '{IX.SUCCESS}'),
""" + _chunk_cte("s2chunks", "okdocs", mx, ov).strip() + f""",
s2tok AS (
  SELECT id, chunk_id, len(regexp_extract_all(content, {lit(TOKEN_PATTERN)})) AS ntok FROM s2chunks
),
docstats AS (
  SELECT l.*, CASE WHEN outcome = '{IX.SUCCESS}' THEN {token_count('l.otext')} END AS token_count,
         CASE WHEN outcome = '{IX.SUCCESS}' THEN coalesce(c.n, 0) END AS chunk_count,
         CASE WHEN outcome = '{IX.SUCCESS}' THEN coalesce(c.nerr, 0) ELSE 0 END AS emb_err,
         COALESCE(l.cnr <> '', false) AS has_cnr,
         CASE WHEN outcome = '{IX.SUCCESS}' THEN coalesce((
           SELECT count(*) FROM s2tok t WHERE t.id = l.doc_id AND t.ntok > 0 AND (length(l.s3_key) + t.chunk_id) % 11 = 0), 0)
           ELSE 0 END AS refused,
         CASE WHEN outcome = '{IX.EXTRACTION_ERROR}' THEN l.extract_error
              WHEN outcome = '{IX.FETCH_ERROR}' THEN 'Key not found: ' || l.s3_key
              WHEN outcome = '{IX.GENERAL_ERROR}' THEN l.general_error
              WHEN outcome = '{IX.EMPTY_TEXT}' THEN '{IX.EMPTY_TEXT_MESSAGE}' END AS error_message
  FROM looked l LEFT JOIN (SELECT id, count(*) AS n, count(*) FILTER (WHERE ntok = 0) AS nerr FROM s2tok GROUP BY id) c
    ON c.id = l.doc_id
),
runstats AS (
  SELECT year, court_code, bench, court_name,
    count(*) AS total_documents_attempted,
    count(*) FILTER (WHERE outcome = '{IX.SUCCESS}') AS successful_documents,
    count(*) FILTER (WHERE outcome IN {IX.FAILURES}) AS failed_documents,
    count(*) FILTER (WHERE outcome = '{IX.EMPTY_TEXT}') AS empty_text_documents,
    count(*) FILTER (WHERE outcome = '{IX.KEY_NOT_FOUND}') AS keys_not_found,
    count(*) FILTER (WHERE outcome = '{IX.EXTRACTION_ERROR}') AS pdf_extraction_errors,
    CAST(sum(emb_err) AS BIGINT) AS embedding_generation_errors,
    count(*) FILTER (WHERE outcome = '{IX.SUCCESS}' AND NOT has_cnr) AS dynamodb_write_errors,
    CAST(sum(refused) AS BIGINT) AS s3_upload_errors,
    avg(token_count) AS avg_tokens_per_document, CAST(sum(token_count) AS BIGINT) AS total_tokens,
    min(token_count) AS min_tokens, max(token_count) AS max_tokens,
    avg(chunk_count) AS avg_chunks_per_document, CAST(sum(chunk_count) AS BIGINT) AS total_chunks
  FROM docstats GROUP BY year, court_code, bench, court_name
),
vectors AS (
  SELECT lower(replace(l.court_name, '--', '-')) AS index_name,
         coalesce(l.cnr, 'None') || '_chunk_' || CAST(c.chunk_id AS VARCHAR) AS key,
         l.s3_key, l.cnr, l.title, l.year, c.content, l.decision_date, t.ntok, l.doc_id, c.chunk_id,
         coalesce(CAST(try_strptime(l.decision_date, '%Y-%m-%d') AS DATE), DATE '0001-01-01') AS udate
  FROM docstats l JOIN s2chunks c ON c.id = l.doc_id JOIN s2tok t ON t.id = c.id AND t.chunk_id = c.chunk_id
  WHERE l.outcome = '{IX.SUCCESS}' AND l.has_cnr AND t.ntok > 0
),
items AS (
  SELECT cnr AS pk, '{ITEM_SK}' AS sk, s3_key, doc_id, title, court, decision_date,
         strftime(date_of_registration, '%Y-%m-%d') AS date_of_registration, pdf_link, priority, year, court_code, bench,
         coalesce(CAST(try_strptime(decision_date, '%Y-%m-%d') AS DATE), DATE '0001-01-01') AS udate
  FROM docstats WHERE outcome = '{IX.SUCCESS}'
)"""


RUN = "year, court_code, bench, court_name"

_ITEM_COLS = "pk, sk, s3_key, doc_id, title, court, decision_date, date_of_registration, pdf_link, priority, year, court_code, bench"


def _x_log_y(x: str, y: str) -> str:
    return f"(CASE WHEN ({x}) = 0 THEN 0.0 ELSE ({x}) * ln({y}) END)"


def _association(a: str, b: str, both: str, n: str) -> str:
    p, p1, p2 = f"({b}) * 1.0 / ({n})", f"({both}) * 1.0 / ({a})", f"(({b}) - ({both})) * 1.0 / (({n}) - ({a}))"
    rest = f"({n}) - ({a}) - ({b}) + ({both})"
    left, right = f"({a}) - ({both})", f"({b}) - ({both})"
    apart = [_x_log_y(both, p), _x_log_y(left, f"1 - {p}"), _x_log_y(right, p), _x_log_y(rest, f"1 - {p}")]
    joint = [_x_log_y(both, p1), _x_log_y(left, f"1 - {p1}"), _x_log_y(right, p2), _x_log_y(rest, f"1 - {p2}")]
    return f"(-2.0 * (({' + '.join(apart)}) - ({' + '.join(joint)})))"


def _word_type(w: str) -> str:
    core = f"lower(regexp_replace({w}, {lit(SM._HEAD)}, ''))"
    return f"(CASE WHEN suffix({core}, '.') THEN substring({core}, 1, length({core}) - 1) ELSE regexp_replace({core}, {lit(SM._TAIL)}, '') END)"


def _stopped(w: str) -> str:
    return f"suffix(lower(regexp_replace({w}, {lit(SM._HEAD)}, '')), '.')"


def sentence_model_cte() -> str:
    letters = "length(replace(token, '.', ''))"
    p = "(t.stops * 1.0 / t.total)"
    return f"""
sm_words AS (SELECT unnest(list_transform(range(1, len(W) + 1), lambda i: {{'word': W[i], 'following': W[i + 1]}})) AS p
             FROM (SELECT {words('text')} AS W FROM documents)),
sm_typed AS (SELECT {_word_type('p.word')} AS token, {_stopped('p.word')} AS stopped, regexp_matches(p.word, '[.!?]$') AS ends,
                    {_word_type('p.following')} AS following FROM sm_words),
sm_pairs AS (SELECT token, stopped, ends, CASE WHEN stopped OR ends THEN following END AS following, count(*) AS n FROM sm_typed GROUP BY ALL),
sm_types AS (SELECT token, sum(n) AS n, coalesce(sum(n) FILTER (WHERE stopped), 0) AS n_stopped FROM sm_pairs GROUP BY token),
sm_total AS (SELECT sum(n) AS total, sum(n_stopped) AS stops FROM sm_types),
sm_abbr AS (SELECT * FROM (
  SELECT token, n_stopped AS n, -2.0 * (n_stopped * ln({p}) + (n - n_stopped) * ln(1 - {p}) - n_stopped * ln({SM.EXPECTED}) - (n - n_stopped) * ln(1 - {SM.EXPECTED}))
         * exp(-{letters}) * (length(token) - {letters} + 1) * pow({letters}, -(n - n_stopped)) AS score
  FROM sm_types, sm_total t WHERE regexp_matches(token, {lit(SM.SHAPE)}) AND n_stopped >= {SM.LEAST_SEEN}) WHERE score >= {SM.ABBREVIATION}),
sm_after AS (SELECT following, sum(n) AS n_both FROM sm_pairs
             WHERE ends AND regexp_matches(following, {lit(SM.WORD)}) AND NOT (stopped AND token IN (SELECT token FROM sm_abbr)) GROUP BY following),
sm_ends AS (SELECT sum(n_both) AS n_ends FROM sm_after),
sm_start AS (SELECT * FROM (
  SELECT a.following AS token, a.n_both AS n, {_association('e.n_ends', 'o.n', 'a.n_both', 't.total')} AS score
  FROM sm_after a JOIN sm_types o ON o.token = a.following, sm_total t, sm_ends e
  WHERE a.n_both * t.total > o.n * e.n_ends) WHERE score >= {SM.STARTER}),
sm_two AS (SELECT token, following, sum(n) AS n_both FROM sm_pairs WHERE stopped AND regexp_matches(token, {lit(SM.ORDINAL)})
             AND regexp_matches(following, {lit(SM.WORD)}) GROUP BY token, following HAVING sum(n) >= {SM.LEAST_SEEN}),
sm_coll AS (SELECT * FROM (
  SELECT w.token, w.following, w.n_both AS n, {_association('f.n_stopped', 'o.n', 'w.n_both', 't.total')} AS score
  FROM sm_two w JOIN sm_types f ON f.token = w.token JOIN sm_types o ON o.token = w.following, sm_total t
  WHERE w.n_both * t.total > o.n * f.n_stopped AND w.following NOT IN (SELECT token FROM sm_start)) WHERE score >= {SM.COLLOCATION})"""


def _metadata_parts() -> tuple[str, str, str, str]:
    """Text before ``keyed``, and the bodies of ``keyed``, ``header`` and ``objects``."""
    head, rest = METADATA.strip().split("keyed AS (", 1)
    keyed, rest = rest.split("header AS (", 1)
    return head, keyed, *rest.split("objects AS (", 1)


def hot_metadata() -> str:
    """The metadata CTEs where a third of the records name one object, which is the first of ``benchmark``."""
    head, keyed, header, objects = _metadata_parts()
    hot = "doc_id % 3 = 0"
    fixed = {"year": "'2000'", "court_code": "'hot'", "bench": "'hot'", "decision_date": "'2000-01-01'", "pdf_link": "NULL"}
    columns = ", ".join(f"CASE WHEN {hot} THEN {v} ELSE {c} END AS {c}" for c, v in fixed.items())
    return (head.replace("meta AS (", "plain_meta AS (", 1) + "plain_keyed AS (" + keyed.replace("FROM meta)", "FROM plain_meta)")
            + f"meta AS (SELECT * REPLACE ({columns}) FROM plain_meta),\nkeyed AS (" + keyed + "header AS (" + header
            + "plain_objects AS (" + objects.replace("FROM keyed k", "FROM plain_keyed k") + f""",
objects AS (SELECT * FROM plain_objects UNION ALL BY NAME
            SELECT {lit(HOT_KEY)} AS key, arg_min(text, item_id) AS text FROM benchmark)""")


def mixed_metadata() -> str:
    """The metadata CTEs where years divisible by 4 type ``decision_date`` as a date, those after them as a timestamp, and
    those before them lack ``priority``. The objects are those of the plain records."""
    head, keyed, header, objects = _metadata_parts()
    kind = "coalesce(TRY_CAST(m.year AS INTEGER) % 4, 2)"
    day = "CAST(try_strptime(m.decision_date, '%Y-%m-%d') AS DATE)"
    mixed = f"""meta AS (
  SELECT m.* EXCLUDE (decision_date, priority),
         CASE {kind} WHEN 0 THEN strftime({day}, '%Y-%m-%d')
              WHEN 1 THEN strftime(CAST({day} AS TIMESTAMP) + to_hours(CAST(m.doc_id % 24 AS INTEGER)), '%Y-%m-%dT%H:%M:%S')
              ELSE m.decision_date END AS decision_date,
         CASE WHEN {kind} <> 3 THEN m.priority END AS priority
  FROM plain_meta m
),
"""
    typed = "CAST(year(try_strptime(decision_date, '%Y-%m-%dT%H:%M:%S')) AS VARCHAR)"
    return (head.replace("meta AS (", "plain_meta AS (", 1) + "plain_keyed AS (" + keyed.replace("FROM meta)", "FROM plain_meta)")
            + mixed + "keyed AS (" + keyed.replace("AS VARCHAR), year) END AS year_val", f"AS VARCHAR), {typed}, year) END AS year_val")
            + "header AS (" + header + "objects AS (" + objects.replace("FROM keyed k", "FROM plain_keyed k"))


def queries_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["scan_partition"] = "WITH " + LISTING.strip().replace(_ext("doc_id"), _ext("doc_id", mixed=True)) + """
SELECT key, year, court, bench, 'data/pdf/year=' || year || '/court=' || court || '/' AS prefix,
       lower(key) LIKE '%.pdf' AS is_pdf FROM listing"""
    q["store_scan"] = "WITH " + LISTING.strip().replace(_ext("doc_id"), _ext("doc_id", mixed=True)) + """
SELECT doc_id, year, court, bench, 'pdf' AS kind, text FROM stage1 WHERE CAST(year AS INTEGER) BETWEEN 1996 AND 1998"""
    for name, lex in (("doc_type_latin", "latin"), ("doc_type_multi", "multi")):
        q[name] = "WITH " + LISTING.strip() + f"\nSELECT key, {doc_type('text', lex)} AS doc_type FROM stage1"
    allowed = Q.parse_langs(SI.TEST_ALLOWED)
    q["garble_gate"] = "WITH " + LISTING.strip() + f"""
SELECT key, wr AS word_ratio, lang, blank, ((wr < {SI.TEST_MIN_RATIO} AND NOT {_in_allowed('lang', allowed)}) OR blank) AS garbled
FROM (SELECT key, lang, {word_ratio('text')} AS wr, {is_blank('text')} AS blank FROM stage1)"""
    log = "WITH " + document_log_cte().strip()
    q["document_log"] = log + """
SELECT key, status, word_ratio_before, lang_before, prob_before, word_ratio_after, lang_after, prob_after, did_ocr, doc_type
FROM doclog"""
    q["document_log_multi"] = "WITH " + document_log_cte("multi").strip() + """
SELECT key, status, word_ratio_before, lang_before, prob_before, word_ratio_after, lang_after, prob_after, did_ocr, doc_type
FROM doclog"""
    q["document_log_models"] = document_log_models_sql()
    q["document_log_stream"] = q["document_log"]  # the stream must equal the batch log
    q["repair_status"] = log + "\nSELECT status, did_ocr, count(*) AS n_docs FROM doclog GROUP BY status, did_ocr"
    q["curated"] = log + f"""
SELECT key, year, court, bench, status FROM doclog
WHERE doc_type = 'judgment' AND status IN ('{Q.OK_NO_OCR}', '{Q.OK_AFTER_OCR}')"""

    q["word_ratio"] = f"SELECT doc_id, {word_ratio('text')} AS word_ratio, {word_count('text')} AS word_count FROM documents"
    q["token_count"] = f"SELECT doc_id, {token_count('text')} AS token_count FROM documents"
    q["sentences"] = f"""
SELECT doc_id, sentence_no, sentence, {token_count('sentence')} AS tokens FROM (
  SELECT doc_id, unnest(S) AS sentence, CAST(generate_subscripts(S, 1) - 1 AS INTEGER) AS sentence_no
  FROM (SELECT doc_id, {sentences('text')} AS S FROM documents))"""
    q["sentence_model"] = "WITH " + sentence_model_cte().strip() + """
SELECT 'abbreviation' AS kind, token, NULL::VARCHAR AS following, CAST(n AS BIGINT) AS n, round(score, 3) AS score FROM sm_abbr
UNION ALL SELECT 'starter', token, NULL, CAST(n AS BIGINT), round(score, 3) FROM sm_start
UNION ALL SELECT 'collocation', token, following, CAST(n AS BIGINT), round(score, 3) FROM sm_coll"""
    space = WHITESPACE_CLASS[1:-1]
    q["sentences_trained"] = "WITH " + sentence_model_cte().strip() + f""",
pieces AS (
  SELECT doc_id, unnest(P) AS piece, unnest(list_append(P[2:], NULL)) AS after, generate_subscripts(P, 1) AS i
  FROM (SELECT doc_id, string_split(regexp_replace(text, {lit('([.!?])(' + WHITESPACE_RUN + ')')}, '\\1' || chr(30) || '\\2', 'g'), chr(30)) AS P FROM documents)
),
ends AS (SELECT doc_id, i, piece, after, regexp_extract(piece, {lit('([^' + space + ']+)$')}, 1) AS word,
                regexp_extract(after, {lit('[^' + space + ']+')}) AS following FROM pieces),
typed AS (SELECT *, {_word_type('word')} AS a, {_word_type('following')} AS b FROM ends),
cut AS (SELECT doc_id, i, piece,
          CASE WHEN after IS NULL OR {_stopped('word')} AND (
                 a IN (SELECT token FROM sm_abbr) AND b NOT IN (SELECT token FROM sm_start)
                 OR (a, b) IN (SELECT (token, following) FROM sm_coll)) THEN 0 ELSE 1 END AS cut FROM typed),
numbered AS (SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s FROM cut),
whole AS (SELECT doc_id, s, string_agg(piece, '' ORDER BY i) AS sentence FROM numbered GROUP BY doc_id, s),
trimmed AS (SELECT doc_id, s, {strip('sentence')} AS sentence FROM whole)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY s) - 1 AS INTEGER) AS sentence_no, sentence FROM trimmed WHERE sentence <> ''"""
    chunks_cte = "WITH RECURSIVE src AS (SELECT doc_id AS id, text FROM documents)," + _chunk_cte(
        "ch", "src", SI.TEST_CHUNK_MAX, SI.TEST_CHUNK_OVERLAP)
    q["chunks"] = chunks_cte + "\nSELECT id AS doc_id, chunk_id, content FROM ch"
    q["chunk_embedding"] = chunks_cte + "," + _embed_rows("ch", SI.TEST_EMBED_DIM) + """
SELECT id AS doc_id, chunk_id, bucket, value FROM emb"""
    q["pages_newline"] = """
SELECT conv_id AS doc_key, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (WHERE text <> ''), '') AS text
FROM conversations GROUP BY conv_id"""
    q["pages_concat"] = """
SELECT conv_id AS doc_key, string_agg(coalesce(text, ''), '' ORDER BY turn) AS text
FROM conversations GROUP BY conv_id"""
    freq = f"""WITH toks AS (SELECT unnest({letter_tokens('text')}) AS token FROM benchmark),
freq AS (SELECT token, count(*) AS n FROM toks GROUP BY token),
tot AS (SELECT sum(n) AS total FROM freq)"""
    q["word_freq"] = freq + "\nSELECT token, n, round(log10(n / total * 1e9), 6) AS zipf FROM freq, tot"
    q["frequent_words"] = freq.replace("FROM benchmark", "FROM documents") + f"""
SELECT token, n, round(log10(n / total * 1e9), 6) AS zipf, CAST(total AS BIGINT) AS total FROM freq, tot WHERE n * 1e9 >= {10.0 ** FREQUENT} * total"""
    q["word_ratio_freq"] = freq + f""",
known AS (SELECT token FROM freq, tot WHERE n * 1e9 >= {10.0 ** 2.0} * total),
dt AS (SELECT doc_id, unnest({letter_tokens('text')}) AS token FROM documents),
agg AS (SELECT doc_id, count(*) AS total, count(*) FILTER (WHERE token IN (SELECT token FROM known)) AS good
        FROM dt GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN coalesce(a.total, 0) > 0 THEN a.good::DOUBLE / a.total::DOUBLE ELSE 0.0 END AS word_ratio
FROM documents d LEFT JOIN agg a ON a.doc_id = d.doc_id"""
    model = "WITH " + _model_cte().strip()
    q["lang_profiles"] = model + "\nSELECT lang, gram, n FROM p_prof"
    q["detect_language"] = model + ",\nsrc AS (SELECT doc_id AS id, text FROM documents)," + \
        _detect_cte("det", "src") + "\nSELECT id AS doc_id, lang, round(prob, 6) AS prob FROM det"

    back = """
SELECT key, status, word_ratio_before, lang_before, word_ratio_after, lang_after, did_ocr, doc_type, year AS log_year FROM doclog"""
    number = "CAST(regexp_extract(key, '/([0-9]+)[.][^/.]*$', 1) AS BIGINT)"
    cut = f"(year <> '1995' AND {number} % 100 = 3)"
    q["log_roundtrip"] = log + back
    q["log_read"] = log + back + f" WHERE NOT {cut}"
    # a record begins with its key and status: what is left of a cut line
    q["log_rejects"] = log + f"""
SELECT substring('{{"key":"' || key || '","status":"' || status || '"', 1, 60) AS line FROM doclog WHERE {cut}"""
    gone, denied = f"{number} % 41 = 0", f"{number} % 13 < 5"
    copied = f"doc_type = 'judgment' AND status IN ('{Q.OK_NO_OCR}', '{Q.OK_AFTER_OCR}')"
    q["failure_statuses"] = log + f"""
SELECT key, CASE WHEN {gone} THEN '{Q.DOWNLOAD_FAILED}gone' WHEN {copied} AND {denied} THEN '{Q.UPLOAD_FAILED}denied' ELSE status END AS status,
       CASE WHEN NOT {gone} THEN word_ratio_before END AS word_ratio_before, CASE WHEN NOT {gone} THEN lang_before END AS lang_before,
       did_ocr AND NOT {gone} AS did_ocr, CASE WHEN NOT {gone} THEN doc_type END AS doc_type FROM doclog"""
    q["log_backfill"] = log + """
SELECT key, status, word_ratio_before, lang_before, did_ocr, doc_type, year, court FROM doclog"""
    q["curated_copy"] = log + f"""
SELECT d.key, d.year, d.court, d.bench, CASE WHEN d.did_ocr THEN r.text ELSE s.text END AS text
FROM doclog d JOIN stage1 s ON s.key = d.key LEFT JOIN repaired r ON r.key = d.key
WHERE d.doc_type = 'judgment' AND d.status IN ('{Q.OK_NO_OCR}', '{Q.OK_AFTER_OCR}')"""
    refused = "('0x' || substr(md5(key), 1, 8))::BIGINT % 7 < 3"
    q["uploads_refused"] = log + f"""
SELECT key, CASE WHEN {copied} AND {refused} THEN '{Q.UPLOAD_FAILED}denied ' || year ELSE status END AS status, doc_type,
       {copied} AND NOT {refused} AS stored FROM doclog"""
    of_run = f"CASE WHEN {number.replace('key', 'd.key')} % 2 = 0 THEN 'second' ELSE 'first' END"
    q["curated_after_two_runs"] = q["curated_copy"].replace("ELSE s.text END AS text", f"ELSE s.text END AS text, {of_run} AS content", 1) \
        + f" AND ({number.replace('key', 'd.key')} % 2 = 0 OR {number.replace('key', 'd.key')} % 3 <> 0)"

    meta = "WITH " + METADATA.strip()
    q["object_key"] = meta + "\nSELECT doc_id, year, court_code, bench, year_val, filename, s3_key FROM keyed WHERE NOT skipped"
    q["object_key_skip"] = meta + "\nSELECT doc_id, pdf_link FROM keyed WHERE skipped"
    q["court_index_name"] = meta + """
SELECT year, court_code, bench, court_name, replace(replace(court_name, '--', '-'), ' ', '-') AS court_path,
       lower(replace(court_name, '--', '-')) AS index_name FROM header"""
    q["objects_found"] = meta + "\nSELECT doc_id, s3_key FROM keyed WHERE NOT skipped AND s3_key IN (SELECT key FROM objects)"
    q["keys_not_found"] = meta + "\nSELECT doc_id, s3_key FROM keyed WHERE NOT skipped AND s3_key NOT IN (SELECT key FROM objects)"

    s2 = stage2_cte()
    q["vector_records"] = s2 + "," + _embed_rows("(SELECT id, chunk_id, content FROM s2chunks)", SI.TEST_EMBED_DIM) + """
SELECT v.index_name, v.key, v.s3_key, v.cnr, v.title, v.year, v.content,
       (SELECT count(*) FROM emb e WHERE e.id = v.doc_id AND e.chunk_id = v.chunk_id AND e.value <> 0) AS nonzero
FROM vectors v"""
    q["vectors_from_store"] = q["vector_records"]
    q["vector_upsert"] = s2 + """
SELECT index_name, key, arg_max_null(s3_key, (udate, s3_key)) AS s3_key, arg_max_null(content, (udate, s3_key)) AS content
FROM vectors GROUP BY index_name, key"""
    q["metadata_items"] = s2 + f"\nSELECT {_ITEM_COLS} FROM items WHERE coalesce(pk <> '', false)"
    q["metadata_rejects"] = s2 + f"\nSELECT {_ITEM_COLS} FROM items WHERE NOT coalesce(pk <> '', false)"
    q["metadata_upsert"] = s2 + f"""
SELECT pk, sk, {', '.join(f'arg_max_null({c}, (udate, s3_key)) AS {c}' for c in _ITEM_COLS.split(', ')[2:])}
FROM items WHERE coalesce(pk <> '', false) GROUP BY pk, sk"""
    batch = "coalesce(TRY_CAST(regexp_extract(s3_key, '/([0-9]+)[.][^/.]*$', 1) AS BIGINT) % 3 = 0, false)"
    q["vectors_after_two_batches"] = s2 + f"""
SELECT index_name, key, arg_max_null(s3_key, ({batch}, udate, s3_key)) AS s3_key,
       arg_max_null(content, ({batch}, udate, s3_key)) AS content
FROM vectors GROUP BY index_name, key"""
    q["items_after_two_batches"] = s2 + f"""
SELECT pk, sk, {', '.join(f'arg_max_null({c}, ({batch}, udate, s3_key)) AS {c}' for c in _ITEM_COLS.split(', ')[2:])}
FROM items WHERE coalesce(pk <> '', false) GROUP BY pk, sk"""
    q["two_runs_one_root"] = s2 + """
SELECT year, count(*) AS runs, CAST(sum(total_documents_attempted) AS BIGINT) AS attempted,
       CAST(sum(successful_documents) AS BIGINT) AS successful, CAST(sum(total_chunks) AS BIGINT) AS chunks
FROM runstats GROUP BY year"""
    q["run_counts"] = s2 + f"""
SELECT {RUN}, total_documents_attempted, successful_documents, failed_documents, empty_text_documents, keys_not_found
FROM runstats"""
    q["error_counts"] = s2 + f"""
SELECT {RUN}, pdf_extraction_errors, embedding_generation_errors, dynamodb_write_errors, s3_upload_errors FROM runstats"""
    q["success_rate"] = s2 + f"""
SELECT {RUN}, round(CASE WHEN total_documents_attempted - keys_not_found > 0
  THEN successful_documents / (total_documents_attempted - keys_not_found) * 100.0 END, 9) AS success_rate_percent
FROM runstats"""
    q["token_stats"] = s2 + f"""
SELECT {RUN}, round(avg_tokens_per_document, 9) AS avg_tokens_per_document, total_tokens, min_tokens, max_tokens
FROM runstats"""
    q["chunk_stats"] = s2 + f"\nSELECT {RUN}, round(avg_chunks_per_document, 9) AS avg_chunks_per_document, total_chunks FROM runstats"
    q["document_counts"] = s2 + f"""
SELECT {RUN}, s3_key, token_count, chunk_count FROM docstats WHERE outcome = '{IX.SUCCESS}'"""
    q["count_distributions"] = s2 + f"""
SELECT court_code, CAST(rank AS DOUBLE) AS rank, n, true AS within_error
FROM (SELECT court_code, count(*) AS n FROM docstats WHERE outcome = '{IX.SUCCESS}' GROUP BY court_code), (SELECT unnest({RANKS}) AS rank)"""
    q["titles"] = s2 + f"\nSELECT {RUN}, s3_key, title FROM docstats WHERE outcome = '{IX.SUCCESS}'"
    q["titles_sink"] = s2 + f"""
SELECT replace(replace(court_name, '--', '-'), ' ', '-') AS court_path, court_code, year, bench, s3_key, title
FROM docstats WHERE outcome = '{IX.SUCCESS}'"""
    q["run_times"] = s2 + """
SELECT coalesce(TRY_CAST(year AS INTEGER) <= 1996, false) AS early, 1 AS ids, 1 AS starts, count(*) AS runs, true AS end_after_start, true AS dated
FROM runstats GROUP BY 1"""
    q["failed_files"] = s2 + f"""
SELECT {RUN}, s3_key, filename, outcome AS error, error_message FROM docstats
WHERE outcome IN {IX.FAILURES}"""
    q["lookup_hot_key"] = stage2_cte().replace(METADATA.strip(), hot_metadata(), 1) + """
SELECT doc_id, s3_key, outcome, token_count, chunk_count FROM docstats"""
    q["metadata_mixed"] = "WITH " + mixed_metadata() + """
SELECT doc_id, year, court_code, bench, cnr, decision_date, date_of_registration, priority, year_val, s3_key FROM keyed"""
    numeric = "TRY_CAST(year AS INTEGER) IS NOT NULL"
    q["years_with_broken_file"] = stage2_cte().replace(METADATA.strip(), mixed_metadata(), 1) + f""",
parts AS (SELECT year, court_code, bench, count(*) AS records FROM meta WHERE {numeric} GROUP BY ALL),
first_part AS (SELECT year, court_code, bench FROM parts ORDER BY year, court_code, bench LIMIT 1)
SELECT p.year, p.court_code, p.bench, CASE WHEN f.year IS NULL THEN 'finished' ELSE 'failed' END AS state,
       CASE WHEN f.year IS NULL THEN p.records END AS records,
       CASE WHEN f.year IS NULL THEN r.total_documents_attempted END AS total_documents_attempted,
       CASE WHEN f.year IS NULL THEN r.successful_documents END AS successful_documents,
       CASE WHEN f.year IS NULL THEN coalesce(r.total_chunks, 0) ELSE 0 END AS total_chunks
FROM parts p LEFT JOIN first_part f USING (year, court_code, bench) LEFT JOIN runstats r USING (year, court_code, bench)"""
    q["year_range_run"] = stage2_cte("AND TRY_CAST(year AS INTEGER) BETWEEN 1994 AND 1996") + f"""
SELECT {RUN}, total_documents_attempted, successful_documents, total_chunks FROM runstats"""
    return q

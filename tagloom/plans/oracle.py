"""Independent DuckDB SQL for the registered queries (the correctness oracle).

The driver registers the parquet tables as views; every statement here starts
from them. ``POSTS`` re-derives the posts fixture and ``QUESTIONS`` the ETL,
written directly in DuckDB's dialect (not generated from the Spark plans).
"""

from __future__ import annotations


# --- fixed values: Spark's default English stop-word list (181 words), in its order ---
ENGLISH_STOP_WORDS = [
    'i', 'me', 'my', 'myself', 'we', 'our', 'ours', 'ourselves', 'you', 'your', 'yours',
    'yourself', 'yourselves', 'he', 'him', 'his', 'himself', 'she', 'her', 'hers',
    'herself', 'it', 'its', 'itself', 'they', 'them', 'their', 'theirs', 'themselves',
    'what', 'which', 'who', 'whom', 'this', 'that', 'these', 'those', 'am', 'is', 'are',
    'was', 'were', 'be', 'been', 'being', 'have', 'has', 'had', 'having', 'do', 'does',
    'did', 'doing', 'a', 'an', 'the', 'and', 'but', 'if', 'or', 'because', 'as', 'until',
    'while', 'of', 'at', 'by', 'for', 'with', 'about', 'against', 'between', 'into',
    'through', 'during', 'before', 'after', 'above', 'below', 'to', 'from', 'up', 'down',
    'in', 'out', 'on', 'off', 'over', 'under', 'again', 'further', 'then', 'once', 'here',
    'there', 'when', 'where', 'why', 'how', 'all', 'any', 'both', 'each', 'few', 'more',
    'most', 'other', 'some', 'such', 'no', 'nor', 'not', 'only', 'own', 'same', 'so',
    'than', 'too', 'very', 's', 't', 'can', 'will', 'just', 'don', 'should', 'now', "i'll",
    "you'll", "he'll", "she'll", "we'll", "they'll", "i'd", "you'd", "he'd", "she'd",
    "we'd", "they'd", "i'm", "you're", "he's", "she's", "it's", "we're", "they're", "i've",
    "we've", "you've", "they've", "isn't", "aren't", "wasn't", "weren't", "haven't",
    "hasn't", "hadn't", "don't", "doesn't", "didn't", "won't", "wouldn't", "shan't",
    "shouldn't", "mustn't", "can't", "couldn't", 'cannot', 'could', "here's", "how's",
    "let's", 'ought', "that's", "there's", "what's", "when's", "where's", "who's", "why's",
    'would',
]

POSTS = """
posts AS (
  SELECT
    CAST(d.doc_id AS VARCHAR) AS _Id,
    CASE WHEN d.doc_id % 5 = 0 THEN '2' ELSE '1' END AS _PostTypeId,
    strftime(DATE '2018-01-01' + CAST(d.doc_id % 900 AS INTEGER), '%Y-%m-%d') || 'T21:42:52.667'
      AS _CreationDate,
    CAST(d.n_chars AS VARCHAR) AS _Score,
    CASE WHEN d.lang = 'de' THEN 'n/a'
         ELSE CAST(length(split_part(d.text, chr(10), 1)) AS VARCHAR) END AS _ViewCount,
    d.text AS _Body,
    d.source AS _OwnerDisplayName,
    strftime(DATE '2018-01-01' + CAST(d.doc_id % 900 AS INTEGER), '%Y-%m-%d') || 'T21:42:52.667'
      AS _LastActivityDate,
    split_part(d.text, chr(10), 1) AS _Title,
    '<' || d.lang || '><' || d.source || '>'
      || CASE WHEN l.quality = 1 THEN '<Quality>' ELSE '' END
      || CASE WHEN l.toxic = 1 THEN '<Toxic>' ELSE '' END AS _Tags
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
)"""

QUESTIONS = POSTS + """,
questions AS (
  SELECT
    CAST(_Id AS BIGINT) AS Id,
    CAST(try_strptime(_CreationDate, '%Y-%m-%dT%H:%M:%S.%g') AS DATE) AS CreationDate,
    TRY_CAST(_Score AS INTEGER) AS Score,
    TRY_CAST(_ViewCount AS INTEGER) AS ViewCount,
    _Body AS Body,
    _OwnerDisplayName AS OwnerDisplayName,
    CAST(try_strptime(_CreationDate, '%Y-%m-%dT%H:%M:%S.%g') AS DATE) AS LastActivityDate,
    _Title AS Title,
    regexp_extract_all(lower(_Tags), '[^<>]+') AS label
  FROM posts
  WHERE TRY_CAST(_PostTypeId AS INTEGER) = 1 AND _Tags IS NOT NULL AND _CreationDate IS NOT NULL
)"""


# Every post, questions and answers: what texts and models are made of.
TEXTS = POSTS + """,
texts AS (
  SELECT CAST(_Id AS BIGINT) AS Id, regexp_extract_all(lower(_Tags), '[^<>]+') AS label, _Title AS Title, _Body AS Body FROM posts
)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


ORACLE: dict[str, str] = {}

ORACLE["questions_etl"] = _with(QUESTIONS) + """
SELECT Id,
       strftime(CreationDate, '%Y-%m-%d') AS CreationDate,
       strftime(LastActivityDate, '%Y-%m-%d') AS LastActivityDate,
       CAST(year(CreationDate) AS BIGINT) AS Year,
       CAST(month(CreationDate) AS BIGINT) AS Month,
       CAST(Score AS BIGINT) AS Score,
       CAST(ViewCount AS BIGINT) AS ViewCount,
       OwnerDisplayName, Title, Body,
       array_to_string(label, '|') AS tags
FROM questions
"""


# ---------------------------------------------------------------- labels ----

ORACLE["tag_split"] = _with(QUESTIONS) + """
SELECT Id, CAST(generate_subscripts(label, 1) - 1 AS BIGINT) AS pos, unnest(label) AS tag
FROM questions
"""

ORACLE["tag_filter"] = _with(QUESTIONS) + """,
kept AS (SELECT Id, list_filter(label, lambda t: t IN ('en', 'de', 'toxic')) AS label FROM questions)
SELECT Id, array_to_string(label, '|') AS tags, CAST(len(label) AS BIGINT) AS n_tags
FROM kept WHERE len(label) > 0
"""

ORACLE["label_targets"] = _with(QUESTIONS) + """,
vocab AS (SELECT list(lbl ORDER BY lbl) AS v FROM (SELECT DISTINCT unnest(label) AS lbl FROM questions))
SELECT Id,
       array_to_string(list_transform(v, lambda x: CASE WHEN list_contains(label, x) THEN '1' ELSE '0' END), '')
         AS targets
FROM questions CROSS JOIN vocab
"""

ORACLE["label_counts"] = _with(QUESTIONS) + """
SELECT lbl AS label, CAST(count(*) AS BIGINT) AS n
FROM (SELECT unnest(label) AS lbl FROM questions) GROUP BY lbl
"""

ORACLE["label_cardinality"] = _with(QUESTIONS) + """
SELECT CAST((SELECT count(DISTINCT l) FROM (SELECT unnest(label) AS l FROM questions)) AS BIGINT) AS n_labels,
       CAST(count(*) AS BIGINT) AS n_posts,
       CAST(sum(len(label)) AS BIGINT) AS n_assignments,
       sum(len(label)) / count(*) AS mean_labels
FROM questions
"""

ORACLE["stable_split"] = _with(QUESTIONS) + """
SELECT Id, CASE WHEN ((Id * 7919 + 7 * 104729) % 1000 + 1000) % 1000 < 800 THEN 'train' ELSE 'test' END AS side
FROM questions
"""

ORACLE["top_labels"] = _with(TEXTS) + """
SELECT label, n FROM (SELECT lbl AS label, count(*) AS n FROM (SELECT unnest(label) AS lbl FROM texts) GROUP BY lbl)
ORDER BY n DESC, label LIMIT 5
"""

ORACLE["random_split"] = "SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_twice, true AS near_ratio FROM documents"

ORACLE["hash_split"] = _with(QUESTIONS) + """
SELECT count(*) AS n, CAST(0 AS BIGINT) AS n_twice, true AS near_ratio FROM questions
"""

# ------------------------------------------------------------------ text ----

_WS = "[ \\t\\n\\x0B\\f\\r]"


def _sql_list(words):
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


TOKENS = TEXTS + f""",
low AS (SELECT Id, lower(Body) AS t, regexp_replace(lower(Body), '{_WS}+$', '') AS r FROM texts),
tok AS (
  SELECT Id,
         CASE WHEN t = '' THEN ['']
              WHEN r = '' THEN []::VARCHAR[]
              ELSE string_split_regex(r, '{_WS}') END AS toks
  FROM low
),
tok_ns AS (
  SELECT Id, list_filter(toks, lambda x: NOT list_contains({_sql_list(ENGLISH_STOP_WORDS)}, lower(x))) AS toks
  FROM tok
)"""

ORACLE["tokens"] = _with(TOKENS) + """
SELECT Id, CAST(generate_subscripts(toks, 1) - 1 AS BIGINT) AS pos, unnest(toks) AS token FROM tok
"""

ORACLE["tokens_nostop"] = _with(TOKENS) + """
SELECT Id, CAST(generate_subscripts(toks, 1) - 1 AS BIGINT) AS pos, unnest(toks) AS token FROM tok_ns
"""

ORACLE["doc_freq"] = _with(TOKENS) + """
SELECT term, CAST(count(DISTINCT Id) AS BIGINT) AS df
FROM (SELECT Id, unnest(toks) AS term FROM tok_ns) GROUP BY term
"""

ORACLE["tfidf_terms"] = _with(TOKENS) + """,
tf AS (SELECT Id, term, count(*) AS tf FROM (SELECT Id, unnest(toks) AS term FROM tok_ns) GROUP BY Id, term),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
n AS (SELECT count(*) AS n FROM texts)
SELECT tf.Id, tf.term, CAST(tf.tf AS BIGINT) AS tf, CAST(dfq.df AS BIGINT) AS df,
       CASE WHEN dfq.df >= 2 THEN ln((n.n + 1.0)::DOUBLE / (dfq.df + 1.0)::DOUBLE) ELSE 0.0::DOUBLE END AS idf,
       tf.tf * CASE WHEN dfq.df >= 2 THEN ln((n.n + 1.0)::DOUBLE / (dfq.df + 1.0)::DOUBLE) ELSE 0.0::DOUBLE END AS tfidf
FROM tf JOIN dfq ON tf.term = dfq.term CROSS JOIN n
"""

ORACLE["hashing_tf_mass"] = _with(TOKENS) + """
SELECT Id, CAST(len(toks) AS BIGINT) AS n_tokens, CAST(len(toks) AS BIGINT) AS mass FROM tok_ns
"""


# The word hash of the hashing stage, Murmur3 with seed 42 over UTF-8 bytes, in
# arithmetic on unsigned integers. The older variant mixes every trailing byte,
# signed, like a block of four.
_ROTATED = "((({x} << 15) | ({x} >> 17)) & 4294967295)"
_MIXED = "((((xor(h, k) << 13) | (xor(h, k) >> 19)) & 4294967295) * 5 + 3864292196) & 4294967295"


def _hashed(source: str, legacy: bool) -> str:
    """CTEs from ``source`` (a table with distinct ``term``) to ``hashed``
    (term, bucket of 1000)."""
    blocks = "list_transform(range(0, n // 4), lambda i: ('0x' || hx[8*i+7:8*i+8] || hx[8*i+5:8*i+6] || hx[8*i+3:8*i+4] || hx[8*i+1:8*i+2])::UBIGINT)"
    byte = "('0x' || hx[2*i+1:2*i+2])::UBIGINT"
    if legacy:
        tail = f"list_transform(range(4 * (n // 4), n), lambda i: CASE WHEN {byte} > 127 THEN {byte} + 4294967040 ELSE {byte} END)"
        every, rest = f"list_concat({blocks}, {tail})", "[]::UBIGINT[]"
    else:
        little = f"list_transform(range(4 * (n // 4), n), lambda i: {byte} << (8 * (i % 4))::UBIGINT)"
        every, rest = blocks, f"CASE WHEN n % 4 = 0 THEN []::UBIGINT[] ELSE [list_sum({little})::UBIGINT] END"

    def mixed(name):
        first = f"list_transform({name}, lambda x: (x * 3432918353::UBIGINT) & 4294967295)"
        turned = f"list_transform({first}, lambda x: {_ROTATED.format(x='x')})"
        return f"list_transform({turned}, lambda x: (x * 461845907::UBIGINT) & 4294967295)"

    return f"""
hexed AS (SELECT term, hex(encode(term)) AS hx, strlen(term) AS n FROM {source}),
cut AS (SELECT term, n, {every} AS every, {rest} AS rest FROM hexed),
folded AS (
  SELECT term, n, list_reduce(list_concat([42::UBIGINT], {mixed('every')}), lambda h, k: {_MIXED}) AS h, {mixed('rest')} AS r FROM cut
),
f0 AS (SELECT term, xor(CASE WHEN len(r) > 0 THEN xor(h, r[1]) ELSE h END, n::UBIGINT) AS h FROM folded),
f1 AS (SELECT term, (xor(h, h >> 16) * 2246822507::UBIGINT) & 4294967295 AS h FROM f0),
f2 AS (SELECT term, (xor(h, h >> 13) * 3266489909::UBIGINT) & 4294967295 AS h FROM f1),
f3 AS (SELECT term, xor(h, h >> 16)::BIGINT AS h FROM f2),
hashed AS (SELECT term, (((CASE WHEN h > 2147483647 THEN h - 4294967296 ELSE h END) % 1000 + 1000) % 1000)::INTEGER AS bucket FROM f3)"""


_TERMS = """,
tf AS (SELECT Id, term, count(*) AS tf FROM (SELECT Id, unnest(toks) AS term FROM tok_ns) GROUP BY Id, term),
words AS (SELECT DISTINCT term FROM tf),"""

ORACLE["idf_weights"] = _with(TOKENS) + _TERMS + _hashed("words", legacy=False) + """,
dfq AS (SELECT bucket AS i, count(DISTINCT Id) AS df FROM tf JOIN hashed USING (term) GROUP BY bucket)
SELECT g.i::INTEGER AS i, coalesce(df, 0)::BIGINT AS df,
       CASE WHEN coalesce(df, 0) >= 2 THEN ln(((SELECT count(*) FROM texts) + 1.0)::DOUBLE / (df + 1.0)::DOUBLE) ELSE 0.0::DOUBLE END AS idf
FROM (SELECT unnest(range(0, 1000)) AS i) g LEFT JOIN dfq ON g.i = dfq.i
"""
ORACLE["legacy_hash_tf"] = _with(TOKENS) + _TERMS + _hashed("words", legacy=True) + """
SELECT bucket, count(DISTINCT Id)::BIGINT AS df, sum(tf)::BIGINT AS tf FROM tf JOIN hashed USING (term) GROUP BY bucket
"""


# --------------------------------------------------------------- metrics ----

PSEUDO = QUESTIONS + """,
vocab AS (SELECT list(lbl ORDER BY lbl) AS v FROM (SELECT DISTINCT unnest(label) AS lbl FROM questions)),
pt AS (
  SELECT Id, year(CreationDate) AS Year, label,
         list_concat(list_filter(label, lambda t: t <> 'toxic'),
                     CASE WHEN Score > 2000 THEN ['quality'] ELSE []::VARCHAR[] END) AS ptags
  FROM questions
),
pl AS (
  SELECT Id, Year,
         list_filter(list_transform(ptags, lambda x: CAST(list_position(v, x) - 1 AS DOUBLE)),
                     lambda i: i IS NOT NULL AND i >= 0) AS p,
         list_filter(list_transform(label, lambda x: CAST(list_position(v, x) - 1 AS DOUBLE)),
                     lambda i: i IS NOT NULL AND i >= 0) AS l
  FROM pt CROSS JOIN vocab
),
rs AS (
  SELECT Id, Year, p, l, len(p) AS np, len(l) AS nl,
         coalesce(list_sum(list_transform(list_distinct(p), lambda x:
             least(len(list_filter(p, lambda y: y = x)), len(list_filter(l, lambda y: y = x))))), 0) AS inter
  FROM pl
),
terms AS (
  SELECT Id, Year, l, CAST(len(l) AS BIGINT) AS n_true,
         CASE WHEN np > 0 THEN inter / np ELSE 0.0 END AS rp,
         CASE WHEN nl = 0 THEN 'NaN'::DOUBLE ELSE inter / nl END AS rr,
         CASE WHEN np + nl = 0 THEN 'NaN'::DOUBLE ELSE 2.0 * inter / (np + nl) END AS rf1,
         CASE WHEN nl + np - inter = 0 THEN 'NaN'::DOUBLE ELSE inter / (nl + np - inter) END AS racc,
         CAST(nl + np - 2 * inter AS DOUBLE) AS rham,
         CASE WHEN p = l THEN 1.0 ELSE 0.0 END AS rsub
  FROM rs
),
per_label AS (
  SELECT x AS label,
         sum(least(cp, cl)) AS tp, sum(greatest(cp - cl, 0)) AS fp, sum(greatest(cl - cp, 0)) AS fn
  FROM (SELECT x, len(list_filter(p, lambda y: y = x)) AS cp, len(list_filter(l, lambda y: y = x)) AS cl
        FROM (SELECT p, l, unnest(list_distinct(list_concat(p, l))) AS x FROM pl))
  GROUP BY x
)"""


def _rowwise_select(group: str) -> str:
    sel = f"{group}, " if group else ""
    by = f"GROUP BY {group}" if group else ""
    nl = (f"(SELECT count(DISTINCT x) FROM (SELECT unnest(l) AS x FROM terms t2 WHERE t2.{group} = t.{group}))"
          if group else "(SELECT count(DISTINCT x) FROM (SELECT unnest(l) AS x FROM terms))")
    return f"""
SELECT {sel}CAST(count(*) AS BIGINT) AS n, CAST({nl} AS BIGINT) AS n_labels,
       avg(rp) AS precision, avg(rr) AS recall, avg(rf1) AS f1, avg(racc) AS accuracy,
       sum(rham) / (count(*) * {nl}) AS hammingLoss, avg(rsub) AS subsetAccuracy
FROM terms t {by}
"""


ORACLE["metrics_rowwise"] = _with(PSEUDO) + _rowwise_select("")

ORACLE["metrics_by_year"] = _with(PSEUDO) + _rowwise_select("Year").replace(
    "SELECT Year, ", "SELECT CAST(Year AS BIGINT) AS Year, ", 1)

ORACLE["metrics_subset"] = _with(PSEUDO) + _rowwise_select("n_true")

ORACLE["metrics_micro"] = _with(PSEUDO) + """
SELECT CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn,
       sum(tp) / (sum(tp) + sum(fp)) AS microPrecision,
       sum(tp) / (sum(tp) + sum(fn)) AS microRecall,
       2 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)) AS microF1
FROM per_label
"""

ORACLE["metrics_by_label"] = _with(PSEUDO) + """,
scored AS (
  SELECT label, tp, fp, fn,
         CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS prec,
         CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS rec
  FROM per_label
)
SELECT v[CAST(label AS INTEGER) + 1] AS tag, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       CAST(fn AS BIGINT) AS fn, prec AS precision, rec AS recall,
       CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2 * prec * rec / (prec + rec) END AS f1
FROM scored CROSS JOIN vocab
"""


_EVALUATED = [("precision", True), ("recall", True), ("f1", True), ("accuracy", True), ("hammingLoss", False),
              ("subsetAccuracy", True), ("microPrecision", True), ("microRecall", True), ("microF1", True)]
ORACLE["evaluator_metrics"] = (
    _with(PSEUDO) + ", rowwise AS (" + _rowwise_select("") + "), micro AS ("
    + ORACLE["metrics_micro"].split(_with(PSEUDO))[1] + ")\n"
    + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {m} AS value, {str(up).lower()} AS larger_is_better FROM {'micro' if m.startswith('micro') else 'rowwise'}"
        for m, up in _EVALUATED))


ORACLE["metrics_observed"] = (
    _with(PSEUDO) + ", rowwise AS (" + _rowwise_select("") + "), micro AS ("
    + ORACLE["metrics_micro"].split(_with(PSEUDO))[1] + ")\n"
    + " UNION ALL ".join(
        f"SELECT '{m}' AS metric, {m}::DOUBLE AS value FROM {'micro' if m.startswith('micro') else 'rowwise'}"
        for m in [*(m for m, _ in _EVALUATED), "n", "n_labels"]))


# ------------------------------------------------------- sources / sinks ----

_XML = """
SELECT _Id, _PostTypeId, _CreationDate, _Score, _ViewCount, _Body, _OwnerDisplayName,
       _LastActivityDate, _Title, _Tags
FROM posts
"""
ORACLE["xml_scan"] = _with(POSTS) + _XML
ORACLE["xml_linewise"] = _with(POSTS) + _XML + "WHERE right(_Id, 1) NOT IN ('3', '4', '6')"
ORACLE["xml_rejects"] = _with(POSTS) + """
SELECT reason, CAST(sum(n) AS BIGINT) AS n FROM (
  SELECT CASE right(_Id, 1) WHEN '6' THEN 'row without Id' ELSE 'malformed row element' END AS reason,
         CASE right(_Id, 1) WHEN '4' THEN 2 ELSE 1 END AS n
  FROM posts WHERE right(_Id, 1) IN ('3', '4', '6')
) GROUP BY reason
"""
ORACLE["xml_multiline"] = _with(POSTS) + _XML + "WHERE right(_Id, 1) NOT IN ('3', '4', '6')"
ORACLE["xml_multiline_rejects"] = _with(POSTS) + """
SELECT CASE right(_Id, 1) WHEN '6' THEN 'row without Id' ELSE 'malformed row element' END AS reason, count(*) AS n
FROM posts WHERE right(_Id, 1) IN ('3', '4', '6') GROUP BY ALL
"""
ORACLE["xml_rechunk"] = _with(POSTS) + _XML

ORACLE["questions_parquet_year"] = _with(QUESTIONS) + """
SELECT Id, CAST(month(CreationDate) AS BIGINT) AS Month, Title, array_to_string(label, '|') AS tags
FROM questions WHERE year(CreationDate) = 2019
"""

# --------------------------------------------------------------- scoring ----

ORACLE["decode_labels"] = _with(PSEUDO) + """
SELECT Id, array_to_string(list_transform(p, lambda i: v[CAST(i AS INTEGER) + 1]), '|') AS tags
FROM pl CROSS JOIN vocab
"""

ORACLE["score_json"] = _with(PSEUDO) + """
SELECT Id, CAST(to_json({'tags': list_transform(p, lambda i: v[CAST(i AS INTEGER) + 1])}) AS VARCHAR) AS reply
FROM pl CROSS JOIN vocab
"""

REQUESTS = POSTS + """,
requests AS (
  SELECT CAST(_Id AS BIGINT) AS Id,
         CASE CAST(_Id AS BIGINT) % 20 WHEN 7 THEN '' WHEN 8 THEN chr(9) WHEN 9 THEN NULL ELSE _Title END AS Title,
         CASE CAST(_Id AS BIGINT) % 20 WHEN 10 THEN NULL ELSE _Body END AS Body
  FROM posts
),
judged AS (
  SELECT Id, CASE WHEN Title IS NULL OR NOT regexp_matches(Title, '[^\\x00-\\x20]') THEN 'title is required'
                  WHEN Body IS NULL THEN 'body is required' END AS reason
  FROM requests
)"""

ORACLE["request_rejects"] = _with(REQUESTS) + """
SELECT Id, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status, reason FROM judged
"""

JSON_REQUESTS = REQUESTS + """,
json_judged AS (
  SELECT CASE WHEN Id % 20 NOT IN (3, 11) THEN Id END AS Id,
         CASE WHEN Id % 20 IN (3, 11) THEN 'request is no JSON object'
              WHEN Id % 20 IN (4, 12) THEN 'title and body must be text'
              WHEN Title IS NULL OR NOT regexp_matches(Title, '[^\\x00-\\x20]') THEN 'title is required'
              WHEN Body IS NULL OR Id % 20 = 6 THEN 'body is required' END AS reason
  FROM requests
)"""
ORACLE["json_requests"] = _with(JSON_REQUESTS) + "SELECT Id, reason, true AS has_text FROM json_judged"

# ---------------------------------------------------------------- models ----
# SQL cannot fit a model. It gives what must hold of any right result: rows,
# tags, losses of predicting nothing, and that nothing disagrees.

_SIDE = """,
sides AS (
  SELECT *, CASE WHEN (Id % 1000 * 7919 + 7 * 104729) % 1000 < 800 THEN 'train' ELSE 'test' END AS side FROM {}
)"""
SIDES = TEXTS + _SIDE.format("texts")

ORACLE["table_scoring"] = _with(REQUESTS) + "SELECT Id, reason, reason IS NULL AS replied FROM judged"

ORACLE["br_fit_predict"] = _with(SIDES) + """
SELECT tag, (SELECT count(*) FROM texts) AS n_rows, count(*) AS n_train, CAST(0 AS BIGINT) AS n_mismatch,
       CASE WHEN tag IN ('de', 'en', 'es', 'fr') THEN true END AS predicted
FROM (SELECT unnest(list_distinct(label)) AS tag FROM sides WHERE side = 'train') GROUP BY tag
"""
ORACLE["br_metrics"] = _with(SIDES) + """
SELECT side, n, n_labels, tags / (n * n_labels) AS nothing_loss,
       CASE WHEN side = 'train' THEN true END AS beats_nothing, true AS within_bounds
FROM (SELECT side, count(*) AS n, sum(len(label)) AS tags FROM sides GROUP BY side)
JOIN (SELECT side, count(DISTINCT tag) AS n_labels FROM (SELECT side, unnest(label) AS tag FROM sides) GROUP BY side) USING (side)
"""
_AGREES = "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_mismatch, true AS most_tagged, CAST(sum(len(label)) AS BIGINT) AS n_given"
ORACLE["br_save_load"] = _with(TEXTS) + _AGREES + " FROM texts"
ORACLE["stream_score"] = ORACLE["br_save_load"]
ORACLE["br_linear_score"] = _with(TEXTS) + _AGREES + ", CAST(0 AS BIGINT) AS n_block_mismatch FROM texts"
ORACLE["stream_tables"] = _with(JSON_REQUESTS) + "SELECT Id, reason, true AS as_batch FROM json_judged"

ORACLE["threshold_sweep"] = _with(SIDES) + """,
valid AS (SELECT Id, label FROM sides WHERE side = 'train' AND (Id % 1000 * 7919 + 11 * 104729) % 1000 >= 800)
SELECT 'maxIter=100, tol=' || tol AS params, threshold, (SELECT count(*) FROM valid) AS n,
       (SELECT count(DISTINCT t) FROM (SELECT unnest(label) AS t FROM valid)) AS n_labels, true AS same_loss
FROM (SELECT unnest(['0.01', '0.1']) AS tol), (SELECT unnest([0.5::DOUBLE, 0.65::DOUBLE, 0.8::DOUBLE]) AS threshold)
"""
ORACLE["tvs_best_params"] = _with(SIDES) + """
SELECT count(*) AS n_rows, CAST(6 AS BIGINT) AS n_grid, true AS winner_has_least_loss, true AS losses_are_shares
FROM sides WHERE side = 'train'
"""
ORACLE["experiment_report"] = _with(QUESTIONS + _SIDE.format("questions")) + """,
kept AS (
  SELECT Id, side, list_filter(label, lambda t: t IN ('de', 'en', 'es', 'fr', 'quality', 'toxic')) AS label FROM sides
),
test AS (SELECT label FROM kept WHERE len(label) > 0 AND side = 'test'),
k AS (SELECT count(DISTINCT t) AS n_labels FROM (SELECT unnest(label) AS t FROM test))
SELECT count(*) AS n, any_value(n_labels) AS n_labels, sum(len(label)) / (count(*) * any_value(n_labels)) AS nothing_loss,
       true AS beats_nothing, true AS on_grid
FROM test, k
"""
_PROMISES = ["a frame the caller keeps stays kept", "a restarted fit fits what is left", "any classifier", "asks for a classifier",
             "copy reaches the base learner", "declared schema", "estimator loads as saved", "evaluator loads as saved",
             "members have the params", "names of the indexes", "no columns but the declared", "raw scores tell the predictions",
             "refuses a missing column", "refuses labels that are no arrays", "refuses what cannot be written", "top tags in order"]
ORACLE["br_contract"] = _with(TEXTS) + f"""
SELECT promise, true AS kept, (SELECT count(*) FROM texts) AS n_rows FROM (SELECT unnest({_sql_list(_PROMISES)}) AS promise)
"""


ORACLE["linear_score_rule"] = _with(TOKENS) + """,
q AS (SELECT Id, label FROM texts),
lv AS (SELECT list(lbl ORDER BY lbl) AS v FROM (SELECT DISTINCT unnest(label) AS lbl FROM q)),
presence AS (
  SELECT DISTINCT t.Id AS id, t.term
  FROM (SELECT Id, unnest(toks) AS term FROM tok_ns) t JOIN q ON t.Id = q.Id
),
doclab AS (
  SELECT DISTINCT Id AS id, CAST(list_position(v, l) - 1 AS INTEGER) AS label
  FROM (SELECT Id, unnest(label) AS l FROM q) CROSS JOIN lv
),
n AS (SELECT count(*) AS n FROM q),
stats AS (SELECT label, count(*) AS n_l, (SELECT n FROM n) - count(*) AS n_o FROM doclab GROUP BY label),
a AS (SELECT d.label, p.term, count(*) AS a FROM presence p JOIN doclab d ON p.id = d.id GROUP BY d.label, p.term),
dfq AS (SELECT term, count(*) AS df FROM presence GROUP BY term),
w AS (
  SELECT a.label, a.term,
         ln((a.a + 1.0) / (s.n_l + 2.0)) - ln((dfq.df - a.a + 1.0) / (s.n_o + 2.0)) AS w
  FROM a JOIN dfq ON a.term = dfq.term JOIN stats s ON a.label = s.label
),
margins AS (
  SELECT id, label, sum(m) AS margin FROM (
    SELECT p.id, w.label, w.w AS m FROM presence p JOIN w ON p.term = w.term
    UNION ALL
    SELECT q.Id AS id, s.label, CASE WHEN s.n_o = 0 THEN 'Infinity'::DOUBLE ELSE ln(s.n_l / s.n_o) END AS m FROM q CROSS JOIN stats s
  ) GROUP BY id, label
)
SELECT CAST(id AS BIGINT) AS Id, v[label + 1] AS tag FROM margins CROSS JOIN lv WHERE margin > 0
"""

"""DuckDB SQL for the operators that SQL can express, written independently
of the Spark code (pairs by brute force, seats by ranking every quotient)."""

from __future__ import annotations

_COMPONENTS = """
reach(id, low) AS (
  SELECT id, id FROM vertices
  UNION
  SELECT l.b, r.low FROM reach r JOIN links l ON l.a = r.id WHERE r.low < l.b
),
component AS (SELECT id, min(low) AS component_id FROM reach GROUP BY id)
"""

OP1 = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.98
),
vertices AS (SELECT vec_id AS id FROM embeddings),
{_COMPONENTS}
SELECT c.id AS vec_id, (SELECT count(*) FROM links l WHERE l.a = c.id) AS n_links, component_id, c.id = component_id AS kept
FROM component c
"""

OP2 = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '\\S+') AS w FROM documents
),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM shared JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
  WHERE 10 * shared.n >= 8 * (s.n + t.n - shared.n)
),
vertices AS (SELECT doc_id AS id FROM documents),
{_COMPONENTS}
SELECT c.id AS doc_id, (SELECT count(*) FROM links l WHERE l.a = c.id) AS n_links, component_id, c.id = component_id AS kept
FROM component c
"""

_HASH = "('0x' || substr(md5({0}), 1, 15))::BIGINT"

OP3 = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    {_HASH.format("coalesce(text, '')")} AS digest FROM documents
),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS no FROM d GROUP BY source
),
w AS (SELECT *, CASE no % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM s),
c AS (
  SELECT *, (SELECT sum(source_size) FROM s)::DOUBLE * 1.5 AS mix,
    coalesce(sum(2 * source_size) OVER (ORDER BY source_size / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS capped,
    (SELECT sum(w) FROM w) - coalesce(sum(w) OVER (ORDER BY source_size / w, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS w_left
  FROM w
),
lvl AS (
  SELECT mix, capped, w_left FROM c WHERE (mix - capped) * w / w_left <= 2 * source_size ORDER BY source_size / w, no LIMIT 1
),
t AS (
  SELECT c.source, c.source_size, c.no, least((lvl.mix - lvl.capped) * c.w / lvl.w_left, (2 * c.source_size)::DOUBLE) AS target,
    greatest(1, ceil(c.source_size / 100000))::BIGINT AS shards
  FROM c, lvl
),
seats AS (SELECT round(sum(target ORDER BY no) / 64)::BIGINT AS seats FROM t),
bids AS (
  SELECT no, target / (2 * k + 1) AS quotient
  FROM (SELECT no, target, unnest(range(ceil(target / 64)::BIGINT + 3)) AS k FROM t WHERE target > 0)
),
won AS (
  SELECT no, count(*) AS blocks FROM (SELECT no, row_number() OVER (ORDER BY quotient DESC, no) AS r FROM bids), seats
  WHERE r <= seats GROUP BY no
),
dealt AS (
  SELECT doc_id, size, digest, source_size, target, t.no, coalesce(won.blocks, 0) AS blocks,
    {_HASH.format("'shard11:' || coalesce(doc_id::VARCHAR, '') || ':' || digest")} % shards AS shard,
    {_HASH.format("'order11:' || coalesce(doc_id::VARCHAR, '') || ':' || digest")} AS place
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source LEFT JOIN won ON won.no = t.no
),
sh AS (SELECT no, shard, blocks, sum(size)::BIGINT AS words FROM dealt GROUP BY ALL),
sbids AS (
  SELECT no, shard, blocks, words / (2 * k + 1) AS quotient
  FROM (SELECT *, unnest(range(ceil(words / 64 * 2)::BIGINT + 3)) AS k FROM sh WHERE words > 0)
),
quota AS (
  SELECT no, shard, count(*) AS quota
  FROM (SELECT *, row_number() OVER (PARTITION BY no ORDER BY quotient DESC, shard) AS r FROM sbids) WHERE r <= blocks GROUP BY ALL
),
laid AS (
  SELECT dealt.*, words, greatest(ceil(words / 64)::BIGINT, 1) AS n, coalesce(quota, 0) AS quota,
    sum(size) OVER (PARTITION BY dealt.no, dealt.shard ORDER BY place, doc_id NULLS FIRST, digest ROWS UNBOUNDED PRECEDING)::BIGINT AS e
  FROM dealt JOIN sh ON sh.no = dealt.no AND sh.shard = dealt.shard
  LEFT JOIN quota ON quota.no = dealt.no AND quota.shard = dealt.shard
),
q AS (
  SELECT *, least(quota, 2 * n) // n AS passes, least(quota, 2 * n) % n AS extra,
    {_HASH.format("'phase11:' || no::VARCHAR || ':' || shard::VARCHAR")} % n AS phase, e - size AS b
  FROM laid
),
took AS (
  SELECT doc_id, size, source_size, target,
    passes * e + 64 * (((e // 64) * extra + phase) // n) + (e % 64) * (((e // 64 + 1) * extra + phase) // n - ((e // 64) * extra + phase) // n)
    - (passes * b + 64 * (((b // 64) * extra + phase) // n) + (b % 64) * (((b // 64 + 1) * extra + phase) // n - ((b // 64) * extra + phase) // n)) AS taken
  FROM q
)
SELECT doc_id, size::BIGINT AS size, source_size, target, taken::BIGINT AS taken FROM took
"""

OP4 = """
WITH t AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS n FROM documents
),
g AS (SELECT n, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY n)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t.n) AS text_sha256 FROM t JOIN g ON t.n = g.n
"""

OP5 = """
WITH t AS (
  SELECT conv_id, coalesce(floor(turn / 64), -1)::BIGINT AS piece, turn, role, replace(coalesce(text, ''), '<|', '< |') AS body
  FROM conversations
),
sp AS (SELECT DISTINCT conv_id, role AS speaker FROM conversations WHERE role IS NOT NULL),
r AS (
  SELECT t.conv_id, speaker, piece, turn, role, body, role IS NOT DISTINCT FROM speaker AS own,
    CASE WHEN role IS NOT DISTINCT FROM speaker THEN '<|assistant|>
'
      ELSE '<|user' || coalesce(':' || replace(role, '<|', '< |'), '') || '|>
' END AS head
  FROM t JOIN sp ON t.conv_id IS NOT DISTINCT FROM sp.conv_id
),
l AS (
  SELECT *, coalesce(sum(length(head) + length(body) + 8) OVER (
    PARTITION BY conv_id, speaker, piece ORDER BY turn NULLS FIRST, role NULLS FIRST, body
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + length(head) AS first FROM r
),
p AS (
  SELECT conv_id, speaker, piece, count(*) AS n_turns,
    string_agg(head || body || '<|end|>
', '' ORDER BY first) AS text,
    coalesce(string_agg(first || ':' || (first + length(body) + 7), ',' ORDER BY first) FILTER (WHERE own), '') AS masks
  FROM l GROUP BY ALL
)
SELECT conv_id, speaker, piece,
  coalesce(sum(length(text)) OVER (PARTITION BY conv_id, speaker ORDER BY piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset",
  n_turns::INTEGER AS n_turns, length(text)::INTEGER AS n_chars, sha256(text) AS text_sha256, masks
FROM p
"""

# Every document is scored for every item.
OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
),
s AS (SELECT count(*) AS n_docs, sum(len(terms))::BIGINT AS total FROM d WHERE len(terms) > 0),
i AS (
  SELECT item_id, row_number() OVER () AS q, unnest(regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT DISTINCT item_id, text FROM benchmark)
),
q AS (SELECT q, any_value(item_id) AS item_id, term, count(*) AS times FROM i GROUP BY q, term),
t AS (
  SELECT r, any_value(doc_id) AS doc_id, any_value(n)::BIGINT AS n, term, count(*)::BIGINT AS tf
  FROM (SELECT r, doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY r, term
),
f AS (SELECT term, count(*) AS df FROM t GROUP BY term),
p AS (
  SELECT r, doc_id, term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT
    * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // total))) AS part
  FROM t JOIN f USING (term), s
),
m AS (
  SELECT q, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id, sum(times * part)::BIGINT AS score
  FROM q JOIN p USING (term) GROUP BY q, r
),
k AS (SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank FROM m WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 10
"""

LLM_ORACLE = {
    "op1_embedding_neardup": OP1,
    "op2_ngram_jaccard": OP2,
    "op3_source_mix": OP3,
    "op4_exact_dedup": OP4,
    "op5_chat_rotation": OP5,
    "op12_ranked_search": OP12,
}

"""DuckDB SQL with the results of the queries that SQL can express."""

from __future__ import annotations

from .quality import CLASSES, PUNCTUATION, Limits

WORD = r"[^\x20\x09-\x0D]+"

ORACLE: dict[str, str] = {}

ORACLE["op4_warc"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS b FROM pages
), d AS (
  SELECT page_id, octet_length(b) AS n, sha1(b) AS digest FROM p
), r AS (
  SELECT *, max(page_id) OVER (PARTITION BY digest) AS last FROM d
)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
  CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
FROM r
"""


def _quality_sql(limits: Limits) -> str:
    """Base counts by words and 8-word windows; distances by histograms in long form."""
    classes = [
        "[^a-z]", "[^A-Z]", "[^0-9]", r"[^\x20\x09-\x0D]",
        "[^" + PUNCTUATION.replace("-", r"\-").replace("'", "''") + "]",
    ]
    counts = ", ".join(f"length(regexp_replace(t, '{c}', '', 'g')) AS c{i}" for i, c in enumerate(classes))
    ascii_left = r"length(regexp_replace(t, '[^\x00-\x7F]', '', 'g'))"
    long = " UNION ALL ".join(f"SELECT doc_id, lang, {i} AS item, c{i} AS n FROM chars" for i in range(CLASSES))
    return f"""
WITH t AS (SELECT doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, lang, t, regexp_extract_all(t, '{WORD}') AS ws FROM t),
lines AS (
  SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM t)
  WHERE regexp_matches(line, '{WORD}')
),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
eight AS (
  SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 7), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM w WHERE len(ws) >= 8)
),
twice AS (
  SELECT doc_id, i FROM eight SEMI JOIN (
    SELECT doc_id, g FROM eight GROUP BY ALL HAVING count(*) > 1
  ) USING (doc_id, g)
),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id
),
base AS (
  SELECT doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)
),
c AS (SELECT doc_id, lang, length(t) AS n, {ascii_left} AS a, {counts} FROM t),
chars AS (SELECT doc_id, lang, n, c0, c1, c2, c3, c4, a - c0 - c1 - c2 - c3 - c4 AS c5, n - a AS c6 FROM c),
charl AS ({long}),
words AS (SELECT doc_id, lang, unnest(ws) AS word FROM w),
counted AS (SELECT doc_id, word, count(*) AS n FROM words GROUP BY ALL),
lw AS (SELECT lang, word, count(*) AS n FROM words WHERE lang IS NOT NULL GROUP BY ALL),
lt AS (SELECT lang, sum(n) AS total FROM lw GROUP BY lang HAVING sum(n) >= {limits.min_reference_words}),
top AS (
  SELECT lang, word, n / total AS q
  FROM (SELECT *, count(*) OVER (PARTITION BY lang ORDER BY n DESC) AS r FROM lw) JOIN lt USING (lang)
  WHERE r <= {limits.common_words}
),
lc AS (
  SELECT lang, item, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q
  FROM charl JOIN lt USING (lang) GROUP BY lang, item
),
cd AS (
  SELECT doc_id, min(js) AS d FROM (
    SELECT doc_id, lc.lang, sqrt(greatest(0, sum(
      CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS js
    FROM (SELECT charl.doc_id, item, charl.n / greatest(chars.n, 1) AS p FROM charl JOIN chars USING (doc_id)) x
    JOIN lc USING (item) GROUP BY doc_id, lc.lang
  ) GROUP BY doc_id
),
pairs AS (
  SELECT b.doc_id, top.lang, top.q, coalesce(k.n, 0) / greatest(b.n_words, 1) AS p
  FROM base b CROSS JOIN top LEFT JOIN counted k ON k.doc_id = b.doc_id AND k.word = top.word
),
rest AS (
  SELECT doc_id, lang, greatest(0, 1 - sum(q)) AS q, 1 - sum(p) AS p FROM pairs GROUP BY doc_id, lang
),
wd AS (
  SELECT doc_id, min(js) AS d FROM (
    SELECT doc_id, lang, sqrt(greatest(0, sum(
      CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS js
    FROM (SELECT doc_id, lang, q, p FROM pairs UNION ALL SELECT doc_id, lang, q, p FROM rest)
    GROUP BY doc_id, lang
  ) GROUP BY doc_id
),
judged AS (
  SELECT b.*, n_words < {limits.min_words}
    OR 100 * n_repeat_words > {limits.max_repeat_percent} * n_words AS base_failed,
    chars.n < {limits.min_chars_for_chars} OR cd.d IS NULL OR cd.d <= {limits.char_distance} AS chars_ok,
    n_words < {limits.min_words_for_words} OR wd.d IS NULL OR wd.d <= {limits.word_distance} AS words_ok
  FROM base b JOIN chars USING (doc_id) LEFT JOIN cd USING (doc_id) LEFT JOIN wd USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND chars_ok AND words_ok AS kept
FROM judged
"""


ORACLE["op6_quality_rules"] = _quality_sql(Limits())

ORACLE["op9_mix_sources"] = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    coalesce(1.0::DOUBLE / (1.0::DOUBLE + 20.0::DOUBLE * ((length(text)
      - length(translate(text, '#*$%&|<>', ''))) / greatest(length(text), 1)::DOUBLE)), 1.0) AS w,
    md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS m
  FROM documents
),
k AS (
  SELECT doc_id, source, size,
    -ln((('0x' || substr(m, 1, 13))::BIGINT::DOUBLE + 1.0::DOUBLE) / 4503599627370496.0::DOUBLE) / w AS k FROM d
),
s AS (SELECT source, sum(size) AS source_size FROM k GROUP BY source),
r AS (
  SELECT source, source_size, source_size * 3 AS cap,
    [5, 2, 1][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT] AS w FROM s
),
f AS (
  SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER o, 0) AS lft,
    sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS w_lft
  FROM r WINDOW o AS (ORDER BY cap::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
g AS (SELECT *, cap * w_lft < lft * w AS stops FROM f),
goal AS (
  SELECT source, source_size, CASE WHEN stops THEN cap::DOUBLE ELSE
    w::DOUBLE * (sum(source_size) OVER () - sum(CASE WHEN stops THEN cap ELSE 0 END) OVER ())::DOUBLE
    / (sum(CASE WHEN stops THEN 0 ELSE w END) OVER ())::DOUBLE END AS target
  FROM g
),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM goal
),
peers AS (SELECT source, k, sum(size) AS n FROM k GROUP BY ALL),
mid AS (
  SELECT source, k, sum(n) OVER (PARTITION BY source ORDER BY k) - n / 2.0::DOUBLE AS middle FROM peers
)
SELECT k.doc_id, size, e.source_size::BIGINT AS source_size, target,
  (size * (epochs + CASE WHEN middle <= target - epochs * e.source_size THEN 1 ELSE 0 END))::BIGINT AS taken
FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source
JOIN mid ON mid.source IS NOT DISTINCT FROM k.source AND mid.k = k.k
"""

ORACLE["op11_hard_negatives"] = """
WITH rows AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT a.vec_id AS anchor_id, hash(a.label, a.v) AS key, b.vec_id, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND (a.vec_id <> b.vec_id OR a.label <> b.label)
), positives AS (
  SELECT anchor_id, key, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id, key ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY anchor_id, key, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id, key)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

# CRC-32 (reflected polynomial 0xEDB88320) of the id's digits, bit by bit.
ORACLE["op12_prefix_trie"] = """
WITH ids AS (
  SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL
), heads AS (
  SELECT c, xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, b: list_reduce(
      list_prepend(xor(crc, b), range(8)),
      lambda v, i: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384::BIGINT) ELSE v >> 1 END))) % 4 AS h
  FROM ids
), turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
  SELECT h.c, t.p, t.role, t.text FROM heads h JOIN turns t ON t.c = h.c - h.c % 20 AND t.p <= h.h
  UNION ALL
  SELECT h.c, h.h + t.p, t.role, t.text FROM heads h JOIN turns t ON t.c = h.c AND t.p > h.h
), placed AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY p) AS d,
    md5(length(role)::VARCHAR || ':' || role || text) AS turn,
    len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words
  FROM rebuilt
), paths AS (
  SELECT c, d, words, string_agg(turn, '') OVER (PARTITION BY c ORDER BY d) AS path FROM placed
  UNION ALL SELECT c, 0, 0, '' FROM ids
), lengths AS (
  SELECT c, max(d) AS n FROM paths GROUP BY c
), nodes AS (
  SELECT path, any_value(d) AS d, any_value(words) AS words, min(c) AS c, count(*) AS n_convs,
    coalesce(string_agg(CASE WHEN d = n THEN c::VARCHAR END, ',' ORDER BY c), '') AS ends
  FROM paths JOIN lengths USING (c) GROUP BY path
), children AS (
  SELECT left(path, 32 * (d - 1)) AS path, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), counted AS (
  SELECT nodes.*, coalesce(children.n, 0) AS n_children FROM nodes LEFT JOIN children USING (path)
), below AS (
  SELECT left(path, 32 * up) AS path, n_children = 0 AS leaf, (n_convs - 1) * words AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS up FROM counted)
), summed AS (
  SELECT path, count(*) FILTER (leaf) AS n_leaves, sum(saved) AS saved_tokens FROM below GROUP BY path
)
SELECT a.c AS conv_id, a.d AS depth, p.c AS parent_conv_id, a.n_convs, a.n_children,
  s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, sha256(a.ends) AS ends_sha256
FROM counted a JOIN summed s USING (path)
LEFT JOIN nodes p ON a.d > 0 AND p.path = left(a.path, 32 * (a.d - 1))
"""

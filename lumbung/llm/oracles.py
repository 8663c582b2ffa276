"""SQL for the results of those operators that SQL can state: by definition, not by the method."""

from __future__ import annotations

from lumbung.llm.secret_scan import BASE, RULES, Rule

#: Every later page with an equal payload; base 32 of a SHA-1 is 32 groups of five of its bits.
WARC = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), r AS (SELECT hex, max(page_id) AS response FROM p GROUP BY hex),
d AS (
  SELECT page_id, response, strlen(html) AS n, hex,
         list_transform(range(0, 8), lambda i: CAST('0x' || substr(hex, CAST(1 + 5 * i AS INT), 5) AS BIGINT)) AS five
  FROM p JOIN r USING (hex)
)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(five, lambda v:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 32768 % 32 + 1 AS INT), 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 1024 % 32 + 1 AS INT), 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v // 32 % 32 + 1 AS INT), 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(v % 32 + 1 AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id < response THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < response THEN response END AS refers_to
FROM d
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), u AS (SELECT * FROM v WHERE list_dot_product(e, e) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT a AS id, b AS other FROM links
  UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a
), least AS (SELECT id, min(other) AS m FROM reach GROUP BY id),
counts AS (SELECT a AS id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id,
       coalesce(m, vec_id) >= vec_id AS kept
FROM embeddings LEFT JOIN least ON least.id = vec_id LEFT JOIN counts ON counts.id = vec_id
"""

MINHASH = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE
    WHEN len(words) = 0 THEN []
    WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingles
  FROM w
), sized AS (SELECT doc_id, len(shingles) AS n FROM s),
one AS (SELECT doc_id, unnest(shingles) AS x FROM s),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM one a JOIN one b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM common JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b
  WHERE 100 * c >= 75 * (x.n + y.n - c)
), reach AS (
  SELECT a AS id, b AS other FROM links
  UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a
), least AS (SELECT id, min(other) AS m FROM reach GROUP BY id)
SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
       coalesce(m, doc_id) >= doc_id AS kept
FROM sized LEFT JOIN least ON least.id = doc_id
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x)))
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
), p AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INT) AS rank,
       other AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""

SUBSTRING_DEDUP = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), listed AS (
  SELECT doc_id, list_transform(range(1, len(words) - 48), lambda i: md5(array_to_string(words[i:i + 49], ' '))) AS hs
  FROM w
), windows AS (SELECT doc_id, unnest(hs) AS h, generate_subscripts(hs, 1) AS i FROM listed),
least AS (SELECT h, min(doc_id) AS m FROM windows GROUP BY h),
gone AS (SELECT doc_id, i FROM windows JOIN least USING (h) WHERE m < doc_id),
each AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
marked AS (
  SELECT each.doc_id, each.i, word,
         coalesce(last_value(gone.i IGNORE NULLS) OVER (PARTITION BY each.doc_id ORDER BY each.i), -50) AS latest
  FROM each LEFT JOIN gone ON gone.doc_id = each.doc_id AND gone.i = each.i
)
SELECT w.doc_id, count(i) AS n_words, count(*) FILTER (i < latest + 50) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (i >= latest + 50), '')) AS kept_sha256
FROM w LEFT JOIN marked ON marked.doc_id = w.doc_id GROUP BY w.doc_id
"""


def secrets() -> str:
    """Places of matches: lengths of what stands between them and of themselves, summed up."""

    def found(rank: int, rule: Rule) -> str:
        pattern = rule.java.replace("'", "''")
        return f"""
  SELECT doc_id, {rank} AS rank, '{rule.name}' AS kind, {rule.least} AS least,
         regexp_extract_all(text, '{pattern}') AS ms, regexp_extract_all(text, '{pattern}', {rule.group}) AS gs,
         string_split_regex(text, '{pattern}') AS parts
  FROM t WHERE regexp_matches(text, '{pattern}')"""

    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
m AS ({" UNION ALL ".join(found(rank, rule) for rank, rule in enumerate(RULES))}),
e AS (
  SELECT doc_id, rank, kind, least, parts, ms, gs, unnest(range(1, len(ms) + 1)) AS i FROM m
), placed AS (
  SELECT doc_id, rank, kind, length(gs[i]) >= least AS holds,
         sum(length(parts[i]) + length(ms[i])) OVER (PARTITION BY doc_id, rank ORDER BY i) AS stop,
         length(ms[i]) AS n
  FROM e
), spans AS (
  SELECT doc_id, rank, kind, CAST(stop - n AS BIGINT) AS start, CAST(stop AS BIGINT) AS stop FROM placed WHERE holds
), grouped AS (
  SELECT doc_id,
         {", ".join(f"count(*) FILTER (WHERE kind = '{rule.name}') AS n_{rule.name}" for rule in BASE)},
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) FILTER (WHERE rank < {len(BASE)}) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank) AS spans
  FROM spans GROUP BY doc_id
)
SELECT t.doc_id, {", ".join(f"coalesce(n_{rule.name}, 0) AS n_{rule.name}" for rule in BASE)},
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM t LEFT JOIN grouped USING (doc_id)
"""

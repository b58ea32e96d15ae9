"""SQL for the queries that SQL can express."""

from __future__ import annotations

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE: dict[str, str] = {}

ORACLE["op5_mixing"] = f"""
WITH counted AS (
  SELECT doc_id, source, len({_WORDS})::BIGINT AS size, md5('mix-1:' || coalesce(doc_id::VARCHAR, '')) AS h,
    (SELECT count(*) FROM documents) // 1024 + 1 AS shards
  FROM documents
), dealt AS (
  SELECT doc_id, size, shards, CASE WHEN source IS NULL THEN 't' ELSE 's' || source END AS src,
    ('0x' || substr(h, 1, 7))::BIGINT % shards AS deal, substr(h, 8, 25) AS place
  FROM counted
), docs AS (
  SELECT *, deal * (count(*) OVER (PARTITION BY src) // 1024 + 1) // shards AS shard FROM dealt
), cells AS (
  SELECT shard, src, sum(size)::BIGINT AS words FROM docs GROUP BY ALL
), ranked AS (
  SELECT src, sum(words)::BIGINT AS source_size, row_number() OVER (ORDER BY src) AS rank,
    [5, 2, 1][((row_number() OVER (ORDER BY src) - 1) % 3 + 1)::INT] AS w
  FROM cells GROUP BY src
), level AS (
  SELECT *, source_size / w AS a,
    (sum(source_size) OVER () * 150 - coalesce(sum(source_size) OVER b, 0) * 200)::DOUBLE AS words_left,
    ((sum(w) OVER () - coalesce(sum(w) OVER b, 0)) * 100)::DOUBLE AS weight_left
  FROM ranked WINDOW b AS (ORDER BY source_size / w, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), opened AS (
  SELECT *, w * words_left / weight_left >= source_size * 2 AS is_full FROM level
), target AS (
  SELECT src, source_size, rank, CASE WHEN is_full THEN (source_size * 2)::DOUBLE ELSE
    w * (SELECT words_left FROM opened WHERE NOT is_full ORDER BY a, rank LIMIT 1)
      / (SELECT weight_left FROM opened WHERE NOT is_full ORDER BY a, rank LIMIT 1) END AS target
  FROM opened
), seats AS (
  SELECT src, rank, target, unnest(range((source_size * 2 + 63) // 64)) AS k FROM target WHERE target > 0
), won AS (
  SELECT src, count(*) AS blocks FROM (SELECT src, row_number() OVER (ORDER BY target / (k * 2 + 1) DESC, rank, k) AS seat FROM seats)
  WHERE seat <= (SELECT (sum(floor(target)::BIGINT) + 32) // 64 FROM target) GROUP BY src
), ends AS (
  SELECT src, shard, words, source_size, target, coalesce(blocks, 0)::HUGEINT AS blocks,
    sum(words) OVER (PARTITION BY src ORDER BY shard ROWS UNBOUNDED PRECEDING) AS done
  FROM cells JOIN target USING (src) LEFT JOIN won USING (src)
), quota AS (
  SELECT *, CASE WHEN source_size > 0 THEN (2 * blocks * done + source_size) // (2 * source_size)
    - (2 * blocks * (done - words) + source_size) // (2 * source_size) ELSE 0 END AS quota
  FROM ends
), line AS (
  SELECT doc_id, size, source_size, target, quota * 64 AS cut,
    sum(size) OVER (PARTITION BY src, shard ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) - size AS start, words AS cell
  FROM docs JOIN quota USING (src, shard)
)
SELECT doc_id, size, source_size, target,
  (least(greatest(cut - start, 0), size) + least(greatest(cut - start - cell, 0), size))::BIGINT AS taken
FROM line
"""

ORACLE["op8_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

ORACLE["op10_near_dedup"] = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))) END AS s
  FROM words
), flat AS (
  SELECT doc_id, unnest(s) AS shingle FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM flat AS a JOIN flat AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sets AS x ON x.doc_id = a JOIN sets AS y ON y.doc_id = b
  WHERE 100 * common >= 85 * (len(x.s) + len(y.s) - common)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), component AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, component_id = doc_id AS kept
FROM sets JOIN component USING (doc_id)
"""

_CRC = """crc AS (
  -- the 256 entries of the CRC-32 table by its rule
  SELECT list_transform(range(256), lambda n: list_reduce(range(8), lambda c, k:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n)) AS t
)"""


def _crc32(text: str) -> str:
    codes = f"list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)"
    return f"xor(list_reduce({codes}, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295)"


def _offer(place: str, cost: str, letters: str) -> str:
    """A way on from a place: its cost in six digits, then its audit; '~' is no way."""
    return f"CASE WHEN {place} = '~' OR ({cost}) IS NULL THEN '~' ELSE printf('%06d', {place}[1:6]::INT + {cost}) || {place}[7:] || '{letters}' END"


def _least(*offers: str) -> str:
    return f"least({', '.join(offers)})"


_KEEP = "CASE WHEN NOT must_go AND initial = '{}' THEN late END"
_RENAME = "CASE WHEN NOT must_go THEN 2 + late END"

ORACLE["op11_conversation_repair"] = f"""
WITH RECURSIVE {_CRC}, fated AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fate
  FROM conversations, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM fated, range(CASE fate WHEN 3 THEN 2 ELSE 1 END) WHERE fate <> 0
), lined AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), judged AS (
  SELECT *, rtrim(text, ' \t\n\v\f\r') AS t,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before
  FROM lined
), faults AS (
  SELECT *, role[1] AS initial, t = '' AS blank, t <> '' AND again AS duplicate,
    t <> '' AND NOT again AND t[-1] NOT IN ('.', '!', '?') AS truncated,
    t = '' OR again AS must_go, (t <> '' AND NOT again AND t[-1] NOT IN ('.', '!', '?'))::INT AS late,
    coalesce(before || role[1] NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM judged
), walk AS (
  -- the four places of the grammar after turn i, each before any inserted turn
  SELECT DISTINCT conv_id, 0::BIGINT AS i, '000000' AS q, '~' AS s, '~' AS u, '~' AS a FROM conversations
  UNION ALL
  SELECT conv_id, i,
    {_offer("q", "3", "D")},
    {_least(_offer("s", "3", "D"), _offer("q", _KEEP.format("s"), "K"))},
    {_least(_offer("u1", "3", "D"), *[_offer(x, _KEEP.format("u"), "K") for x in ("q", "s", "a1")], *[_offer(x, _RENAME, "R") for x in ("q", "s", "a1")])},
    {_least(_offer("a1", "3", "D"), _offer("u1", _KEEP.format("a"), "K"), _offer("u1", _RENAME, "R"))}
  FROM (
    SELECT w.conv_id, f.i, q, s, u1, {_least("a", _offer("u1", "2", "I"))} AS a1, initial, must_go, late
    FROM (SELECT *, {_least("u", _offer("q", "2", "I"), _offer("s", "2", "I"), _offer("a", "2", "I"))} AS u1 FROM walk) AS w
    JOIN faults AS f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
  )
), last AS (
  SELECT conv_id, max_by({_least("q", "a", _offer("u", "2", "I"), _offer("q", "4", "II"), _offer("s", "4", "II"))}, i) AS best FROM walk GROUP BY conv_id
), edits AS (
  SELECT conv_id, k, best[6 + k] AS edit, sum((best[6 + k] <> 'I')::INT) OVER (PARTITION BY conv_id ORDER BY k) AS i
  FROM last, range(1, 1 + len(best) - 6) AS r(k)
), told AS (
  SELECT e.conv_id, k, edit, CASE WHEN edit = 'I' THEN '' ELSE text END AS text, CASE WHEN edit = 'K' THEN role END AS role,
    row_number() OVER (PARTITION BY e.conv_id ORDER BY k)
      - coalesce(max(CASE WHEN edit = 'K' AND initial = 's' THEN 1 END) OVER (PARTITION BY e.conv_id), 0) AS place
  FROM edits AS e LEFT JOIN faults AS f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i WHERE edit <> 'D'
), texts AS (
  SELECT conv_id, string_agg(coalesce(role, CASE place % 2 WHEN 1 THEN 'user' ELSE 'assistant' END) || ':' || text, chr(10) ORDER BY k) AS repaired
  FROM told GROUP BY conv_id
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, sum(blank::INT)::BIGINT AS blank,
    sum(duplicate::INT)::BIGINT AS duplicate, sum(truncated::INT)::BIGINT AS truncated, sum(illegal::INT)::BIGINT AS illegal
  FROM faults GROUP BY conv_id
)
SELECT l.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best[1:6]::BIGINT AS cost, best[7:] AS audit,
  sha256(coalesce(repaired, '')) AS repaired_sha256
FROM last AS l LEFT JOIN counted AS c ON c.conv_id IS NOT DISTINCT FROM l.conv_id LEFT JOIN texts AS t ON t.conv_id IS NOT DISTINCT FROM l.conv_id
"""

ORACLE["op13_hard_negatives"] = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), anchors AS (
  SELECT * FROM whole WHERE vec_id % 100 = 0
), positives AS (
  SELECT a.vec_id AS anchor_id, a.label, a.vec, w.vec_id AS positive_id, list_inner_product(a.vec, w.vec)::BIGINT AS positive_score
  FROM anchors AS a JOIN whole AS w ON w.label = a.label AND w.vec_id <> a.vec_id
  QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY positive_score DESC, w.vec_id) <= 5
), scored AS (
  SELECT a.vec_id AS anchor_id, w.vec_id AS negative_id, list_inner_product(a.vec, w.vec)::BIGINT AS negative_score
  FROM anchors AS a JOIN whole AS w ON w.label <> a.label
)
SELECT anchor_id, positive_id, (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id))::INT AS rank,
  negative_id, positive_score, negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE 30 * positive_score <= 100 * negative_score AND 100 * negative_score <= 90 * positive_score
QUALIFY rank <= 10
"""

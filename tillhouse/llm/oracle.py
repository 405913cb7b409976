"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

MIX = r"""
WITH sized AS (
  SELECT doc_id, source, text, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
  FROM sized GROUP BY source
), leveled AS (
  SELECT *, 3 * source_size AS cap,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sources
  WINDOW before AS (ORDER BY 3.0 * source_size / weight, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), planned AS (
  SELECT source, source_size,
    CASE WHEN cap <= weight * level THEN cap::DOUBLE
      ELSE weight * (arg_min(level, 3.0 * source_size / weight) FILTER (cap > weight * level) OVER ()) END AS target
  FROM leveled
), ranked AS (
  SELECT doc_id, source, size, row_number() OVER (
      PARTITION BY source
      ORDER BY CASE WHEN size < 1 THEN -1 ELSE floor(log2(size) * 8) END,
        digest % 64, digest // 64 % 64, size, doc_id) AS place
  FROM (SELECT *, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 8))::BIGINT & 2147483647 AS digest FROM sized)
), met AS (
  SELECT doc_id, size, source_size, target, place,
    CASE WHEN source_size > 0 THEN round(target / source_size * 16777216) ELSE 0 END::BIGINT AS expected,
    (('0x' || substr(md5('7|' || coalesce(r.source, chr(0))), 1, 8))::BIGINT & 2147483647) % 16777216 AS shift
  FROM ranked r JOIN planned p ON r.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  size * (((place * expected + shift) >> 24) - (((place - 1) * expected + shift) >> 24)) AS taken
FROM met
"""

WARC = """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS bytes, sha256(coalesce(html, '')) AS digest FROM pages
), first AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest) AS original FROM p
)
SELECT page_id, bytes::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN bytes >= 100 AND page_id IS DISTINCT FROM original AND original IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN bytes >= 100 AND page_id IS DISTINCT FROM original THEN original END AS refers_to
FROM first
"""

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# The ten words from a place on; whole texts are never carried beside a word.
_AHEAD = "[w, " + ", ".join(f"lead(w, {i}) OVER next" for i in range(1, 10)) + "]"

DECONTAMINATE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, {_WORDS.format('text')} AS words FROM documents
), items AS (
  SELECT row_number() OVER () AS row, item_id::VARCHAR AS item_id, {_WORDS.format('text')} AS words FROM benchmark
), doc_words AS (
  SELECT row, len(words) AS n, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM docs
), item_words AS (
  SELECT row, item_id, len(words) AS n, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM items
), item_places AS (
  SELECT item_id, n, pos, {_AHEAD} AS ahead FROM item_words WINDOW next AS (PARTITION BY row ORDER BY pos)
), windows AS (
  SELECT DISTINCT item_id, least(n, 10) AS size, array_to_string(ahead[1:least(n, 10)], ' ') AS phrase
  FROM item_places WHERE pos + least(n, 10) - 1 <= n
), sizes AS (SELECT DISTINCT size FROM windows),
doc_places AS (
  SELECT row, n, pos, {_AHEAD} AS ahead FROM doc_words WINDOW next AS (PARTITION BY row ORDER BY pos)
), places AS (
  SELECT row, size, pos, array_to_string(ahead[1:size], ' ') AS phrase FROM doc_places, sizes WHERE pos + size - 1 <= n
), found AS (
  SELECT row, pos, size, item_id FROM places JOIN windows USING (size, phrase)
), hits AS (
  SELECT row, count(DISTINCT word) AS n_hit
  FROM (SELECT row, unnest(range(pos, pos + size)) AS word FROM found) GROUP BY row
), named AS (
  SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT row, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY row
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (row) LEFT JOIN named USING (row)
"""

_BLOCK = r"(?i)</?(?:p|div|li|ul|ol|h[1-6]|br|tr|table|nav|header|footer|article|section|title|body|head|html)\b[^>]*>"
_VISIBLE = "html"
for _pattern, _by in (
    (r"(?s)<!--.*?-->", "''"),
    (r"(?is)<script\b.*?</script\s*>", "''"),
    (r"(?is)<style\b.*?</style\s*>", "''"),
    (_BLOCK, "chr(10)"),
    (r"<[^>]*>", "''"),
):
    _VISIBLE = f"regexp_replace({_VISIBLE}, '{_pattern}', {_by}, 'g')"

LINES = rf"""
WITH p AS (
  SELECT row_number() OVER () AS row, page_id,
    nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '') AS host,
    string_split({_VISIBLE}, chr(10)) AS line
  FROM pages
), held AS (
  SELECT row, page_id, host, pos, line[pos] AS line, trim(line[pos], ' ' || chr(9) || chr(13)) AS bare
  FROM (SELECT *, unnest(range(1, len(line) + 1)) AS pos FROM p)
), totals AS (
  SELECT host, count(*) AS pages FROM p GROUP BY host
), dropped AS (
  SELECT h.host, bare FROM held h JOIN totals t ON h.host IS NOT DISTINCT FROM t.host
  WHERE bare <> '' GROUP BY h.host, bare, pages
  HAVING count(DISTINCT row) >= 5 AND count(DISTINCT row) > pages * CAST(0.1 AS DOUBLE)
), marked AS (
  SELECT h.*, d.bare IS NOT NULL AS gone FROM held h
  LEFT JOIN dropped d ON h.host IS NOT DISTINCT FROM d.host AND h.bare = d.bare
)
SELECT p.page_id, p.host, coalesce(len(p.line), 0)::BIGINT AS n_lines,
  coalesce(count(*) FILTER (gone), 0)::BIGINT AS n_dropped,
  CASE WHEN any_value(p.line) IS NULL THEN NULL
    ELSE coalesce(string_agg(marked.line, chr(10) ORDER BY pos) FILTER (NOT gone), '') END AS text
FROM p LEFT JOIN marked USING (row)
GROUP BY p.row, p.page_id, p.host, len(p.line)
"""

PHRASES = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER.format('text')}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), split AS (
  SELECT row_number() OVER () AS nr, lang, list_filter(string_split_regex(piece, '[ \x09]+'), lambda w: w <> '') AS words FROM pieces
), words AS (
  SELECT nr, lang, unnest(words) AS w, generate_subscripts(words, 1) AS pos FROM split
), ahead AS (
  SELECT lang, w AS w1, lead(w, 1) OVER p AS w2, lead(w, 2) OVER p AS w3, lead(w, 3) OVER p AS w4, lead(w, 4) OVER p AS w5
  FROM words WINDOW p AS (PARTITION BY nr ORDER BY pos)
), grams AS (
  SELECT lang, 1 AS k, w1 AS phrase FROM ahead
  UNION ALL SELECT lang, 2, w1 || ' ' || w2 FROM ahead WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3 FROM ahead WHERE w3 IS NOT NULL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 FROM ahead WHERE w4 IS NOT NULL
  UNION ALL SELECT lang, 5, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4 || ' ' || w5 FROM ahead WHERE w5 IS NOT NULL
), f AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS words, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 100
), totals AS (
  SELECT lang, count(*) AS n FROM words GROUP BY lang
), cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, i AS cut, x.f AS l, y.f AS r, n, (1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f) AS score
  FROM f c JOIN totals t ON t.lang = c.lang, LATERAL (SELECT unnest(range(1, k)) AS i) s
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.words[1:i], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.words[i + 1:], ' ')
  WHERE NOT EXISTS (
    SELECT 1 FROM f b WHERE b.lang = c.lang AND b.k = c.k + 1 AND b.f = c.f
      AND (array_to_string(b.words[1:c.k], ' ') = c.phrase OR array_to_string(b.words[2:], ' ') = c.phrase)
  )
), least AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
)
SELECT lang, row_number() OVER best AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM least WINDOW best AS (PARTITION BY lang ORDER BY score DESC, a DESC, phrase)
QUALIFY row_number() OVER best <= 2000
"""


_SPACES = r"' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

CONVERSATIONS = rf"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
    lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) ORDER BY i) AS t
  FROM range(256) r(i)
), harmed AS (
  SELECT coalesce('c' || conv_id, '') AS ckey, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295, list_transform(
        string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
      lambda x, y: xor(x >> 8, t[(xor(x, y) & 255) + 1])), 4294967295) % 20 AS harm
  FROM conversations, crc
), damaged AS (
  SELECT ckey, turn, CASE WHEN harm = 4 THEN 'user' ELSE role END AS role,
    CASE harm WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE harm WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM harmed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY ckey ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
    right(rtrim(text, {_SPACES}), 1) AS last
  FROM damaged
), judged AS (
  SELECT *, role[1] AS initial,
    CASE WHEN last = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY ckey, role, text ORDER BY pos) > 1 THEN 'duplicate'
      WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    coalesce(lag(role[1]) OVER (PARTITION BY ckey ORDER BY pos) || role[1] NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM placed
), keeps(s, initial, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
turns(s, t, name) AS (VALUES (0, 2, 'user:'), (1, 2, 'user:'), (2, 3, 'assistant:'), (3, 2, 'user:')),
inserts AS (
  SELECT s, s AS t, 0 AS cost, '' AS audit, '' AS lines FROM turns
  UNION ALL SELECT s, t, 3, 'I', name || chr(10) FROM turns
  UNION ALL SELECT a.s, b.t, 6, 'II', a.name || chr(10) || b.name || chr(10) FROM turns a JOIN turns b ON a.t = b.s
), walk AS (
  SELECT DISTINCT ckey, 0::BIGINT AS nth, 0 AS state, {{'cost': 0, 'audit': '', 'lines': ''}} AS way FROM placed
  UNION ALL
  SELECT ckey, nth, state, min({{'cost': cost, 'audit': audit, 'lines': lines}}) FROM (
    SELECT w.ckey, w.nth + 1 AS nth, e.t AS state, w.way.cost + i.cost + e.cost AS cost, w.way.audit || i.audit || e.edit AS audit,
      w.way.lines || i.lines || e.line AS lines
    FROM walk w JOIN inserts i ON i.s = w.state JOIN judged r ON r.ckey = w.ckey AND r.pos = w.nth + 1,
      LATERAL (
        SELECT i.t AS t, 4 AS cost, 'D' AS edit, '' AS line
        UNION ALL SELECT k.t, 3 * (r.fault = 'truncated')::INT, 'K', r.role || ':' || r.text || chr(10)
          FROM keeps k WHERE k.s = i.t AND k.initial = r.initial AND r.fault NOT IN ('blank', 'duplicate')
        UNION ALL SELECT x.t, 3 + 3 * (r.fault = 'truncated')::INT, 'R', x.name || r.text || chr(10)
          FROM turns x WHERE x.s = i.t AND r.fault NOT IN ('blank', 'duplicate')
      ) e
  ) GROUP BY ckey, nth, state
), sizes AS (
  SELECT ckey, count(*) AS n, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal,
    coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM judged GROUP BY ckey
), best AS (
  SELECT w.ckey, min({{'cost': w.way.cost + i.cost, 'audit': w.way.audit || i.audit, 'lines': w.way.lines || i.lines}}) AS way
  FROM walk w JOIN sizes z ON z.ckey = w.ckey AND z.n = w.nth JOIN inserts i ON i.s = w.state
  WHERE i.t IN (0, 3) GROUP BY w.ckey
)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0)::BIGINT AS cost,
  coalesce(way.audit, '') AS audit, sha256(coalesce(left(way.lines, greatest(length(way.lines) - 1, 0)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, ckey FROM harmed) c LEFT JOIN sizes USING (ckey) LEFT JOIN best USING (ckey)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_mix": MIX,
        "op4_warc": WARC,
        "op8_decontaminate": DECONTAMINATE,
        "op10_lines": LINES,
        "op11_phrases": PHRASES,
        "op12_conversations": CONVERSATIONS,
    }

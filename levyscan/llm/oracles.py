"""SQL that must give the rows of operators 11 to 13, written for DuckDB."""

_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: One row with the 256 remainders of the reflected CRC-32 polynomial.
_CRC_TABLE = """crc_table AS MATERIALIZED (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, x) ORDER BY x) AS t
  FROM range(256) AS r(x))"""


def _crc(text: str) -> str:
    """crc32 of a text column, next to `crc_table`."""
    code = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT"
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: {code})"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)"


BENCHMARK_LEAKS = f"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT item_id, w, least(len(w), 10) AS k, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWERED}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) AS w FROM documents),
doc_windows AS (
  SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM doc_words, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)),
met AS (SELECT doc_id, item_id, i, k FROM doc_windows JOIN windows USING (k, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM met) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

SPELLING_VARIANTS = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
  SELECT doc_id, run, count(*) AS times
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWERED}, '[a-z\\x{{00C0}}-\\x{{00FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, times, {_crc("doc_id::VARCHAR || ':' || run")} AS h FROM runs, crc_table),
written AS (
  SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed),
words AS MATERIALIZED (SELECT word, sum(times)::BIGINT AS n FROM written WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
less AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) AS front, substr(word, i + 1) AS back FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
longer AS (SELECT DISTINCT word AS a, front || back AS b FROM less SEMI JOIN words ON words.word = front || back),
near AS MATERIALIZED (
  SELECT a.word AS a, b.word AS b FROM less a JOIN less b USING (front, back) WHERE a.word <> b.word
  UNION SELECT a, b FROM longer UNION SELECT b, a FROM longer),
best AS (
  SELECT a AS word, count(*) AS n_near, max(n) AS form_n, min(b) FILTER (n = most) AS form
  FROM (SELECT a, b, n, max(n) OVER (PARTITION BY a) AS most FROM near JOIN words ON words.word = b) GROUP BY a),
formed AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * n THEN form END AS form, CASE WHEN form_n >= 10 * n THEN form_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
chain AS (
  SELECT word, form AS at FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.at WHERE formed.form IS NOT NULL),
ends AS (SELECT chain.word, chain.at AS root FROM chain JOIN formed ON formed.word = chain.at WHERE formed.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near::BIGINT AS n_near, form_n FROM formed LEFT JOIN ends USING (word)
"""

TURN_REPAIR = f"""
WITH RECURSIVE {_CRC_TABLE},
spaced AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS named FROM conversations),
marked AS (SELECT *, {_crc("named")} % 20 AS kind FROM spaced, crc_table),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, kind,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM marked WHERE kind <> 0),
given AS (SELECT * FROM damaged UNION ALL SELECT * FROM damaged WHERE kind = 3),
ids AS (SELECT conv_id, row_number() OVER () AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
told AS (
  SELECT c, turn, role, text, row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST) AS nth
  FROM given JOIN ids ON ids.conv_id IS NOT DISTINCT FROM given.conv_id),
rowed AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, nth) AS r FROM told),
rows_in AS MATERIALIZED (
  SELECT *, substr(role, 1, 1) AS ini,
         CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z') THEN 'truncated' ELSE '' END AS fault
  FROM rowed),
kept(s, ini, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
added(s, letters, price, t) AS (
  SELECT s, '', 0, s FROM range(4) AS x(s)
  UNION ALL VALUES (0, 'I', 3, 2), (1, 'I', 3, 2), (2, 'I', 3, 3), (3, 'I', 3, 2), (0, 'II', 6, 3), (1, 'II', 6, 3)),
best(c, r, s, path) AS (
  SELECT c, 0::BIGINT, t::BIGINT, lpad(price::VARCHAR, 9, '0') || letters FROM ids, added WHERE s = 0
  UNION ALL
  SELECT c, r, added.t::BIGINT, min(lpad((left(path, 9)::BIGINT + price)::VARCHAR, 9, '0') || substr(path, 10) || letters)
  FROM (
    SELECT c, r, s, min(lpad((cost + price)::VARCHAR, 9, '0') || audit || letter) AS path
    FROM (
      SELECT v.c, x.r, left(path, 9)::BIGINT AS cost, substr(path, 10) AS audit, 'D' AS letter, 4 AS price, v.s AS s
      FROM best v JOIN rows_in x ON x.c = v.c AND x.r = v.r + 1
      UNION ALL
      SELECT v.c, x.r, left(path, 9)::BIGINT, substr(path, 10), 'K', CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END, kept.t
      FROM best v JOIN rows_in x ON x.c = v.c AND x.r = v.r + 1 JOIN kept ON kept.s = v.s AND kept.ini = x.ini
      WHERE fault NOT IN ('blank', 'duplicate')
      UNION ALL
      SELECT v.c, x.r, left(path, 9)::BIGINT, substr(path, 10), 'R', CASE WHEN fault = 'truncated' THEN 6 ELSE 3 END, CASE WHEN v.s = 2 THEN 3 ELSE 2 END
      FROM best v JOIN rows_in x ON x.c = v.c AND x.r = v.r + 1
      WHERE fault NOT IN ('blank', 'duplicate'))
    GROUP BY c, r, s) AS read
  JOIN added ON added.s = read.s GROUP BY c, r, added.t),
sizes AS (SELECT c, count(*) AS m FROM rows_in GROUP BY c),
won AS MATERIALIZED (
  SELECT c, left(min(path), 9)::BIGINT AS cost, substr(min(path), 10) AS audit FROM best JOIN sizes USING (c) WHERE r = m AND s IN (0, 3) GROUP BY c),
letters AS (
  SELECT c, audit, i, substr(audit, i, 1) AS letter, i - length(replace(left(audit, i), 'I', '')) AS before,
         length(regexp_replace(left(audit, i), 'D', '', 'g')) AS place, length(regexp_replace(audit, 'D', '', 'g')) % 2 AS odd
  FROM (SELECT c, audit, unnest(range(1, length(audit) + 1)) AS i FROM won)),
repaired AS (
  SELECT l.c, sha256(string_agg(
    CASE WHEN letter = 'K' THEN x.role WHEN (place - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE x.text END,
    chr(10) ORDER BY l.i)) AS sha
  FROM letters l LEFT JOIN rows_in x ON x.c = l.c AND x.r = l.i - l.before WHERE letter <> 'D' GROUP BY l.c),
counted AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (r > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal
  FROM (SELECT *, lag(ini) OVER (PARTITION BY c ORDER BY r) AS before FROM rows_in) GROUP BY c)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM ids LEFT JOIN counted USING (c) LEFT JOIN won USING (c) LEFT JOIN repaired USING (c)
"""

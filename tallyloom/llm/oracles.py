"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op1_decontamination": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - least(13, len(w)) + 1)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i
        FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)
), hit AS (
  SELECT DISTINCT doc_id, item_id, i, n FROM dw JOIN iw USING (n, win)
), words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
}


def _collocations() -> str:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, list_filter(string_split_regex(piece, '[ \t]+'), lambda w: w <> '') AS w
  FROM (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(string_split_regex(translate(coalesce(text, ''), '{letters}', '{letters.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
  )
), sizes AS (
  SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang
), often AS MATERIALIZED (
  SELECT lang, w[i : i + m - 1] AS g, any_value(m) AS m, count(*) AS f
  FROM (
    SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS m) WHERE len(w) >= m
  ) GROUP BY ALL HAVING count(*) >= 100
), cuts AS (
  SELECT c.lang AS lang, c.g AS g, c.f AS a, k, x.f AS l, y.f AS r,
         (1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f) AS score, n
  FROM (SELECT lang, g, m, f, unnest(range(1, m)) AS k FROM often WHERE m > 1) c
  JOIN often x ON x.lang = c.lang AND x.g = c.g[1 : k]
  JOIN often y ON y.lang = c.lang AND y.g = c.g[k + 1 :]
  JOIN sizes ON sizes.lang = c.lang
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1
), held AS (
  SELECT lang, g, max(f) AS f FROM (
    SELECT lang, g[s : s + size - 1] AS g, f
    FROM (SELECT lang, g, f, m, size, unnest(range(1, m - size + 2)) AS s
          FROM often, (SELECT unnest([2, 3, 4]) AS size) WHERE size < m)
  ) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM (
  SELECT lowest.*, array_to_string(lowest.g, ' ') AS phrase
  FROM lowest LEFT JOIN held ON held.lang = lowest.lang AND held.g = lowest.g
  WHERE held.f IS NULL OR 100 * held.f < 100 * a
)
QUALIFY rank <= 2000
"""


def _spelling_variants() -> str:
    """CRC-32 bit by bit from its polynomial (a fixed value), near words by equal remainders after one deletion."""
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
WITH RECURSIVE steps AS (
  SELECT 0 AS k, i AS b, i AS c FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)
  UNION ALL
  SELECT k + 1, b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8
), runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{letters}', '{letters.lower()}'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents
  ) GROUP BY ALL
), checked AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, bytes), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM (
    SELECT run, n, list_transform(range(1, len(digits), 2), lambda i: CAST('0x' || digits[i : i + 1] AS BIGINT)) AS bytes
    FROM (SELECT run, n, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS digits FROM runs)
  ), crc
), words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT n, CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
    FROM checked
  ) WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), cut AS MATERIALIZED (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS INTEGER) AS i FROM words)
), near AS (
  SELECT DISTINCT a.word AS word, b.word AS other, b.n AS n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION ALL
  SELECT DISTINCT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION ALL
  SELECT DISTINCT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
), best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, other, n FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY n DESC, other) = 1
), formed AS MATERIALIZED (
  SELECT words.word AS word, words.n AS n, coalesce(n_near, 0) AS n_near,
         CASE WHEN best.n >= 2 * words.n THEN other END AS form, CASE WHEN best.n >= 2 * words.n THEN best.n END AS form_n
  FROM words LEFT JOIN best ON best.word = words.word
), way AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL
  SELECT way.word, way.next, f.form FROM way JOIN formed f ON f.word = way.next
)
SELECT formed.word AS word, form, root, n, n_near, form_n
FROM formed JOIN way ON way.word = formed.word AND way.next IS NULL
"""


ORACLES["op12_spelling_variants"] = _spelling_variants()
ORACLES["op13_collocations"] = _collocations()

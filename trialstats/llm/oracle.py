"""The queries that SQL can express, written independently of the Spark plans."""

from __future__ import annotations

# Phrases are counted whole, every length by itself, and joined with all of their parts.
COLLOCATIONS = r"""WITH docs AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents),
pieces AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs)),
grams AS (
  SELECT lang, k, list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' ')) AS phrases
  FROM pieces, range(1, 4) lengths(k) WHERE len(w) >= k),
f AS (SELECT lang, k, phrase, count(*) AS f FROM (SELECT lang, k, unnest(phrases) AS phrase FROM grams) GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.a, j, l.f AS l, r.f AS r,
         CAST((1000000::HUGEINT * c.a * c.a) // (l.f::HUGEINT * r.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')),
worst AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
longer AS (
  SELECT lang, phrase, max(a) AS a
  FROM (SELECT lang, array_to_string(w[1:k - 1], ' ') AS phrase, a FROM candidates
        UNION ALL SELECT lang, array_to_string(w[2:], ' ') AS phrase, a FROM candidates)
  GROUP BY lang, phrase),
kept AS (
  SELECT worst.* FROM worst LEFT JOIN longer ON longer.lang = worst.lang AND longer.phrase = worst.phrase
  WHERE longer.a IS NULL OR 100 * longer.a < 50 * worst.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""

# The check sum bit by bit from its polynomial; near words through strings with one code point left out.
SPELLING = r"""WITH RECURSIVE
bytes AS (
  SELECT b, list_reduce([b::BIGINT] || [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                        lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS crc
  FROM range(256) codes(b)),
crc_table AS (SELECT list(crc ORDER BY b) AS t FROM bytes),
runs AS (
  SELECT doc_id, run, count(*) AS c
  FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{00C0}-\x{00FF}]+')),
                                 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL),
hexed AS (SELECT run, c, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
summed AS (
  SELECT run, c, xor(4294967295, list_reduce(
    [4294967295::BIGINT] || list_transform(range(0, length(x) // 2), lambda i: CAST('0x' || substring(x, CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)),
    lambda acc, b: xor(acc >> 8, t[CAST(xor(acc, b) & 255 AS INTEGER) + 1]))) AS h
  FROM hexed, crc_table),
words AS (
  SELECT word, CAST(sum(c) AS BIGINT) AS n
  FROM (SELECT CASE WHEN h % 31 = 0 THEN substring(run, 1, CAST(h % length(run) AS INTEGER)) || substring(run, CAST(h % length(run) AS INTEGER) + 2)
                    ELSE run END AS word, c FROM summed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(c) >= 2),
holes AS (
  SELECT word, n, i, substring(word, 1, CAST(i AS INTEGER) - 1) || substring(word, CAST(i AS INTEGER) + 1) AS hole
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM holes a JOIN holes b ON a.hole = b.hole AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM holes a JOIN words b ON a.hole = b.word
  UNION SELECT b.word, a.word, a.n FROM holes a JOIN words b ON a.hole = b.word),
best AS (
  SELECT word, count(*) OVER (PARTITION BY word) AS n_near, near, near_n FROM pairs
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form,
         CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word),
followed AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT p.word, f.form FROM followed p JOIN formed f ON f.word = p.at WHERE f.form IS NOT NULL),
roots AS (SELECT p.word, p.at AS root FROM followed p JOIN formed f ON f.word = p.at WHERE f.form IS NULL)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM formed f JOIN roots r ON r.word = f.word"""


def oracle_sql() -> dict[str, str]:
    """SQL by query."""
    return {"op11_spelling": SPELLING, "op12_collocations": COLLOCATIONS}

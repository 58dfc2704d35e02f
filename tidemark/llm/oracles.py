"""SQL that DuckDB runs over the same tables for the queries that SQL can express."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

#: Every window of an item's length in a document that shares a shingle with it, compared by counts. Of equal ones, those
#: that a shared shingle lines up with the item come first.
LEAKS = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM documents
), items AS (
  SELECT DISTINCT item_id, regexp_extract_all(lower(coalesce(text, '')), '{WORD}') AS w FROM benchmark
), item_places AS (
  SELECT item_id, len(w) AS n, unnest(generate_series(0, len(w) - 5)) AS q, w FROM items WHERE len(w) >= 5
), item_shingles AS (
  SELECT item_id, n, q, array_to_string(w[q + 1:q + 5], ' ') AS s FROM item_places
), places AS (
  SELECT r, doc_id, len(w) AS m, unnest(generate_series(0, len(w) - 5)) AS p, w FROM docs WHERE len(w) >= 5
), shingles AS (
  SELECT r, doc_id, m, p, array_to_string(w[p + 1:p + 5], ' ') AS s FROM places
), lined AS (
  SELECT DISTINCT r, doc_id, item_id, m, least(n, m) AS n_words, n, greatest(0, least(p - q, m - least(n, m))) AS start
  FROM shingles JOIN item_shingles USING (s)
), spots AS (
  SELECT r, doc_id, item_id, n, n_words, m, start, bool_or(aligned) AS aligned FROM (
    SELECT *, true AS aligned FROM lined
    UNION ALL
    SELECT r, doc_id, item_id, m, n_words, n, unnest(generate_series(0, m - n_words)), false
    FROM (SELECT DISTINCT r, doc_id, item_id, m, n_words, n FROM lined)
  ) GROUP BY ALL
), held AS (
  SELECT x.r, x.doc_id, x.item_id, x.n, x.start, x.n_words, x.aligned, s.s, count(*) AS c
  FROM spots x JOIN shingles s ON s.r = x.r AND s.p >= x.start AND s.p <= x.start + x.n_words - 5
  GROUP BY ALL
), wanted AS (
  SELECT item_id, s, count(*) AS c FROM item_shingles GROUP BY ALL
), compared AS (
  SELECT r, doc_id, item_id, start, n_words, aligned, sum(least(h.c, coalesce(v.c, 0))) AS shared, sum(h.c) + any_value(h.n) - 4 AS sizes
  FROM held h LEFT JOIN wanted v USING (item_id, s) GROUP BY r, doc_id, item_id, start, n_words, aligned
), near AS (
  SELECT *, sizes - shared AS total FROM compared WHERE 100 * shared >= 75 * (sizes - shared)
)
SELECT doc_id, item_id, CAST(start AS INT) AS start, CAST(n_words AS INT) AS n_words, CAST(shared AS INT) AS shared,
       CAST(total AS INT) AS total, shared / total AS similarity
FROM near QUALIFY row_number() OVER (PARTITION BY r, item_id ORDER BY shared / total DESC, aligned DESC, start) = 1
"""

_LENGTH = "least(200, 10 * word_chars // greatest(1, n_words))"
_VALUES = {
    "symbols": "least(100, 100 * n_symbols // greatest(1, word_chars))",
    "dup_lines": "100 * n_dup_lines // greatest(1, n_lines)",
    "repeats": "100 * n_repeat_words // greatest(1, n_words)",
    "long_words": _LENGTH,
    "short_words": f"200 - {_LENGTH}",
}
_RULES = ", ".join(f"{{'rule': '{rule}', 'value': {value}}}" for rule, value in _VALUES.items())

#: Measures, sets of cutoffs laid down on one half of the good labelled documents, the strictest one of each stratum whose
#: exact binomial bound holds on the other half, and the verdicts.
QUALITY = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '{WORD}') AS w, string_split(t, chr(10)) AS l FROM texts
), lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT x) AS n_dup_lines
  FROM (SELECT r, unnest(l) AS x FROM split) WHERE regexp_matches(x, '{WORD}') GROUP BY r
), windows AS (
  SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
  FROM (SELECT r, w, unnest(generate_series(1, len(w) - 2)) AS i FROM split WHERE len(w) >= 3)
), twice AS (
  SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, a, b, c) > 1
), repeats AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, (VALUES (0), (1), (2)) AS v(k) GROUP BY r
), measures AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
  FROM split LEFT JOIN lines USING (r) LEFT JOIN repeats USING (r)
), scored AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CAST(n_words >= 100 AS INT) + CAST(n_words >= 300 AS INT) + CAST(n_words >= 1000 AS INT) AS stratum, unnest([{_RULES}], recursive := true) FROM measures
), good AS (
  SELECT doc_id FROM labels WHERE quality IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1
), held AS (
  SELECT *, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < '8' AS first
  FROM scored WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM good)
), counts AS (
  SELECT stratum, rule, value, count(*) AS n FROM held WHERE first GROUP BY ALL
), above AS (
  SELECT stratum, rule, value, sum(n) OVER (PARTITION BY stratum, rule) AS n,
         coalesce(sum(n) OVER (PARTITION BY stratum, rule ORDER BY value DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS k
  FROM counts
), steps AS (
  SELECT step, CASE WHEN step < 8 THEN CAST(0.01 AS DOUBLE) / power(2, step) ELSE 0 END AS part FROM (SELECT unnest(range(9)) AS step)
), sets AS (
  SELECT stratum, step, rule, min(value) AS cutoff FROM above, steps WHERE k <= part * n GROUP BY stratum, step, rule
), sizes AS (
  SELECT stratum, CAST(count(DISTINCT r) AS DOUBLE) AS n FROM held WHERE NOT first GROUP BY stratum
), seen AS (
  SELECT s.stratum, s.step, any_value(z.n) AS n, count(DISTINCT h.r) FILTER (h.value > s.cutoff) AS k
  FROM sets s JOIN sizes z USING (stratum) JOIN held h ON h.stratum = s.stratum AND h.rule = s.rule AND NOT h.first GROUP BY s.stratum, s.step
), bounded AS (
  SELECT stratum, step, (
    SELECT sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln(0.01) + (n - i) * ln(0.99)))
    FROM (SELECT CAST(unnest(generate_series(0, CAST(k AS BIGINT))) AS DOUBLE) AS i)
  ) AS chance
  FROM seen WHERE k < n * 0.01
), cutoffs AS (
  SELECT stratum, rule, cutoff FROM sets
  JOIN (SELECT stratum, min(step) AS step FROM bounded WHERE chance <= 0.05 / 36 GROUP BY stratum) USING (stratum, step)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND count(cutoff) FILTER (value > cutoff) = 0 AS kept,
       coalesce(string_agg(rule, ',' ORDER BY rule) FILTER (value > cutoff), '') AS rejected_by
FROM scored LEFT JOIN cutoffs USING (stratum, rule)
GROUP BY r, doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed
"""

#: Every phrase counted, every cut scored, every shorter phrase held against the longer ones around it.
COLLOCATIONS = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS p, lang, piece FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece
    FROM documents)
), words AS (
  SELECT p, lang, unnest(w) AS w1, unnest(generate_series(1, len(w))) AS i
  FROM (SELECT p, lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM pieces)
), places AS (
  SELECT p, lang, w1, lead(w1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY p ORDER BY i)
), ones AS (SELECT lang, w1, count(*) AS a FROM places GROUP BY ALL
), twos AS (SELECT lang, w1, w2, count(*) AS a FROM places WHERE w2 IS NOT NULL GROUP BY ALL
), threes AS (SELECT lang, w1, w2, w3, count(*) AS a FROM places WHERE w3 IS NOT NULL GROUP BY ALL HAVING count(*) >= 10
), covered AS (
  SELECT lang, w1, w2, max(a) AS longer
  FROM (SELECT lang, w1, w2, a FROM threes UNION ALL SELECT lang, w2, w3, a FROM threes) GROUP BY ALL
), cuts AS (
  SELECT t.lang, t.w1 || ' ' || t.w2 AS phrase, t.a, l.a AS l, r.a AS r, 1 AS k
  FROM twos t JOIN ones l ON l.lang = t.lang AND l.w1 = t.w1 JOIN ones r ON r.lang = t.lang AND r.w1 = t.w2
       LEFT JOIN covered c ON c.lang = t.lang AND c.w1 = t.w1 AND c.w2 = t.w2
  WHERE t.a >= 10 AND (c.longer IS NULL OR 100 * c.longer < 50 * t.a)
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, l.a, r.a, 1
  FROM threes t JOIN ones l ON l.lang = t.lang AND l.w1 = t.w1 JOIN twos r ON r.lang = t.lang AND r.w1 = t.w2 AND r.w2 = t.w3
  UNION ALL
  SELECT t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.a, l.a, r.a, 2
  FROM threes t JOIN twos l ON l.lang = t.lang AND l.w1 = t.w1 AND l.w2 = t.w2 JOIN ones r ON r.lang = t.lang AND r.w1 = t.w3
), scored AS (
  SELECT *, CAST((CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS BIGINT) AS score FROM cuts
), lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score FROM lowest
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op4_simhash_decontamination": LEAKS,
    "op6_risk_controlled_quality": QUALITY,
    "op13_collocations": COLLOCATIONS,
}

"""SQL twins for DuckDB, for the operators that SQL can express over whole tables in reasonable time.

Removing repeated bytes has none: a window per byte takes minutes where Spark takes seconds.
"""

from __future__ import annotations

_WORDS = r"""coalesce(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'), [])"""

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_JACCARD = rf"""WITH RECURSIVE
  d AS MATERIALIZED (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
  grams AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM d, unnest(range(1, len(w) - 2)) AS t(i) WHERE len(w) >= 4
    UNION ALL SELECT doc_id, array_to_string(w, ' ') || ' (whole)' FROM d WHERE len(w) BETWEEN 1 AND 3),
  sizes AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
  both_of AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
              GROUP BY 1, 2),
  links AS MATERIALIZED (SELECT a, b FROM both_of JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
                         WHERE 100 * c >= 85 * (x.n + y.n - c)),
  reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, (SELECT min(b) FROM reach WHERE reach.a = d.doc_id) AS component_id
FROM d LEFT JOIN sizes ON sizes.doc_id = d.doc_id"""

# Windows that repeat an earlier one, united to runs of what they cover: doc_id, s (first place), e (behind the last).
_RUNS = """runs AS MATERIALIZED (
    SELECT doc_id, min(i) AS s, max(i) + {size} AS e FROM (
      SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
        SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + {size} THEN 0 ELSE 1 END AS fresh FROM again))
    GROUP BY doc_id, run)"""

WORD_WINDOWS = rf"""WITH
  d AS MATERIALIZED (SELECT doc_id, {_WORDS.format("text")} AS w FROM documents),
  windows AS MATERIALIZED (
    SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k FROM d, unnest(range(1, len(w) - 11)) AS t(i)),
  firsts AS (SELECT k, min(doc_id) AS m FROM windows GROUP BY k),
  again AS (SELECT doc_id, i FROM windows JOIN firsts USING (k) WHERE m < doc_id),
  {_RUNS.format(size=13)},
  removed AS (SELECT doc_id, sum(e - s) AS n FROM runs GROUP BY doc_id),
  kept AS (
    SELECT d.doc_id, string_agg(w[p], ' ' ORDER BY p) AS text FROM d, unnest(range(1, len(w) + 1)) AS t(p)
    WHERE NOT EXISTS (SELECT 1 FROM runs WHERE runs.doc_id = d.doc_id AND p >= s AND p < e) GROUP BY d.doc_id)
SELECT d.doc_id, len(w) AS n_words, CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN removed ON removed.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

# CRC-32 byte by byte over distinct words, with the table of its polynomial; a step of the recursion is a byte.
IMPORTANCE = rf"""WITH RECURSIVE
  bits(b, k, c) AS (
    SELECT CAST(b AS BIGINT), 0, CAST(b AS BIGINT) FROM range(256) t(b)
    UNION ALL SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
  crc_table AS MATERIALIZED (SELECT b, c FROM bits WHERE k = 8),
  d AS MATERIALIZED (
    SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
  used AS MATERIALIZED (SELECT doc_id, unnest(w) AS f FROM d),
  aimed AS MATERIALIZED (SELECT unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS f FROM benchmark),
  words AS (SELECT DISTINCT f FROM (SELECT f FROM used UNION ALL SELECT f FROM aimed)),
  steps(f, hx, i, c) AS (
    SELECT f, hex(f), 0, CAST(4294967295 AS BIGINT) FROM words
    UNION ALL SELECT f, hx, i + 1, xor(steps.c >> 8, t.c) FROM steps
      JOIN crc_table t ON t.b = xor(steps.c & 255, CAST('0x' || substr(hx, 2 * i + 1, 2) AS BIGINT)) WHERE 2 * i < length(hx)),
  bucket_of AS MATERIALIZED (SELECT f, xor(c, 4294967295) % 10000 AS b FROM steps WHERE 2 * i = length(hx)),
  s_of AS (SELECT b, count(*) AS s FROM used JOIN bucket_of USING (f) GROUP BY b),
  t_of AS (SELECT b, count(*) AS t FROM aimed JOIN bucket_of USING (f) GROUP BY b),
  gain_of AS MATERIALIZED (
    SELECT b, CAST(floor(1000 * ln((coalesce(t, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM used) + 10000)
      / ((coalesce(s, 0) + 1.0::DOUBLE) * ((SELECT count(*) FROM aimed) + 10000)))) AS BIGINT) AS gain
    FROM (SELECT DISTINCT b FROM bucket_of) LEFT JOIN s_of USING (b) LEFT JOIN t_of USING (b)),
  weight_of AS (
    SELECT doc_id, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
    FROM used JOIN bucket_of USING (f) JOIN gain_of USING (b) GROUP BY doc_id),
  noise AS (
    SELECT doc_id, len(w) AS n_features, CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM d),
  scored AS MATERIALIZED (
    SELECT doc_id, n_features, coalesce(weight, 0) AS weight,
      coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score
    FROM noise LEFT JOIN weight_of USING (doc_id)),
  ranked AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT scored.*, r AS rank FROM scored LEFT JOIN (SELECT doc_id, r FROM ranked WHERE r <= 10 * n // 100) USING (doc_id)"""

# A run of 24 words and three periods shares 16 words or more with itself one period on, so equal stretches of 16 words
# are paired within each text; pairs that stand side by side, the same distance apart, make one stretch. DuckDB has no
# CRC-32, so it is worked out digit by digit.
PERIODIC_RUNS = rf"""WITH RECURSIVE
  bits(b, k, c) AS (
    SELECT CAST(b AS BIGINT), 0, CAST(b AS BIGINT) FROM range(256) t(b)
    UNION ALL SELECT b, k + 1, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
  crc_table AS MATERIALIZED (SELECT b, c FROM bits WHERE k = 8),
  steps(doc_id, digits, i, c) AS (
    SELECT doc_id, CAST(doc_id AS VARCHAR), 1, CAST(4294967295 AS BIGINT) FROM documents
    UNION ALL SELECT doc_id, digits, i + 1, xor(steps.c >> 8, t.c) FROM steps
      JOIN crc_table t ON t.b = xor(steps.c & 255, ascii(substr(digits, i, 1))) WHERE i <= length(digits)),
  hashed AS MATERIALIZED (SELECT doc_id, xor(c, 4294967295) AS h FROM steps WHERE i > length(digits)),
  given AS (
    SELECT doc_id, h, h // 10 AS g, {_WORDS.format("text")} AS w, len(w) AS n, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a,
      1 + (n - a) // (3 + g % 8) AS p FROM documents JOIN hashed USING (doc_id)),
  d AS MATERIALIZED (
    SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] FOR i IN range(n)]
      ELSE w END AS w FROM given),
  grams AS MATERIALIZED (
    SELECT doc_id, i, array_to_string(w[i + 1:i + 16], ' ') AS k FROM d, unnest(range(0, n - 15)) AS t(i)),
  pairs AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.k = y.k AND x.i < y.i),
  stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + 15 + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island),
  runs AS MATERIALIZED (
    SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= 24 AND length >= 3 * q GROUP BY doc_id, start, length),
  best AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed
    FROM runs GROUP BY doc_id),
  longest AS (
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS r FROM runs) WHERE r = 1),
  gone AS (SELECT DISTINCT doc_id, p FROM runs, unnest(range(start + period, start + length)) AS t(p)),
  kept AS (
    SELECT d.doc_id, string_agg(w[p + 1], ' ' ORDER BY p) AS text FROM d, unnest(range(0, n)) AS t(p)
    WHERE NOT EXISTS (SELECT 1 FROM gone WHERE gone.doc_id = d.doc_id AND gone.p = t.p) GROUP BY d.doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM d LEFT JOIN best ON best.doc_id = d.doc_id LEFT JOIN longest ON longest.doc_id = d.doc_id LEFT JOIN kept ON kept.doc_id = d.doc_id"""

EXACT_DEDUP = r"""WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  row_number() OVER (PARTITION BY norm ORDER BY doc_id) = 1 AS kept, sha256(norm) AS text_sha256
FROM d WINDOW same AS (PARTITION BY norm)"""

ORACLES: dict[str, str] = {
    "op2_ngram_jaccard": NGRAM_JACCARD,
    "op8_word_windows": WORD_WINDOWS,
    "op11_importance": IMPORTANCE,
    "op12_periodic_runs": PERIODIC_RUNS,
    "op13_exact_dedup": EXACT_DEDUP,
}

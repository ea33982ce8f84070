"""DuckDB SQL of the vector clusters, the periodic runs and the license scan."""

from __future__ import annotations

from dockflow.llm import centroids, license_scan


def clusters_sql(rounds: int = centroids.ROUNDS) -> str:
    """All rounds spelt out; sums are exact, division rounds down."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
far{r} AS (
  SELECT v.r, v.vec_id, c.k, CAST(list_sum(list_transform(range(1, 65), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i]))) AS BIGINT) AS d
  FROM v CROSS JOIN c{r} c
),
near{r} AS MATERIALIZED (SELECT r, vec_id, k, d FROM far{r} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, k) = 1)""")
        if r < rounds:
            steps.append(f"""
sums{r} AS (
  SELECT k, pos, sum(x) AS s, count(*) AS n
  FROM near{r} JOIN (SELECT r, unnest(e) AS x, unnest(range(1, 65)) AS pos FROM v) USING (r)
  GROUP BY k, pos
),
means{r} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS e FROM sums{r} GROUP BY k),
c{r + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.e, c.e) AS e FROM c{r} c LEFT JOIN means{r} m USING (k))""")
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT)) AS e
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
c0 AS MATERIALIZED (
  SELECT k, e FROM (SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')), e) - 1 AS k, e FROM v) WHERE k < 8
),{",".join(steps)}
SELECT vec_id, CAST(k AS INTEGER) AS cluster, d AS distance,
       CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM near{rounds} JOIN c{rounds} c USING (k)
"""


#: CRC-32 by its table, which a rule makes: eight shifts of each byte.
CRC32 = """
crc AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(CAST(b AS UBIGINT), list_transform(range(8), lambda i: CAST(0 AS UBIGINT))),
    lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END)) AS t
)"""

PERIODIC_RUNS = f"""
WITH {CRC32},
ids AS (SELECT DISTINCT coalesce(CAST(doc_id AS VARCHAR), '') AS name FROM documents),
hashed AS (
  SELECT name, xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(name, ''), lambda x: CAST(ascii(x) AS UBIGINT))),
    lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS BIGINT) + 1])), 4294967295::UBIGINT) AS h
  FROM ids, crc
),
given AS (
  SELECT row_number() OVER () AS r, doc_id, CAST(h AS BIGINT) AS h, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents JOIN hashed ON name = coalesce(CAST(doc_id AS VARCHAR), '')
),
placed AS (SELECT *, (h // 10) % greatest(len(w), 1) AS a, h // 10 % 8 AS m FROM given),
d AS MATERIALIZED (
  SELECT r, doc_id, CASE WHEN h % 10 = 0 AND len(w) > 0
    THEN list_transform(range(len(w)), lambda i: CASE WHEN i >= a THEN w[a + (i - a) % (1 + (len(w) - a) // (3 + m)) + 1] ELSE w[i + 1] END) ELSE w END AS w
  FROM placed
),
grams AS MATERIALIZED (SELECT r, i, array_to_string(w[i + 1:i + 8], ' ') AS g FROM (SELECT r, w, unnest(range(len(w) - 7)) AS i FROM d WHERE len(w) >= 24)),
-- Places p apart with equal words for eight words; a run has them throughout.
pairs AS (SELECT a.r, b.i - a.i AS p, a.i FROM grams a JOIN grams b ON a.r = b.r AND a.g = b.g AND a.i < b.i),
islands AS (SELECT r, p, min(i) AS start, max(i) - min(i) + 8 + p AS n FROM (
  SELECT *, i - row_number() OVER (PARTITION BY r, p ORDER BY i) AS island FROM pairs) GROUP BY r, p, island),
runs AS MATERIALIZED (SELECT r, start, n, min(p) AS p FROM islands WHERE n >= 24 AND n >= 3 * p GROUP BY r, start, n),
best AS (SELECT r, start, n, p FROM runs QUALIFY row_number() OVER (PARTITION BY r ORDER BY (n * 1000000000 // p) DESC, start, p) = 1),
listed AS (SELECT r, count(*) AS k, sha256(string_agg(start || ',' || n || ',' || p || chr(10), '' ORDER BY start, p)) AS h FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + p, start + n)) AS i FROM runs),
words AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(k, 0) AS n_runs, start, n AS length, p AS period, 1000 * n // p AS exponent_milli,
       coalesce(listed.h, sha256('')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM d LEFT JOIN best USING (r) LEFT JOIN listed USING (r) LEFT JOIN kept USING (r)
"""


def licenses_sql(templates: list = license_scan.TEMPLATES) -> str:
    """Every block against every template, and every place against every phrase."""
    listed = lambda words: "[" + ", ".join(f"'{w}'" for w in words) + "]"
    rows = ",\n".join(f"({i}, '{t.label}', {t.phrase}, {t.tenths}, {listed(license_scan.words_of(t.text))})" for i, t in enumerate(templates))
    width = max(len(license_scan.words_of(t.text)) for t in templates)
    return rf"""
WITH templates(no, label, phrase, tenths, w) AS (VALUES {rows}),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
places AS (
  SELECT r, label, i FROM (SELECT r, w AS words, unnest(range(len(w))) AS i FROM d) x JOIN templates t ON phrase AND words[x.i + 1] = t.w[1]
  WHERE words[x.i + 1:x.i + len(t.w)] = t.w
),
blocks AS (SELECT r, list_distinct(w[b * {width} + 1:b * {width} + {2 * width}]) AS w FROM (SELECT r, w, unnest(range((len(w) + {width - 1}) // {width})) AS b FROM d)),
shares AS (
  SELECT r, label, len(list_intersect(blocks.w, t.w)) / len(list_distinct(t.w)) AS share
  FROM blocks JOIN templates t ON NOT phrase AND 10 * len(list_intersect(blocks.w, t.w)) >= tenths * len(list_distinct(t.w))
),
based AS (SELECT r, count(*) AS n, min(i) AS a, max(i) AS b, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY r),
more AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT r, label, share FROM shares UNION ALL SELECT r, label, 1.0 FROM places) GROUP BY r
)
SELECT doc_id, len(d.w) AS n_words, coalesce(n, 0) AS n_base, a AS first_word, b AS last_word,
       coalesce(based.labels, '') AS base_labels, coalesce(more.labels, '') AS labels, CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN based USING (r) LEFT JOIN more USING (r)
"""

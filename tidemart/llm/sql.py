"""SQL for comparison, for the queries that SQL can express; plain forms without any index."""

from __future__ import annotations

from tidemart.llm.licenses import TEMPLATES


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _license_sql() -> str:
    rows = ",\n".join(
        f"({i}, '{t.label}', {_list(t.words)}, {_list(sorted(set(t.words)))}, {t.needed}, {t.phrase}, "
        f"{t.stride})" for i, t in enumerate(TEMPLATES))
    return f"""
WITH templates(t, label, phrase, tokens, needed, consecutive, stride) AS (VALUES {rows}),
docs AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
blocks AS (
  SELECT r, stride, unnest(range(0, greatest(1, cast(ceil((len(w) - stride) / stride) AS bigint)))) AS b
  FROM docs, (SELECT DISTINCT stride FROM templates)),
cut AS (
  SELECT r, stride, b, w[b * stride + 1 : (b + 2) * stride] AS own FROM blocks JOIN docs USING (r)),
held AS (
  SELECT r, label, len(list_intersect(tokens, own)) / len(tokens) AS share
  FROM cut JOIN templates USING (stride)
  WHERE NOT consecutive AND len(list_intersect(tokens, own)) >= needed),
places AS (
  SELECT r, label, p FROM (
    SELECT r, w, label, phrase, unnest(range(0, len(w))) AS p
    FROM docs, templates WHERE consecutive AND len(list_intersect(phrase, w)) = len(phrase))
  WHERE w[p + 1 : p + len(phrase)] = phrase),
based AS (
  SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
  FROM places GROUP BY r),
labelled AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
  FROM (SELECT r, label, share FROM held UNION ALL SELECT r, label, 1.0 FROM places) GROUP BY r)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_base, 0) AS n_base,
  first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  cast(coalesce(score, 0) AS double) AS score
FROM docs LEFT JOIN based USING (r) LEFT JOIN labelled USING (r)"""


HAMMING_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id, cast(list_sum(list_transform(
      range(1, greatest(len(q.e), len(c.e)) + 1),
      lambda i: CASE WHEN (coalesce(q.e[i], 0) > 0) <> (coalesce(c.e[i], 0) > 0) THEN 1 ELSE 0 END))
    AS int) AS distance
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 100 = 0)
SELECT query_id, cast(row_number() OVER (
    PARTITION BY r ORDER BY distance, vec_id) AS int) AS rank, vec_id, distance
FROM pairs QUALIFY row_number() OVER (PARTITION BY r ORDER BY distance, vec_id) <= 10"""

MIX_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
    ('0x' || substr(md5('11:' || coalesce(cast(doc_id AS varchar), '~')), 1, 15))::bigint AS h
  FROM documents),
s AS (
  SELECT source, sum(size)::bigint AS source_size,
    [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::double AS weight
  FROM d GROUP BY source),
f AS (
  SELECT *, source_size * 2.0::double AS most,
    (sum(source_size) OVER () * 1.5::double - coalesce(sum(source_size * 2.0::double) OVER (
        ORDER BY source_size * 2.0::double / weight, source NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(weight) OVER (ORDER BY source_size * 2.0::double / weight, source NULLS LAST
        ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM s),
t AS (
  SELECT source, source_size, coalesce(least(most, weight * first_value(level) OVER (
      ORDER BY CASE WHEN level * weight <= most THEN most / weight END NULLS LAST, level)), most)
    AS target FROM f),
g AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole FROM t),
b AS (
  SELECT source, h >> 30 AS bucket, sum(size) AS size FROM d GROUP BY ALL),
c AS (
  SELECT source, bucket, size, sum(size) OVER (PARTITION BY source ORDER BY bucket) AS total FROM b),
e AS (
  SELECT g.source, min(bucket) AS bound FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source
  WHERE total - size / 2 > target - whole * source_size GROUP BY g.source)
SELECT doc_id, size::bigint AS size, g.source_size, g.target,
  ((whole + CASE WHEN source_size > 0 AND h >> 30 < coalesce(bound, 1 << 30) THEN 1 ELSE 0 END)
    * size)::bigint AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
LEFT JOIN e ON e.source IS NOT DISTINCT FROM g.source"""


def _cluster_sql(rounds: int = 10, k: int = 8) -> str:
    steps = [f"""WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) AS e
  FROM embeddings WHERE len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, e) - 1 AS c, e
  FROM (SELECT sha256('3:' || vec_id::varchar) AS h, e FROM v ORDER BY h NULLS LAST, e LIMIT {k}))"""]
    near = """
  SELECT r, first(vec_id) AS vec_id, first(v.e) AS e, min(struct_pack(d := list_sum(list_transform(
      range(1, 65), lambda i: (v.e[i] - c.e[i]) * (v.e[i] - c.e[i])))::bigint, c := c.c)) AS m
  FROM v, c{} c GROUP BY r"""
    for i in range(rounds):
        steps.append(f"""a{i} AS MATERIALIZED ({near.format(i)}),
s{i} AS (
  SELECT m.c AS c, i, sum(e[i])::hugeint AS s, count(*)::hugeint AS n
  FROM a{i}, range(1, 65) t(i) GROUP BY ALL),
c{i + 1} AS MATERIALIZED (
  SELECT c, coalesce(n.e, o.e) AS e FROM c{i} o LEFT JOIN (
    SELECT c, list(((s - ((s % n) + n) % n) // n)::bigint ORDER BY i) AS e FROM s{i} GROUP BY c
  ) n USING (c))""")
    steps.append(f"a AS MATERIALIZED ({near.format(rounds)})")
    return ",\n".join(steps) + f"""
SELECT vec_id, m.c::int AS cluster, m.d AS distance,
  sum(m.d) OVER (PARTITION BY m.c)::bigint AS cluster_inertia, sum(m.d) OVER ()::bigint AS inertia,
  sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a JOIN c{rounds} c ON c.c = a.m.c"""


PHRASE_SQL = """
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
pieces AS MATERIALIZED (
  SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS w
  FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\\x0A-\\x0D]')) AS p FROM texts)),
f AS MATERIALIZED (
  SELECT lang, k, p, count(*) AS n FROM (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i:i + k - 1])) AS p
    FROM pieces, range(1, 4) t(k)) GROUP BY ALL),
c AS MATERIALIZED (SELECT lang, k, p, n AS a FROM f WHERE k > 1 AND n >= 10),
longer AS (
  SELECT lang, p, max(a) FILTER (s = 'l') AS most_left, max(a) FILTER (s = 'r') AS most_right FROM (
    SELECT lang, p[2:] AS p, a, 'l' AS s FROM c UNION ALL SELECT lang, p[:k - 1] AS p, a, 'r' AS s FROM c)
  GROUP BY ALL),
kept AS (
  SELECT c.*, most_left, most_right FROM c LEFT JOIN longer USING (lang, p)
  WHERE NOT coalesce(100 * greatest(most_left, most_right) >= 50 * a, false)),
cut AS (
  SELECT lang, k, p, a, most_left, most_right, unnest(range(1, k)) AS j FROM kept),
scored AS (
  SELECT cut.lang, cut.p, a, most_left, most_right, j, x.n AS l, y.n AS r,
    ((1000000::hugeint * a * a) // (x.n::hugeint * y.n))::bigint AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.p = cut.p[:j]
  JOIN f y ON y.lang = cut.lang AND y.p = cut.p[j + 1:]),
best AS (
  SELECT *, array_to_string(p, ' ') AS phrase FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
words AS (SELECT lang, sum(n)::bigint AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score, most_left, most_right
FROM best JOIN words USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000"""

ORACLE = {"op1_license_scan": _license_sql(), "op2_hamming_top_k": HAMMING_SQL, "op3_mix": MIX_SQL,
          "op12_clusters": _cluster_sql(), "op13_phrases": PHRASE_SQL}

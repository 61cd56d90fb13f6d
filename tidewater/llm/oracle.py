"""DuckDB SQL of the queries that SQL can express, on the same tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op4_decontamination"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, list_slice(w, i, i + least(len(w), 10) - 1) AS gram
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS i FROM items WHERE len(w) > 0)
), lengths AS (
  SELECT DISTINCT n FROM item_windows
), doc_windows AS (
  SELECT doc_id, n, i, list_slice(w, i, i + n - 1) AS gram
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM words, lengths WHERE len(w) >= n)
), found AS (
  SELECT doc_id, i, d.n, item_id FROM doc_windows d JOIN item_windows m ON d.n = m.n AND d.gram = m.gram
), hit_words AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM found) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

ORACLE["op2_topk"] = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e)
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

ORACLE["op6_chats"] = r"""
WITH t AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role, text) AS turns FROM t GROUP BY conv_id
), p AS (
  SELECT DISTINCT list_slice(turns, 1, k) AS turns FROM (SELECT turns, unnest(generate_series(1, len(turns) - 1)) AS k FROM c WHERE len(turns) > 1)
), kept AS (
  SELECT min(conv_id) AS conv_id, CAST(count(*) AS BIGINT) AS n_copies, turns FROM c ANTI JOIN p USING (turns) GROUP BY turns
)
SELECT k.conv_id, t.turn >> 10 AS part, CAST(any_value(len(turns)) AS BIGINT) AS n_turns, any_value(n_copies) AS n_copies,
       string_agg('<|' || role || '|>' || chr(10) || text || chr(10) || '<|end|>' || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS chat
FROM kept k JOIN t USING (conv_id) GROUP BY 1, 2
"""

ORACLE["op11_suffix_dedup"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), blocks AS (
  SELECT r, base, substr(x, 2 * base + 1, 2 * (1024 + 399)) AS x
  FROM (SELECT r, x, unnest(generate_series(0, length(x) // 2 - 400, 1024)) AS base FROM d WHERE length(x) >= 800)
), windows AS (
  SELECT r, base + j AS s, md5(substr(x, 2 * j + 1, 800)) AS h
  FROM (SELECT r, base, x, unnest(generate_series(0, least(1023, length(x) // 2 - 400))) AS j FROM blocks)
), starts AS (
  SELECT r, s FROM windows SEMI JOIN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1) USING (h)
), runs AS (
  SELECT r, s, count(*) FILTER (new) OVER (PARTITION BY r ORDER BY s ROWS UNBOUNDED PRECEDING) AS run
  FROM (SELECT r, s, coalesce(s > lag(s) OVER (PARTITION BY r ORDER BY s) + 400, true) AS new FROM starts)
), spans AS (
  SELECT r, run, min(s) AS low, max(s) + 400 AS high FROM runs GROUP BY r, run
), pieces AS (
  SELECT r, run, coalesce(lag(high) OVER (PARTITION BY r ORDER BY run), 0) AS low, low AS high FROM spans
  UNION ALL SELECT r, count(*) + 1, max(high), 1000000000 FROM spans GROUP BY r
), kept AS (
  SELECT r, string_agg(substr(d.x, 2 * low + 1, 2 * (high - low)), '' ORDER BY run) AS x FROM pieces JOIN d USING (r) GROUP BY r
), cut AS (
  SELECT r, CAST(sum(high - low) AS BIGINT) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r
)
SELECT doc_id, CAST(length(d.x) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.x, d.x))) AS kept_sha256
FROM d LEFT JOIN cut USING (r) LEFT JOIN kept USING (r)
"""


def _centroid_sql(rounds: int = 10) -> str:
    """Every round written out: nearest centroids, then their new places."""
    gap = "list_sum(list_transform(list_zip(v.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
  SELECT r, arg_min({{'k': k, 'd': d}}, d * 8 + k) AS a FROM (SELECT r, k, CAST({gap} AS BIGINT) AS d FROM v, c{i} c) GROUP BY r
)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (
  SELECT k, coalesce(m.e, c.e) AS e FROM c{i} c LEFT JOIN (
    SELECT k, list(m ORDER BY j) AS e FROM (
      SELECT a.k AS k, j, CAST(floor(sum(e[j]) / count(*)) AS BIGINT) AS m
      FROM a{i} JOIN v USING (r), generate_series(1, 64) AS g(j) GROUP BY 1, 2
    ) GROUP BY k
  ) m USING (k)
)"""
            )
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h NULLS LAST, e) - 1 AS k, e
  FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, e FROM v ORDER BY h NULLS LAST, e LIMIT 8)
), {", ".join(steps)}
SELECT vec_id, CAST(a.k AS INTEGER) AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.k) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.e, ',')) AS centroid_sha256
FROM a{rounds} JOIN v USING (r) JOIN c{rounds} c ON c.k = a.k
"""


ORACLE["op12_centroids"] = _centroid_sql()


def _license_sql() -> str:
    from tidewater.llm.licenses import LEAST, NOTICES

    values = ", ".join("('{}', '{}')".format(k, t.replace("'", "''")) for k, t in NOTICES)
    words = r"list_filter(string_split(regexp_replace(lower({}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> '')"
    return rf"""
WITH notices(license, text) AS (VALUES {values}), t AS (
  SELECT DISTINCT license, w, CAST(pow(2, ceil(log2(len(w) - 4))) AS BIGINT) AS m FROM (SELECT license, {words.format("text")} AS w FROM notices) WHERE len(w) >= 5
), ts AS (
  SELECT DISTINCT license, w, m, list_slice(w, i, i + 4) AS s FROM (SELECT *, unnest(generate_series(1, len(w) - 4)) AS i FROM t)
), tn AS (
  SELECT license, w, m, count(*) AS n FROM ts GROUP BY ALL
), d AS (
  SELECT doc_id, {words.format("text")} AS w FROM documents
), ds AS (
  SELECT doc_id, i - 1 AS p, list_slice(w, i, i + 4) AS s FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d WHERE len(w) >= 5)
), hit AS (
  SELECT doc_id, license, w, m, p, s FROM ds JOIN ts USING (s)
), win AS (
  SELECT doc_id, license, w, m, s, k FROM (SELECT *, unnest([p // m - 1, p // m]) AS k FROM hit) WHERE k >= 0
), share AS (
  SELECT doc_id, license, k, m, w, count(DISTINCT s) AS c FROM win GROUP BY ALL
)
SELECT doc_id, license, max(CAST(c AS DOUBLE) / n) AS containment FROM share JOIN tn USING (license, w, m)
WHERE CAST(c AS DOUBLE) / n >= {LEAST} GROUP BY ALL
"""


ORACLE["op3_licenses"] = _license_sql()

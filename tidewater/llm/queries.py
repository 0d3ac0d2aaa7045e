"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from . import (chat, decontaminate, extract, kneser_ney, licenses, log_bilinear, order_minhash, pack, permuterm,
               repeats, rules, simhash, va_file)

QUERIES = {
    "op1_order_minhash": order_minhash.op1,
    "op2_chat_format": chat.op2,
    "op3_license_scan": licenses.op3,
    "op4_kneser_ney": kneser_ney.op4,
    "op5_quality_rules": rules.op5,
    "op6_pack": pack.op6,
    "op7_repeats": repeats.op7,
    "op8_extract": extract.op8,
    "op9_decontaminate": decontaminate.op9,
    "op10_log_bilinear": log_bilinear.op10,
    "op11_simhash": simhash.op11,
    "op12_va_file": va_file.op12,
    "op13_permuterm": permuterm.op13,
}

WORD = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"



def cluster_sql(k=va_file.CENTROIDS, rounds=va_file.ROUNDS, dims=va_file.DIMS, scale=va_file.SCALE):
    """The clustering of op12 by comparing every vector with every centroid."""
    parts = [f"""
v AS (SELECT vec_id, row_number() OVER () AS r,
        [CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v FROM embeddings
      WHERE len(embedding) = {dims} AND len([x FOR x IN embedding IF isfinite(x)]) = {dims}),
c0 AS (SELECT k, c FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS k, v AS c
                         FROM v) WHERE k < {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS (SELECT r, min(struct_pack(d := CAST(list_sum([(x[1] - x[2]) * (x[1] - x[2])
           FOR x IN list_zip(v, c)]) AS BIGINT), k := k)) AS m FROM v, c{i} GROUP BY r)""")
        if i < rounds:
            parts.append(f"""
s{i} AS (SELECT m.k AS k, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS n
         FROM a{i} JOIN v USING (r), range(1, {dims + 1}) AS t(i) GROUP BY m.k, i),
c{i + 1} AS (SELECT k, coalesce(x, c) AS c FROM c{i} LEFT JOIN
             (SELECT k, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM s{i} GROUP BY k) USING (k))""")
    return f"""WITH {','.join(parts)},
o AS (SELECT vec_id, CAST(m.k AS INTEGER) AS cluster, m.d AS distance FROM a{rounds} JOIN v USING (r))
SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM o JOIN c{rounds} ON cluster = k"""


ORACLE_SQL = {
    "op12_va_file": cluster_sql(),
    "op9_decontaminate": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, coalesce({WORD}, []) AS w FROM documents),
i AS (SELECT item_id, coalesce({WORD}, []) AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(13, len(w)) AS m,
         array_to_string(w[s:s + least(13, len(w)) - 1], ' ') AS g
       FROM (SELECT *, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT r, m, s, array_to_string(w[s:s + m - 1], ' ') AS g
       FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS s
             FROM d, (SELECT DISTINCT m FROM iw) WHERE len(w) >= m)),
h AS (SELECT r, s, m, item_id FROM dw JOIN iw USING (m, g)),
c AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + m)) AS p FROM h) GROUP BY r),
k AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN k USING (r)""",
}

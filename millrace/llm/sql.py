"""DuckDB SQL of whole results, beside that of ``queries.py``."""

from __future__ import annotations

from millrace.llm import centroids as C

SPELLING = r"""
WITH RECURSIVE tab AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i::BIGINT, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) AS c
        FROM range(256) r(i))
), occurring AS (
    SELECT coalesce(doc_id::VARCHAR, '') AS d, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run
    FROM documents
), runs AS (
    SELECT d, run, count(*) AS n FROM occurring GROUP BY ALL
), bytes AS (
    SELECT run, n, list_transform(regexp_extract_all(hex(encode(d || ':' || run)), '..'), lambda x: ('0x' || x)::BIGINT) AS bs FROM runs
), hashed AS (
    SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, bs), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::BIGINT) AS h FROM bytes, tab
), vocabulary AS MATERIALIZED (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(n)::BIGINT AS n
    FROM hashed GROUP BY 1 HAVING sum(n) >= 3 AND length(word) >= 5
), holes AS MATERIALIZED (
    SELECT word, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM vocabulary)
), shorter AS (
    SELECT DISTINCT h.word, v.word AS near FROM holes h JOIN vocabulary v ON v.word = l || r
), near AS MATERIALIZED (
    SELECT a.word, b.word AS near FROM holes a JOIN holes b ON a.i = b.i AND a.l = b.l AND a.r = b.r AND a.word <> b.word
    UNION ALL SELECT word, near FROM shorter UNION ALL SELECT near, word FROM shorter
), best AS (
    SELECT x.word, count(*) AS n_near, first(x.near ORDER BY v.n DESC, x.near) AS near, max(v.n) AS near_n FROM near x JOIN vocabulary v ON v.word = x.near GROUP BY 1
), formed AS MATERIALIZED (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form, CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM vocabulary LEFT JOIN best USING (word)
), ups AS (
    SELECT word, form AS root, 1 AS k FROM formed WHERE form IS NOT NULL
    UNION ALL SELECT u.word, f.form, k + 1 FROM ups u JOIN formed f ON f.word = u.root WHERE f.form IS NOT NULL
), roots AS (
    SELECT word, arg_max(root, k) AS root FROM ups GROUP BY 1
)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM formed LEFT JOIN roots USING (word)
"""


def _round(k: int) -> str:
    """Assignment to the centroids after ``k`` rounds, and the centroids after one more."""
    return f"""
), near{k} AS MATERIALIZED (
    SELECT row_id, c, dist FROM (
        SELECT v.row_id, m.c, sum((v.x - m.x) * (v.x - m.x))::BIGINT AS dist FROM long v JOIN means{k} m USING (d) GROUP BY ALL
    ) QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY dist, c) = 1
), means{k + 1} AS MATERIALIZED (
    SELECT m.c, m.d, coalesce(s.x, m.x) AS x FROM means{k} m LEFT JOIN (
        SELECT c, d, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS x FROM near{k} JOIN long USING (row_id) GROUP BY ALL
    ) s USING (c, d)"""


CENTROIDS = f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS row_id, vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {C.SCALE})::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = {C.DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), long AS MATERIALIZED (
    SELECT row_id, unnest(range({C.DIMENSIONS})) AS d, unnest(v) AS x FROM kept
), firsts AS (
    SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (SELECT sha256('1:' || coalesce(vec_id::VARCHAR, '')) AS h, v FROM kept ORDER BY h, v LIMIT {C.CENTROIDS})
), means0 AS MATERIALIZED (
    SELECT c, unnest(range({C.DIMENSIONS})) AS d, unnest(v) AS x FROM firsts{"".join(_round(k) for k in range(C.ROUNDS + 1))}
), digests AS (
    SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS centroid_sha256 FROM means{C.ROUNDS} GROUP BY 1
)
SELECT vec_id, c::INTEGER AS cluster, dist AS distance, (sum(dist) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(dist) OVER ())::BIGINT AS inertia, centroid_sha256
FROM near{C.ROUNDS} JOIN kept USING (row_id) JOIN digests USING (c)
"""

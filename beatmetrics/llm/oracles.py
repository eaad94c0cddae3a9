"""SQL of the operators that plain SQL can express, for the tables as they are given."""

from __future__ import annotations


def clusters_sql(k: int = 8, rounds: int = 10, scale: int = 1024, dims: int = 64, seed: int = 3):
    """Every round is two expressions; vectors and centroids are rows of components."""

    def nearest(name: str, centroids: str) -> str:
        return f"""{name}_d AS MATERIALIZED (
            SELECT v.r, c.c, sum((v.x - c.x) * (v.x - c.x)) AS d2
            FROM parts v JOIN {centroids} c USING (i) GROUP BY v.r, c.c),
          {name} AS MATERIALIZED (SELECT r, arg_min(c, (d2, c)) AS c, min(d2) AS d2
            FROM {name}_d GROUP BY r)"""

    steps = []
    for n in range(rounds):
        steps.append(nearest(f"a{n}", f"c{n}"))
        steps.append(f"""m{n} AS MATERIALIZED (
            SELECT a.c, p.i, sum(p.x) AS s, count(*) AS n
            FROM a{n} a JOIN parts p USING (r) GROUP BY a.c, p.i),
          c{n + 1} AS MATERIALIZED (SELECT o.c, o.i, CASE WHEN m.n IS NULL THEN o.x
            ELSE m.s // m.n - CASE WHEN m.s % m.n < 0 THEN 1 ELSE 0 END END AS x
            FROM c{n} o LEFT JOIN m{n} m ON o.c = m.c AND o.i = m.i)""")
    steps.append(nearest("last", f"c{rounds}"))
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER () AS r, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
        WHERE len(embedding) = {dims}
          AND len(list_filter(CAST(embedding AS DOUBLE[]), lambda x: isfinite(x))) = {dims}),
      parts AS MATERIALIZED (SELECT r, unnest(range({dims})) AS i,
        CAST(floor({scale} * unnest(v)) AS HUGEINT) AS x FROM kept),
      starts AS MATERIALIZED (SELECT r, row_number() OVER (
          ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)), v) - 1 AS c
        FROM kept WHERE vec_id IS NOT NULL QUALIFY c < {k}),
      c0 AS MATERIALIZED (SELECT s.c, p.i, p.x FROM starts s JOIN parts p USING (r)),
      {", ".join(steps)},
      hashes AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS h
        FROM c{rounds} GROUP BY c)
    SELECT kept.vec_id, CAST(c AS INTEGER) AS cluster, CAST(d2 AS BIGINT) AS distance,
      CAST(sum(d2) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
      CAST(sum(d2) OVER () AS BIGINT) AS inertia, h AS centroid_sha256
    FROM last JOIN kept USING (r) JOIN hashes USING (c)"""


def top_k_sql(k: int = 5, every: int = 50, scale: int = 256) -> str:
    return f"""
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER () AS r, vec_id,
          list_transform(embedding, lambda x:
            CAST(floor({scale} * CAST(x AS DOUBLE)) AS HUGEINT)) AS v
        FROM embeddings
        WHERE len(embedding) = len(list_filter(embedding, lambda x: isfinite(x)))),
      scored AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS other,
          coalesce(list_sum(list_transform(range(len(q.v)), lambda i: q.v[i + 1] * c.v[i + 1])), 0)
            AS score
        FROM kept q JOIN kept c ON q.r <> c.r AND len(q.v) = len(c.v)
        WHERE q.vec_id % {every} = 0),
      ranked AS (SELECT *, row_number() OVER (PARTITION BY r
          ORDER BY score DESC, vec_id NULLS LAST, other) AS n FROM scored)
    SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
    FROM ranked WHERE n <= {k}"""


def crc32_sql(number: str) -> str:
    """crc32 of a number in decimal, bit by bit."""
    codes = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT))"
    bit = "CASE WHEN u % 2 = 1 THEN xor(u >> 1, 3988292384) ELSE u >> 1 END"
    byte = f"list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda u, v: {bit})"
    every = f"list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {codes}), lambda a, b: {byte})"
    return f"xor({every}, 4294967295)"


def trie_sql(family: int = 5, modulus: int = 9) -> str:
    return f"""
    WITH turns AS (
        SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t,
          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(
            length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS n
        FROM conversations WHERE conv_id IS NOT NULL),
      ids AS (SELECT c, {crc32_sql("c")} % {modulus} AS h FROM (SELECT DISTINCT c FROM turns) x),
      parts AS (
        SELECT i.c, 0 AS part, b.n, b.r, b.t
          FROM ids i JOIN turns b ON b.c = i.c - i.c % {family} AND b.n <= i.h
        UNION ALL SELECT i.c, 1, o.n, o.r, o.t FROM ids i JOIN turns o ON o.c = i.c AND o.n > i.h),
      rebuilt AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, n) AS d,
        {{'r': r, 't': t}} AS turn FROM parts),
      paths AS (SELECT c, d, list(turn) OVER (PARTITION BY c ORDER BY d) AS k FROM rebuilt
        UNION ALL SELECT c, 0, [] FROM ids),
      node AS MATERIALIZED (SELECT k, d, min(c) AS conv, count(*) AS n,
        (count(*) - 1) * coalesce(strlen(k[d].t), 0) AS saved FROM paths GROUP BY k, d),
      kids AS (SELECT k[:d - 1] AS k, count(*) AS n FROM node WHERE d > 0 GROUP BY 1),
      full_node AS MATERIALIZED (SELECT node.*, coalesce(kids.n, 0) AS n_children
        FROM node LEFT JOIN kids ON node.k = kids.k),
      above AS (SELECT k[:j] AS k, CAST(sum(saved) AS BIGINT) AS saved,
          count(*) FILTER (WHERE n_children = 0) AS leaves
        FROM (SELECT *, unnest(range(d + 1)) AS j FROM full_node) x GROUP BY 1),
      ends AS (SELECT k, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids
        FROM paths p WHERE d = (SELECT max(d) FROM paths o WHERE o.c = p.c) GROUP BY k)
    SELECT f.conv AS conv_id, CAST(f.d AS BIGINT) AS depth, up.conv AS parent_conv_id,
      f.n AS n_convs, f.n_children, above.leaves AS n_leaves, above.saved AS saved_tokens,
      sha256(coalesce(ends.ids, '')) AS ends_sha256
    FROM full_node f JOIN above ON f.k = above.k LEFT JOIN ends ON f.k = ends.k
      LEFT JOIN node up ON f.d > 0 AND up.d = f.d - 1 AND up.k = f.k[:f.d - 1]"""

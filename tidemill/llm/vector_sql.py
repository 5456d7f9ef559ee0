"""SQL of the vector operators: rounds written out one after the other, every distance computed."""

from __future__ import annotations

_FINITE = "len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)"
_DISTANCE = (
    "CAST(list_inner_product(p.v, p.v) - 2 * list_inner_product(p.v, c.v) + list_inner_product(c.v, c.v) AS BIGINT)"
)


def _rounds(rounds: int, first: str) -> str:
    """Assignments ``a0`` to ``a<rounds>`` of ``points`` (r, part, v) to centres ``c0``, ``c1``, … (part, k, v)."""
    steps = [f"c0 AS MATERIALIZED ({first})"]
    for n in range(rounds + 1):
        steps.append(f"""
            a{n} AS MATERIALIZED (
                SELECT p.r, p.part, min(({_DISTANCE}, c.k)) AS best
                FROM points p JOIN c{n} c ON p.part = c.part GROUP BY p.r, p.part
            )""")
        if n < rounds:
            steps.append(f"""
            c{n + 1} AS MATERIALIZED (
                WITH sums AS (
                    SELECT part, k, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
                    FROM (
                        SELECT p.part, a.best[2] AS k, unnest(p.v) AS x, generate_subscripts(p.v, 1) AS pos
                        FROM points p JOIN a{n} a ON p.r = a.r AND p.part = a.part
                    ) GROUP BY part, k, pos
                ), moved AS (
                    SELECT part, k, list(CAST((s - ((s % n) + n) % n) // n AS DOUBLE) ORDER BY pos) AS v
                    FROM sums GROUP BY part, k
                )
                SELECT c.part, c.k, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN moved m ON m.part = c.part AND m.k = c.k
            )""")
    return ",".join(steps)


def clusters(clusters: int = 16, rounds: int = 3, scale: int = 64, length: int = 64) -> str:
    first = f"""
        SELECT 0 AS part, row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k, v
        FROM kept WHERE vec_id IS NOT NULL QUALIFY k < {clusters}
    """
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, [floor({scale} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
            FROM embeddings WHERE len(embedding) = {length} AND {_FINITE}
        ), points AS (SELECT r, 0 AS part, v FROM kept), {_rounds(rounds, first)},
        found AS (
            SELECT kept.vec_id, CAST(a.best[2] AS INTEGER) AS cluster, a.best[1] AS distance, c.v
            FROM kept JOIN a{rounds} a USING (r) JOIN c{rounds} c ON c.k = a.best[2]
        )
        SELECT vec_id, cluster, distance,
               CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string([CAST(x AS BIGINT) FOR x IN v], ',')) AS centroid_sha256
        FROM found
    """


def codes(positions: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    first = f"""
        SELECT p.part, n.k, p.v FROM points p JOIN (
            SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS k
            FROM (SELECT vec_id, arg_min(r, v) AS r FROM kept WHERE vec_id IS NOT NULL GROUP BY vec_id)
            QUALIFY k < {entries}
        ) n USING (r)
    """
    return f"""
        WITH kept AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id, label,
                   [floor({scale} * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
            FROM embeddings WHERE embedding IS NOT NULL AND {_FINITE}
        ), points AS MATERIALIZED (
            SELECT r, part, v[part * len(v) // {positions} + 1 : (part + 1) * len(v) // {positions}] AS v
            FROM kept, range({positions}) parts(part)
        ), {_rounds(rounds, first)},
        found AS (
            SELECT r, CAST(sum(best[1]) AS BIGINT) AS error, string_agg(printf('%02x', best[2]), '' ORDER BY part) AS code
            FROM a{rounds} GROUP BY r
        ), books AS (
            SELECT sha256(string_agg(array_to_string([CAST(x AS BIGINT) FOR x IN v], ','), ',' ORDER BY part, k)) AS digest
            FROM c{rounds}
        )
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
               digest AS codebooks_sha256
        FROM found JOIN kept USING (r), books
    """

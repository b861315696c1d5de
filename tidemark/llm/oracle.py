"""DuckDB SQL for the corpus queries that SQL can express over whole tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]"

# (rule, condition) of the host rules.
_RULES = {
    "few": "n_words < 50",
    "repetitive": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 10 * n_words",
    "dup_lines": "100 * n_dup_lines > 30 * n_words",
}


def _host_quality() -> str:
    failed = ", ".join(f"CAST(count(*) FILTER ({c}) AS DOUBLE) AS {r}" for r, c in _RULES.items())
    moments = ", ".join(
        f"sum({r}) / sum(n) AS {r}_mean, sum({r} * {r} / n) AS {r}_q" for r in _RULES
    )
    # What is known of differences between hosts, and how alike the documents of one are.
    known = "(docs - squares / docs - (hosts - 1))"

    def alike(r: str) -> str:
        return (
            f"((({r}_q - {r}_mean * {r}_mean * docs) / ({r}_mean * (1 - {r}_mean)) - (hosts - 1))"
            f" / {known})"
        )

    strengths = ", ".join(
        f"CASE WHEN {r}_mean * (1 - {r}_mean) <= 0 OR {known} <= 0 THEN 1e9"
        f" WHEN {alike(r)} <= 0 THEN 1e9"
        f" ELSE least(1e9, greatest(0.0, 1 / {alike(r)} - 1)) END AS {r}_k"
        for r in _RULES
    )
    rates = ", ".join(f"({r} + {r}_mean * {r}_k) / (n + {r}_k)" for r in _RULES)
    return f"""
    WITH split AS (
        SELECT doc_id, source, coalesce(text, '') AS text,
               regexp_extract_all(coalesce(text, ''), '{_WORD}+') AS w
        FROM documents),
    threes AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w[i], w[i + 1], w[i + 2]) AS times
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
    repeated AS (
        SELECT doc_id, count(DISTINCT i + step) AS n
        FROM threes, range(3) AS steps(step) WHERE times > 1 GROUP BY 1),
    lines AS (
        SELECT doc_id, count(*) - count(DISTINCT line) AS n
        FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM split)
        WHERE regexp_matches(line, '{_WORD}') GROUP BY 1),
    counted AS (
        SELECT split.doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
               CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
               CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
               CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
               CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words
        FROM split LEFT JOIN lines ON lines.doc_id = split.doc_id
        LEFT JOIN repeated ON repeated.doc_id = split.doc_id),
    hosts AS (
        SELECT source, count(*) AS n, {failed}
        FROM counted WHERE source IS NOT NULL GROUP BY 1),
    moments AS (
        SELECT CAST(count(*) AS DOUBLE) AS hosts, CAST(sum(n) AS DOUBLE) AS docs,
               CAST(sum(n * n) AS DOUBLE) AS squares, {moments} FROM hosts),
    prior AS (SELECT *, {strengths} FROM moments),
    verdicts AS (
        SELECT source, greatest({rates}) <= 0.5 AS good FROM hosts, prior)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND coalesce(good, true) AS kept
    FROM (SELECT *, {_RULES['few']} OR {_RULES['repetitive']} AS base_failed FROM counted) c
    LEFT JOIN verdicts ON verdicts.source = c.source"""


def _centroids(rounds: int = 3, clusters: int = 16, components: int = 64) -> str:
    # Integers below 2**53 are exact as doubles, so inner products give exact distances.
    whole = "CAST(list_inner_product({0}, {1}) AS BIGINT)"
    apart = " ".join(
        [whole.format("k.x", "k.x"), "- 2 *", whole.format("k.x", "c.x"), "+", whole.format("c.x", "c.x")]
    )
    parts = [
        f"""kept AS (
        SELECT row_number() OVER () AS r, vec_id,
               list_transform(embedding, lambda e: floor(64 * CAST(e AS DOUBLE))) AS x
        FROM embeddings
        WHERE len(embedding) = {components}
          AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = {components})""",
        f"""c0 AS (
        SELECT n - 1 AS cluster, x FROM (
            SELECT x, row_number() OVER (
                ORDER BY sha256('1:' || CAST(vec_id AS VARCHAR)) NULLS LAST, x) AS n FROM kept)
        WHERE n <= {clusters})""",
    ]
    for turn in range(rounds + 1):
        parts.append(
            f"""a{turn} AS (
        SELECT r, min(struct_pack(d := {apart}, c := c.cluster)) AS s
        FROM kept k, c{turn} c GROUP BY r)"""
        )
        if turn < rounds:
            parts.append(
                f"""m{turn} AS (
        SELECT cluster, list(mean ORDER BY place) AS x FROM (
            SELECT cluster, place,
                   CAST((total - ((total % n) + n) % n) // n AS DOUBLE) AS mean
            FROM (SELECT s.c AS cluster, place, sum(CAST(x[place] AS BIGINT))::BIGINT AS total,
                         count(*) AS n
                  FROM a{turn} JOIN kept USING (r), range(1, {components + 1}) AS p(place)
                  GROUP BY 1, 2)) GROUP BY cluster),
    c{turn + 1} AS (
        SELECT cluster, coalesce(m.x, c.x) AS x FROM c{turn} c LEFT JOIN m{turn} m USING (cluster))"""
            )
    steps = ",\n    ".join(parts)
    return f"""
    WITH {steps}
    SELECT vec_id, CAST(s.c AS INTEGER) AS cluster, s.d AS distance,
           CAST(sum(s.d) OVER (PARTITION BY s.c) AS BIGINT) AS cluster_inertia,
           CAST(sum(s.d) OVER () AS BIGINT) AS inertia,
           sha256(array_to_string(list_transform(f.x, lambda e: CAST(e AS BIGINT)), ','))
               AS centroid_sha256
    FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} f ON f.cluster = s.c"""


ORACLE: dict[str, str] = {
    "op4_host_quality": _host_quality(),
    "op11_shallot_centroids": _centroids(),
}

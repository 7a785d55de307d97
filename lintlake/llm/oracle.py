"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from lintlake.llm import centroids, mixing


def _mixing() -> str:
    """Raking as a chain of windows over the cell table, one per fit."""

    def classed(column: str, axis: str) -> str:
        names = ", ".join(f"'{n}'" for n in mixing.TARGETS[axis])
        return f"CASE WHEN {column} IN ({names}) THEN {column} ELSE '{mixing.OTHER}' END AS {axis}_class"

    def shares(axis: str) -> str:
        named = mixing.TARGETS[axis]
        named = named | {mixing.OTHER: named.get(mixing.OTHER, max(0.0, 1.0 - sum(named.values())))}
        return ", ".join(f"('{n}', {s!r}::DOUBLE)" for n, s in named.items())

    topic = (
        "CASE WHEN contains(body, ' | ') THEN 'table' WHEN regexp_matches(body, '[0-9]{3}') THEN 'figures' "
        "ELSE 'prose' END"
    )
    keys = ", ".join(f"{a}_class" for a in mixing.AXES)
    steps = [
        f"""WITH d AS (SELECT doc_id, source, lang, coalesce(text, '') AS body FROM documents),
classed AS (SELECT doc_id, {classed("source", "source")}, {classed("lang", "lang")},
    {classed(f"({topic})", "topic")},
    len(list_filter(string_split_regex(body, '[\\x09-\\x0D\\x20]+'), lambda w: w <> ''))::BIGINT AS tokens FROM d),
cells AS (SELECT {keys}, sum(tokens)::DOUBLE AS t FROM classed GROUP BY ALL HAVING sum(tokens) > 0)"""
    ]
    joins, last = "", "w0"
    for axis in mixing.AXES:
        steps.append(f"{axis}_raw(n, s) AS (VALUES {shares(axis)})")
        # What has no target but tokens (null and unlisted names) keeps its share of the corpus.
        steps.append(f"{axis}_held AS (SELECT {axis}_class AS n, sum(t) / (SELECT sum(t) FROM cells) AS h FROM cells GROUP BY 1)")
        steps.append(
            f"{axis}_set AS (SELECT n, h, s, sum(CASE WHEN n <> '{mixing.OTHER}' THEN s ELSE 0 END) OVER () AS named "
            f"FROM {axis}_raw JOIN {axis}_held USING (n))"
        )
        steps.append(
            f"{axis}_full AS (SELECT n, CASE WHEN n <> '{mixing.OTHER}' OR s > 1e-9 THEN s WHEN h >= 1 OR named = 0 THEN 1.0 "
            f"ELSE named * h / (1 - h) END::DOUBLE AS s FROM {axis}_set)"
        )
        steps.append(f"{axis}_share AS (SELECT n, s / sum(s) OVER () AS s FROM {axis}_full)")
        joins += f" JOIN {axis}_share AS j_{axis} ON j_{axis}.n = {axis}_class"
    given = ", ".join(f"j_{a}.s AS {a}_s" for a in mixing.AXES)
    steps.append(f"w0 AS MATERIALIZED (SELECT cells.*, {given}, {mixing.KEEP!r}::DOUBLE AS w, "
        f"{mixing.KEEP!r}::DOUBLE * sum(t) OVER () AS budget FROM cells{joins})")
    for i in range(mixing.ROUNDS):
        for axis in mixing.AXES:
            name = f"w{i}_{axis}"
            steps.append(
                f"{name} AS MATERIALIZED (SELECT * REPLACE (least(1.0, coalesce({axis}_s * budget / nullif(sum(w * t) "
                f"OVER (PARTITION BY {axis}_class), 0), 0) * w) AS w) FROM {last})"
            )
            last = name
    steps.append(f"p AS (SELECT {keys}, w AS chance FROM {last})")
    draw = "('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0"
    return ",\n".join(steps) + (
        f"\nSELECT doc_id, {keys}, tokens, round(coalesce(chance, 1.0), 9) AS probability, "
        f"{draw} < coalesce(chance, 1.0) AS kept FROM classed LEFT JOIN p USING ({keys})"
    )


def _centroids() -> str:
    """Every round as a pair of tables: the nearest centroid of each vector, and the centroids moved."""

    def assigned(i: int) -> str:
        distance = f"list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"
        return (
            f"a{i} AS MATERIALIZED (SELECT id, vec_id, kept.v, min({{'d': {distance}::BIGINT, 'k': k}}) AS near "
            f"FROM kept CROSS JOIN c{i} GROUP BY ALL)"
        )

    steps = [
        f"""WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS id, vec_id,
    list_transform(embedding, lambda x: floor({centroids.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE len(embedding) = {centroids.DIMS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {centroids.DIMS}),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS k, v
    FROM kept QUALIFY k < {centroids.CLUSTERS})"""
    ]
    for i in range(centroids.ROUNDS):
        steps.append(assigned(i))
        steps.append(
            f"""s{i} AS (SELECT near.k AS k, dim, sum(v[dim]) AS s, count(*) AS n
    FROM a{i}, unnest(range(1, {centroids.DIMS + 1})) AS u(dim) GROUP BY ALL),
m{i} AS (SELECT k, list(((s - (((s % n) + n) % n)) // n)::BIGINT ORDER BY dim) AS v FROM s{i} GROUP BY k),
c{i + 1} AS MATERIALIZED (SELECT k, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} USING (k))"""
        )
    last = centroids.ROUNDS
    steps.append(assigned(last))
    return ",\n".join(steps) + (
        f"\nSELECT vec_id, near.k::INTEGER AS cluster, near.d AS distance, sum(near.d) OVER (PARTITION BY near.k)::BIGINT "
        f"AS cluster_inertia, sum(near.d) OVER ()::BIGINT AS inertia, sha256(array_to_string(c{last}.v, ',')) AS centroid_sha256 "
        f"FROM a{last} JOIN c{last} ON c{last}.k = near.k"
    )


def _quality_rules() -> str:
    """The measures by joins over words; the verdict needs no order of the rules."""
    blank = r"[\x20\x09-\x0D]"
    word = r"[^\x20\x09-\x0D]"

    def only(characters: str) -> str:
        return f"length(regexp_replace(body, '[^{characters}]', '', 'g'))"

    return rf"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, coalesce(text, '') AS body FROM documents),
w AS MATERIALIZED (SELECT id, doc_id, body, list_filter(string_split_regex(body, '{blank}+'), lambda x: x <> '') AS words,
    list_filter(string_split(body, chr(10)), lambda x: regexp_matches(x, '{word}')) AS lines FROM d),
spelt AS (SELECT id, unnest(range(1, len(words) - 1)) AS i, unnest(list_transform(range(1, len(words) - 1),
    lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])) AS t FROM w),
windows AS (SELECT id, i, count(*) OVER (PARTITION BY id, t) AS n FROM spelt),
again AS (SELECT id, count(DISTINCT i + o) AS n_repeat_words FROM windows, (VALUES (0), (1), (2)) AS v(o)
    WHERE n > 1 GROUP BY id),
m AS (SELECT doc_id, body, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
    {only("#*$%&|<>")} AS n_symbols, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(list_filter(words, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_lettered
    FROM w LEFT JOIN again USING (id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    greatest(n_words, 1)::DOUBLE AS per_word, greatest(n_lines, 1)::DOUBLE AS per_line FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed
    AND word_chars / per_word BETWEEN 3 AND 10 AND n_symbols / per_word <= 0.1::DOUBLE
    AND n_dup_lines / per_line <= 0.3::DOUBLE
    AND {only(chr(92) + "p{Lu}")} / greatest(length(body), 1)::DOUBLE <= 0.3::DOUBLE
    AND {only("!?")} / per_word <= 0.5::DOUBLE AND n_lettered / per_word >= 0.8::DOUBLE
    AND len(regexp_extract_all(body, '(?m)^[ 	]*[-*•]')) / per_line <= 0.9::DOUBLE
    AND len(regexp_extract_all(body, '(?m)(?:\.\.\.|…)[ 	]*$')) / per_line <= 0.3::DOUBLE AS kept
FROM f"""


def all_sql() -> dict[str, str]:
    return {"op6_mixing": _mixing(), "op11_quality_rules": _quality_rules(), "op12_centroids": _centroids()}

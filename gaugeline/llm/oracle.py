"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from . import divergence, line_dedup, zone_clusters

_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _divergence() -> str:
    d = divergence
    classes = {"lower": None, "upper": r"[\p{Lu}\p{Lt}]", "space": d.SPACE, "mark": d.MARK, "symbol": d.SYMBOL}

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''").replace('\\"', '"') + "'"

    def count(pattern: str) -> str:
        return f"length(rest) - length(regexp_replace(rest, {quoted(pattern + '+')}, '', 'g'))"
    letters = quoted(r"[\p{Ll}\p{Lo}\p{M}]+")
    named = ", ".join(f"{count(p)} AS {name}" for name, p in classes.items() if p)
    bins = ", ".join(quoted(w) for w in d.BINS)

    def nearest(column: str, refs: str) -> str:
        return f"""(SELECT min(sqrt(greatest(list_sum(list_transform(list_zip(shared.{column}, r.{column}), lambda z:
            (CASE WHEN z[1] > 0 THEN z[1] * log2(2 * z[1] / (z[1] + z[2])) ELSE 0 END)
            + (CASE WHEN z[2] > 0 THEN z[2] * log2(2 * z[2] / (z[1] + z[2])) ELSE 0 END))) / 2, 0)))
            FROM {refs} r)"""

    def shares(columns: int, column: str) -> str:
        sums = ", ".join(f"sum({column}_n[{i}])" for i in range(1, columns + 1))
        return f"list_transform([{sums}], lambda v: v / list_sum([{sums}])) AS {column}"

    def references(name: str, source: str) -> str:
        return f"""{name} AS (SELECT lang, {shares(len(d.CLASSES), 'chars')}, {shares(len(d.BINS) + 1, 'common')}
            FROM {source} WHERE n_words >= {d.MIN_WORDS} GROUP BY lang
            HAVING sum(n_words) >= {d.MIN_SHARE} * (SELECT sum(n_words) FROM {source} WHERE n_words >= {d.MIN_WORDS}))"""
    return f"""
    WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(lang, '') AS lang,
            coalesce(text, '') AS text, {_WORDS} AS words,
            regexp_replace(coalesce(text, ''), {letters}, '', 'g') AS rest FROM documents),
    counted AS (SELECT *, len(words) AS n_words, {named} FROM texts),
    listed AS (SELECT *, length(text) - space AS word_chars,
            [length(text) - length(rest), upper, space, mark, symbol,
             length(rest) - upper - space - mark - symbol] AS chars_n,
            list_transform([{bins}], lambda b: len(list_filter(words, lambda w: w = b))) AS hits FROM counted),
    windows AS (SELECT row, unnest(generate_series(1, n_words - 2)) AS i,
            unnest(list_transform(generate_series(1, n_words - 2), lambda i: list_slice(words, i, i + 2))) AS three
            FROM listed WHERE n_words >= 3),
    places AS (SELECT row, i FROM (SELECT row, i, count(*) OVER (PARTITION BY row, three) AS c FROM windows)
            WHERE c > 1),
    repeated AS (SELECT row, count(DISTINCT place) AS n FROM (
            SELECT row, unnest([i, i + 1, i + 2]) AS place FROM places) GROUP BY row),
    lines AS (SELECT row, count(*) - count(DISTINCT line) AS n FROM (
            SELECT row, unnest(string_split(text, chr(10))) AS line FROM texts)
            WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY row),
    features AS (SELECT doc_id, lang, n_words, word_chars, symbol AS n_symbols, coalesce(l.n, 0) AS n_dup_lines,
            coalesce(r.n, 0) AS n_repeat_words, chars_n, list_append(hits, n_words - list_sum(hits)) AS common_n
            FROM listed LEFT JOIN lines l USING (row) LEFT JOIN repeated r USING (row)),
    shared AS (SELECT *, list_transform(chars_n, lambda v: v / greatest(list_sum(chars_n), 1)) AS chars,
            list_transform(common_n, lambda v: v / greatest(list_sum(common_n), 1)) AS common,
            n_words < {d.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM features),
    {references('first_refs', 'shared')},
    far AS (SELECT *, {nearest('chars', 'first_refs')} AS c1, {nearest('common', 'first_refs')} AS w1 FROM shared),
    usual AS (SELECT * FROM far WHERE n_words >= {d.MIN_WORDS} AND c1 <= {d.MAX_CHAR_DISTANCE}
            AND w1 <= {d.MAX_WORD_DISTANCE}),
    {references('refs', 'usual')},
    judged AS (SELECT *, lang IN (SELECT lang FROM refs) AS compared, {nearest('chars', 'refs')} AS c,
            {nearest('common', 'refs')} AS w FROM shared)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
        NOT base_failed
        AND (NOT compared OR word_chars < {d.MIN_CHARS}
             OR c <= {d.MAX_CHAR_DISTANCE} + {d.CHAR_SLACK} / greatest(n_words, 1))
        AND (NOT compared OR n_words < {d.MIN_COMMON_WORDS} OR w <= {d.MAX_WORD_DISTANCE}) AS kept
    FROM judged"""


def _line_dedup() -> str:
    m = line_dedup
    return f"""
    WITH pages AS (SELECT row_number() OVER () AS row, doc_id, text, coalesce(source, '') AS host FROM documents),
    lines AS (SELECT row, host, unnest(string_split(text, chr(10))) AS line,
            generate_subscripts(string_split(text, chr(10)), 1) AS i FROM pages),
    totals AS (SELECT host, count(*) AS pages FROM pages GROUP BY host),
    counts AS (SELECT host, trim(line) AS line, count(DISTINCT row) AS n FROM lines
            WHERE trim(line) <> '' GROUP BY ALL),
    drops AS (SELECT host, line FROM counts JOIN totals USING (host)
            WHERE pages >= {m.MIN_PAGES} AND n > {m.MAX_RATIO} * pages),
    kept AS (SELECT row, count(*) AS n_lines, count(*) FILTER (d.line IS NOT NULL) AS n_dropped,
            coalesce(string_agg(l.line, chr(10) ORDER BY i) FILTER (d.line IS NULL), '') AS text
            FROM lines l LEFT JOIN drops d ON l.host = d.host AND trim(l.line) = d.line GROUP BY row)
    SELECT doc_id, CASE WHEN p.text IS NULL THEN NULL ELSE k.text END AS text,
        coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped
    FROM pages p LEFT JOIN kept k USING (row)"""


def _zone_clusters() -> str:
    z = zone_clusters

    def assigned(centroids: str) -> str:
        return f"""(SELECT vec, arg_min(cluster, (distance, cluster)) AS cluster, min(distance) AS distance FROM (
            SELECT v.vec, c.cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance
            FROM parts v JOIN {centroids} c USING (i) GROUP BY ALL) GROUP BY vec)"""
    rounds = "".join(f"""
    moved{n} AS MATERIALIZED (SELECT cluster, i, ((s - ((s % n) + n) % n) // n)::BIGINT AS x FROM (
            SELECT cluster, i, sum(x) AS s, count(*) AS n FROM parts JOIN {assigned(f"round{n}")} USING (vec)
            GROUP BY ALL)),
    round{n + 1} AS MATERIALIZED (SELECT cluster, i, coalesce(m.x, c.x) AS x
            FROM round{n} c LEFT JOIN moved{n} m USING (cluster, i)),""" for n in range(z.ROUNDS))
    return f"""
    WITH kept AS MATERIALIZED (SELECT row_number() OVER () AS vec, vec_id, embedding FROM embeddings
            WHERE len(embedding) = {z.DIMS}
            AND len(list_filter(embedding, lambda e: isfinite(e) AND abs(64 * e::DOUBLE) < {z.LIMIT})) = {z.DIMS}),
    parts AS MATERIALIZED (SELECT vec, unnest(generate_series(1, {z.DIMS})) AS i,
            floor(64 * unnest(embedding)::DOUBLE)::BIGINT AS x FROM kept),
    round0 AS MATERIALIZED (SELECT cluster, i, x FROM parts JOIN (
            SELECT vec, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS cluster FROM kept
            QUALIFY cluster < {z.CENTROIDS}) USING (vec)),{rounds}
    final AS MATERIALIZED (SELECT * FROM {assigned(f"round{z.ROUNDS}")}),
    hashes AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY i)) AS centroid_sha256
            FROM round{z.ROUNDS} GROUP BY cluster)
    SELECT vec_id, cluster::INTEGER AS cluster, distance,
           (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
           (sum(distance) OVER ())::BIGINT AS inertia, centroid_sha256
    FROM final JOIN kept USING (vec) JOIN hashes USING (cluster)"""


ORACLE: dict[str, str] = {
    "op4_divergence": _divergence(),
    "op6_line_dedup": _line_dedup(),
    "op12_zone_clusters": _zone_clusters(),
}

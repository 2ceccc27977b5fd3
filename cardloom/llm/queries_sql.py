"""DuckDB SQL for the queries that plain SQL can state."""

from __future__ import annotations

import string

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

ORACLE_SQL: dict[str, str] = {
    # The budget of a source ends where the running sum of its words in order of the hash reaches it.
    "op6_mixing": r"""
        WITH sizes AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash
            FROM documents),
        weighed AS (
            SELECT source, sum(size)::BIGINT AS source_size, (2 * sum(size))::DOUBLE AS cap,
                   row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place,
                   CASE place % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight
            FROM sizes GROUP BY source),
        ranked AS (
            SELECT *, 1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE AS total, sum(weight) OVER () AS weights,
                   coalesce(sum(cap) OVER prior, 0) AS cap_before, coalesce(sum(weight) OVER prior, 0) AS weight_before
            FROM weighed
            WINDOW prior AS (ORDER BY cap / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        marked AS (SELECT *, cap * (weights - weight_before) <= (total - cap_before) * weight AS capped FROM ranked),
        summed AS (
            SELECT *, coalesce(sum(cap) FILTER (WHERE capped) OVER (), 0) AS cap_sum,
                   weights - coalesce(sum(weight) FILTER (WHERE capped) OVER (), 0) AS weight_left
            FROM marked),
        targets AS (
            SELECT source, source_size,
                   CASE WHEN capped THEN cap ELSE (total - cap_sum) * weight / weight_left END AS target
            FROM summed),
        budgets AS (
            SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS passes
            FROM targets)
        SELECT doc_id, size, source_size, target,
               (passes * size + greatest(0, least(size, floor(target)::BIGINT - passes * source_size
                   - (sum(size) OVER (PARTITION BY s.source ORDER BY hash
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size))))::BIGINT AS taken
        FROM sizes s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source""",
    "op7_line_dedup": rf"""
        WITH lines AS (
            SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
            FROM documents),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS key
            FROM lines),
        repeated AS (
            SELECT key, min(doc_id) AS low FROM keyed WHERE length(key) >= 10
            GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
        marked AS (SELECT k.*, r.low IS NOT NULL AND r.low <> doc_id AS gone FROM keyed k LEFT JOIN repeated r USING (key))
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    "op8_url_filter": f"""
        WITH rests AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
            FROM pages),
        parts AS (
            SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw,
                   regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
            FROM rests),
        hosts AS (
            SELECT page_id, translate(raw, '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host, path FROM parts),
        ruled AS (
            SELECT *, CASE
                WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
                WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule
            FROM hosts)
        SELECT page_id, host, path, rule, CASE
            WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN host = '' OR regexp_matches(host, 'casino|free-bets|cheap-pills|adult') THEN 'block'
            ELSE 'allow' END AS verdict
        FROM ruled""",
    "op9_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
        FROM (SELECT doc_id, {_LOWER} AS norm FROM documents)
        WINDOW same AS (PARTITION BY norm)""",
}

"""DuckDB SQL of the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from tankflow.llm import clusters, hostrules, mixing, resample, suffixes, urlrules, winnowing

_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_FIXED = ", ".join(f"('{r}', '{v}')" for r, v in urlrules.FIXED_RULES)

URL_FILTERS = rf"""
WITH cut AS (
    SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
part AS (
    SELECT page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), {_AZ}), '') AS host,
           coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
           coalesce(regexp_extract(rest, '^[^?#]*\?([^#]*)', 1), '') AS args
    FROM cut),
page AS (
    SELECT page_id, host, path, list_sort(list_distinct(list_concat(
        list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'h:' || x),
        list_concat(list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''),
                                   lambda x: 'p:' || regexp_replace(x, '[0-9]+', '#', 'g')),
                    list_transform(list_filter(string_split(args, '&'), lambda x: x <> ''),
                                   lambda x: 'q:' || string_split(x, '=')[1]))))) AS tokens
    FROM part),
label AS (
    SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad FROM labels
    WHERE doc_id IS NOT NULL GROUP BY doc_id),
known AS (
    SELECT row_number() OVER () AS t, tokens, bad FROM page JOIN label ON page_id = doc_id WHERE len(tokens) > 0),
total AS (SELECT count(*) AS n, sum(bad) AS n_bad,
                 greatest({urlrules.MIN_PAGES}, ceil(count(*) * {urlrules.MIN_SUPPORT})) AS least FROM known),
-- all sets of a page's tokens, by the bits of a number
sets AS (
    SELECT bad, list_filter(tokens, lambda x, i: (mask >> (i - 1)) & 1 = 1) AS items
    FROM (SELECT bad, tokens, unnest(range(1, 1 << len(tokens))) AS mask FROM known)),
rules AS (
    SELECT items, bad / pages AS confidence
    FROM (SELECT items, count(*) AS pages, sum(bad) AS bad FROM sets GROUP BY items), total
    WHERE bad >= least AND bad * {urlrules.MIN_CONFIDENCE[1]} >= pages * {urlrules.MIN_CONFIDENCE[0]}
      AND bad * n * {urlrules.MIN_LIFT[1]} >= pages * n_bad * {urlrules.MIN_LIFT[0]}),
matched AS (
    SELECT p.tokens, max({{'confidence': r.confidence, 'size': len(r.items), 'items': r.items}}) AS best
    FROM (SELECT DISTINCT tokens FROM page) p JOIN rules r ON list_has_all(p.tokens, r.items) GROUP BY p.tokens),
fixed AS (
    SELECT rule, says, string_split(rule, '/')[1] AS h, substr(rule, strpos(rule, '/')) AS p
    FROM (VALUES {_FIXED}) AS f(rule, says)),
pair AS (SELECT DISTINCT host, path FROM page),
chosen AS (
    SELECT host, path, rule, says FROM pair JOIN fixed
      ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
    QUALIFY row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC, rule) = 1)
SELECT page_id, page.host, page.path, rule,
       coalesce(says, CASE WHEN best IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       array_to_string(best.items, ' ') AS matched, best.confidence AS confidence
FROM page LEFT JOIN matched USING (tokens) LEFT JOIN chosen ON chosen.host = page.host AND chosen.path = page.path
"""

HOST_RULES = rf"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents),
line AS (
    SELECT r, x FROM (SELECT r, unnest(string_split(text, chr(10))) AS x FROM doc)
    WHERE regexp_matches(x, '[^\x20\x09-\x0D]')),
dup AS (SELECT r, count(*) - count(DISTINCT x) AS n FROM line GROUP BY r),
win AS (
    SELECT r, i, array_to_string(w[i:i + {hostrules.REPEAT_WINDOW - 1}], ' ') AS words
    FROM (SELECT r, w, unnest(range(1, len(w) - {hostrules.REPEAT_WINDOW - 2})) AS i FROM doc)),
twice AS (SELECT r, i FROM win QUALIFY count(*) OVER (PARTITION BY r, words) > 1),
rep AS (
    SELECT r, count(DISTINCT pos) AS n
    FROM (SELECT r, unnest(range(i, i + {hostrules.REPEAT_WINDOW})) AS pos FROM twice) GROUP BY r),
stat AS (
    SELECT r, doc_id, source, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
    FROM doc LEFT JOIN dup USING (r) LEFT JOIN rep USING (r)),
judged AS (
    SELECT *, n_words < {hostrules.MIN_WORDS} OR 100 * n_repeat_words > {hostrules.MAX_REPEAT_PCT} * n_words AS base_failed FROM stat),
host AS (SELECT source, count(*) AS n, count_if(base_failed) AS failed FROM judged GROUP BY source),
moments AS (SELECT avg(failed / n) AS m, var_pop(failed / n) AS v FROM host),
prior AS (
    SELECT m, CASE WHEN v <= 0 THEN {hostrules.MOST_WEIGHT}
                   ELSE least(greatest(m * (1 - m) / v - 1, {hostrules.LEAST_WEIGHT}), {hostrules.MOST_WEIGHT}) END AS weight FROM moments),
verdict AS (SELECT source, n, (failed + m * weight) / (n + weight) AS rate FROM host, prior)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       CAST(v.n AS BIGINT) AS host_docs, round(rate, 9) AS host_rate, NOT base_failed AND rate <= {hostrules.MAX_RATE} AS kept
FROM judged j JOIN verdict v ON j.source IS NOT DISTINCT FROM v.source
"""

DECONTAMINATION = rf"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
    SELECT item_id, w, least({winnowing.SPAN}, len(w)) AS n
    FROM (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark)
    WHERE len(w) > 0),
wanted AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM item)),
place AS (
    SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
    FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM wanted) WHERE len(w) >= n)),
hit AS (SELECT r, p.n, i, item_id FROM place p JOIN wanted USING (n, win)),
words AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS pos FROM hit) GROUP BY r),
items AS (
    SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN items USING (r)
"""

SUFFIX_DEDUP = f"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
place AS (
    SELECT r, i, md5(substr(h, 2 * i + 1, {2 * suffixes.LENGTH})) AS k
    FROM (SELECT r, h, unnest(range(0, length(h) // 2 - {suffixes.LENGTH - 1})) AS i FROM doc WHERE length(h) >= {2 * suffixes.LENGTH})),
again AS (SELECT r, i FROM place QUALIFY count(*) OVER (PARTITION BY k) > 1),
step AS (
    SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + {suffixes.LENGTH} THEN 0 ELSE 1 END AS fresh FROM again),
run AS (
    SELECT r, min(i) AS lo, max(i) + {suffixes.LENGTH} AS hi
    FROM (SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS nr FROM step) GROUP BY r, nr),
gap AS (
    SELECT r, lo, coalesce(lag(hi) OVER (PARTITION BY r ORDER BY lo), 0) AS since FROM run),
kept AS (
    SELECT gap.r, string_agg(substr(h, 2 * since + 1, 2 * (lo - since)), '' ORDER BY lo) AS front
    FROM gap JOIN doc USING (r) GROUP BY gap.r),
total AS (SELECT r, sum(hi - lo) AS n_removed, count(*) AS n_spans, max(hi) AS last FROM run GROUP BY r)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(front, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM doc LEFT JOIN total USING (r) LEFT JOIN kept USING (r)
"""

# Rounds are written out, each as distances in long form (row, component) x (centroid, component).
_ASSIGNED = """
a{i} AS (
    SELECT r, c, d FROM (SELECT r, c, sum((comp.x - c{i}.x) * (comp.x - c{i}.x)) AS d FROM comp JOIN c{i} USING (j) GROUP BY r, c)
    QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"""
_MOVED = """
c{n} AS (
    SELECT c, j, coalesce(y, x) AS x FROM c{i} LEFT JOIN (
        SELECT c, j, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS y FROM comp JOIN a{i} USING (r) GROUP BY c, j)
    USING (c, j))"""

CLUSTERS = rf"""
WITH fine AS (
    SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
    WHERE len(embedding) = {clusters.DIMS} AND len(list_filter(embedding, lambda x: isfinite(x))) = {clusters.DIMS}),
comp AS (
    SELECT r, j, CAST(floor({clusters.SCALE} * CAST(x AS DOUBLE)) AS BIGINT) AS x
    FROM (SELECT r, unnest(range({clusters.DIMS})) AS j, unnest(embedding) AS x FROM fine)),
first AS (
    SELECT r, row_number() OVER (ORDER BY sha256('{clusters.SEED}:' || coalesce(CAST(vec_id AS VARCHAR), '')), vec_id, embedding) - 1 AS c
    FROM fine QUALIFY c < {clusters.K}),
c0 AS (SELECT c, j, x FROM first JOIN comp USING (r)),
{",".join(_ASSIGNED.format(i=i) + "," + _MOVED.format(i=i, n=i + 1) for i in range(clusters.ROUNDS))},
{_ASSIGNED.format(i=clusters.ROUNDS)},
digest AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS s FROM c{clusters.ROUNDS} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, s AS centroid_sha256
FROM fine JOIN a{clusters.ROUNDS} USING (r) JOIN digest USING (c)
"""

# crc32 by its table, for each distinct word once.
RESAMPLE = rf"""
WITH crc AS (
    SELECT list(v ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v
        FROM range(256) AS n(i))),
doc AS (
    SELECT row_number() OVER () AS r, doc_id,
           regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
used AS (
    SELECT r, unnest(words) AS w FROM doc
    UNION ALL SELECT NULL, unnest(regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
word AS (
    SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295,
               list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT))),
               lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) % {resample.BUCKETS} AS k
    FROM (SELECT DISTINCT w, hex(encode(w)) AS h FROM used), crc),
feature AS (SELECT r, k FROM used JOIN word USING (w)),
total AS (SELECT count(r) AS s, count(*) - count(r) AS t FROM feature),
gain AS (
    SELECT k, CAST(floor(1000 * ln((CAST(n_t AS DOUBLE) + 1) * (s + {resample.BUCKETS}) / ((CAST(n_s AS DOUBLE) + 1) * (t + {resample.BUCKETS})))) AS BIGINT) AS g
    FROM (SELECT k, count(r) AS n_s, count(*) - count(r) AS n_t FROM feature GROUP BY k), total),
weight AS (
    SELECT r, count(*) AS n, CAST((sum(g) - ((sum(g) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS w
    FROM feature JOIN gain USING (k) WHERE r IS NOT NULL GROUP BY r),
scored AS (
    SELECT r, doc_id, len(words) AS n, coalesce(w, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' ||
               substr(sha256('{resample.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8) AS BIGINT) + 0.5) / 4294967296.0))) AS BIGINT) AS score,
           coalesce(w, 0) AS weight
    FROM doc LEFT JOIN weight USING (r)),
ranked AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n) AS place, count(*) OVER () * {resample.PERCENT} // 100 AS draws
    FROM scored WHERE n >= {resample.LEAST_WORDS})
SELECT doc_id, CAST(n AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CAST(CASE WHEN place <= draws THEN place END AS BIGINT) AS rank
FROM scored LEFT JOIN ranked USING (r)
"""

_BYTE_ORDER = "source NULLS LAST"
MIX = rf"""
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
doc AS (SELECT row_number() OVER () AS r, *, row_number() OVER (PARTITION BY doc_id, source, size) AS number FROM sized),
src AS (
    SELECT source, source_size, [{", ".join(map(str, mixing.WEIGHTS))}][(row_number() OVER (ORDER BY {_BYTE_ORDER}) - 1) % {len(mixing.WEIGHTS)} + 1] AS weight
    FROM (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM doc GROUP BY source)),
budget AS (SELECT CAST(sum(source_size) * {mixing.SHARE_PERCENT} // 100 AS BIGINT) AS budget FROM src),
-- sources in the order in which they reach their most: the level is the first by which the next one stays below
open AS (
    SELECT budget - coalesce(sum({mixing.EPOCHS} * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
           sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights,
           {mixing.EPOCHS} * source_size AS most, weight, row_number() OVER w AS nr
    FROM src, budget WINDOW w AS (ORDER BY CAST({mixing.EPOCHS} * source_size AS DOUBLE) / weight, {_BYTE_ORDER})),
level AS (SELECT rest, weights FROM open WHERE weight * rest < most * weights ORDER BY nr LIMIT 1),
target AS (
    SELECT source, source_size, coalesce((SELECT least(CAST(weight * rest AS DOUBLE) / CAST(weights AS DOUBLE), CAST({mixing.EPOCHS} * source_size AS DOUBLE)) FROM level),
                                         CAST({mixing.EPOCHS} * source_size AS DOUBLE)) AS target FROM src),
queue AS (
    SELECT r, doc_id, d.source, size, number, source_size, target, shuffled,
           sum(size) OVER (PARTITION BY d.source ORDER BY shuffled, doc_id NULLS LAST, size, number) AS upto
    FROM (SELECT *, CAST('0x' || substr(sha256(concat_ws(':', '{mixing.SEED}', CAST(doc_id AS VARCHAR), CAST(size AS VARCHAR), CAST(number AS VARCHAR))), 1, 15) AS BIGINT) AS shuffled
          FROM doc) d JOIN target t ON d.source IS NOT DISTINCT FROM t.source),
line AS (
    SELECT r, size, sum(size) OVER (ORDER BY (upto + epoch * source_size) / target, {_BYTE_ORDER}, shuffled, doc_id NULLS LAST, size, number
                                    ROWS UNBOUNDED PRECEDING) AS words
    FROM queue, range({mixing.EPOCHS}) AS e(epoch) WHERE size > 0 AND target > 0),
got AS (SELECT r, sum(size) AS taken FROM line, budget WHERE words <= budget GROUP BY r)
SELECT doc_id, CAST(size AS BIGINT) AS size, source, source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken
FROM queue LEFT JOIN got USING (r)
"""

ORACLE = {"op8_suffix_dedup": SUFFIX_DEDUP, "op2_url_filters": URL_FILTERS, "op5_host_rules": HOST_RULES, "op9_decontamination": DECONTAMINATION,
          "op11_clusters": CLUSTERS, "op12_resample": RESAMPLE, "op13_mix": MIX}

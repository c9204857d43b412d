"""DuckDB SQL that must give the same rows as the queries of this subpackage."""

from __future__ import annotations

from . import license_scan

# Every passage word with its place: plain SQL compares all of them everywhere.
_PASSAGE_WORDS = ",\n    ".join(
    f"({t}, '{p.label}', {len(p.text.split())}, {license_scan.least_hits(len(p.text.split()))}, "
    f"{len(keys)}, {i}, '{w}', {str(i in keys).lower()})"
    for t, p in enumerate(license_scan.PASSAGES)
    for keys in [license_scan.key_places(p.text.split(), p.key_phrases)]
    for i, w in enumerate(p.text.split()))

SQL = {
    "op5_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
pairs AS (
  SELECT doc_id, l, unnest(range(1, len(l))) AS i FROM lines),
ranked AS (
  SELECT doc_id, l, i, row_number() OVER (PARTITION BY l[i] || chr(10) || l[i + 1] ORDER BY doc_id, i) AS occurrence
  FROM pairs),
islands AS (
  SELECT doc_id, l, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS island FROM ranked WHERE occurrence > 1),
runs AS (
  SELECT doc_id, any_value(l) AS l, min(i) AS a, max(i) + 1 AS b FROM islands GROUP BY doc_id, island),
gone AS (
  SELECT doc_id, a, b FROM runs
  WHERE len(list_distinct(regexp_extract_all(array_to_string(l[a:b], chr(10)), '[^\x20\x09-\x0D]+'))) >= 5),
gone_lines AS (SELECT doc_id, unnest(range(a, b + 1)) AS i FROM gone),
all_lines AS (SELECT doc_id, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS i FROM lines),
rest AS (
  SELECT a.doc_id, string_agg(line, chr(10) ORDER BY a.i) FILTER (g.i IS NULL) AS text, count(*) AS n_lines,
         count(g.i) AS removed_lines
  FROM all_lines a LEFT JOIN gone_lines g ON a.doc_id = g.doc_id AND a.i = g.i GROUP BY a.doc_id),
n_gone AS (SELECT doc_id, count(*) AS removed_runs FROM gone GROUP BY doc_id)
SELECT doc_id, coalesce(text, '') AS text, n_lines, removed_lines, coalesce(removed_runs, 0) AS removed_runs
FROM rest LEFT JOIN n_gone USING (doc_id)
""",
    "op6_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY norm) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
""",
    "op7_source_mix": r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('mix|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')), 1, 15))::BIGINT AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
r AS (
  SELECT *, source_size * 3 AS cap, (source_size * 3)::DOUBLE / w AS ratio FROM s),
v AS (
  SELECT *, ((sum(source_size) OVER ())::BIGINT
             - coalesce((sum(cap) OVER (ORDER BY ratio, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT, 0))::DOUBLE
            / (sum(w) OVER (ORDER BY ratio, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS lvl
  FROM r),
final AS (
  SELECT lvl FROM v WHERE lvl <= ratio ORDER BY ratio, source LIMIT 1),
t AS (
  SELECT source, source_size, least(cap::DOUBLE, (SELECT lvl FROM final) * w) AS target FROM v),
b AS (
  SELECT d.*, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
         coalesce((sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::BIGINT, 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, source, size, source_size, target,
       ((CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END) * size
        + greatest(0, least(size, budget - (CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END) * source_size - before)))::BIGINT AS taken
FROM b
""",
    "op11_fill_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
l AS (
  SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS lines,
         ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
         ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM d),
c AS (
  SELECT *, len(lines) AS n, least(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS a,
         greatest(h1 % (len(lines) + 1), h2 % (len(lines) + 1)) AS b,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l),
p AS (
  SELECT *, coalesce(array_to_string(lines[1:a], ''), '') AS prefix,
         coalesce(array_to_string(lines[a + 1:b], ''), '') AS middle,
         coalesce(array_to_string(lines[b + 1:], ''), '') AS suffix FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END::BIGINT AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END::BIGINT AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM p
""",
    "op12_license_scan": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM w),
next AS (
  SELECT *, lead(word) OVER o AS second, lead(word, 2) OVER o AS third FROM words
  WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
base AS (
  SELECT doc_id, i, 'mit' AS label FROM next WHERE word = 'mit' AND second = 'license'
  UNION ALL SELECT doc_id, i, 'apache' FROM next WHERE word = 'apache' AND second = 'license'
  UNION ALL SELECT doc_id, i, 'gpl' FROM next WHERE word = 'general' AND second = 'public' AND third = 'license'),
passage(t, label, n, hits, n_keys, p, word, key) AS (VALUES
    """ + _PASSAGE_WORDS + r"""),
starts AS (
  SELECT doc_id, t, label, n, count(*) AS same FROM words JOIN passage USING (word)
  GROUP BY doc_id, t, label, n, hits, n_keys, i - p
  HAVING count(*) >= hits AND count(*) FILTER (key) = n_keys),
b AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
a AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT doc_id, label FROM base UNION ALL SELECT doc_id, label FROM starts) GROUP BY doc_id),
s AS (SELECT doc_id, max(same / n) AS score FROM starts GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0)::DOUBLE AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN a USING (doc_id) LEFT JOIN s USING (doc_id)
""",
    "op13_filter_audit": r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
  SELECT doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
         100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d, coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS e
  FROM d),
fails AS (
  SELECT f.part, quality = 1 AS good, toxic = 1 AS toxic, a::INT + b::INT + c::INT + d::INT + e::INT AS n_failed,
         map(['A', 'B', 'C', 'D', 'E'], [a, b, c, d, e]) AS failed
  FROM f LEFT JOIN labels USING (doc_id)),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT p.x || q.x || r.x || s.x || t.x AS filter_order FROM letters p, letters q, letters r, letters s, letters t
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (SELECT filter_order, unnest(range(1, 6))::INT AS step FROM orders),
judged AS (
  SELECT part, filter_order, step, good, toxic, n_failed, failed[substr(filter_order, step, 1)] AS fails,
         len(list_filter(range(1, step), lambda k: failed[substr(filter_order, k, 1)])) > 0 AS gone
  FROM fails, steps),
counted AS (
  SELECT part, filter_order, step, substr(filter_order, step, 1) AS x, count(*) FILTER (NOT gone AND NOT fails) AS kept,
         count(*) FILTER (fails AND NOT gone) AS removed, count(*) FILTER (fails AND gone) AS redundant,
         count(*) FILTER (fails AND n_failed = 1) AS unique_fails,
         count(*) FILTER (fails AND NOT gone AND good) AS good_lost,
         count(*) FILTER (fails AND NOT gone AND toxic) AS toxic_lost
  FROM judged GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley
FROM counted
""",
}

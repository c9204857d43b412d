"""DuckDB SQL equal to each registered query, run over the same parquet views.

Each statement reads the base tables directly (not our intermediate results),
so it checks the Spark plan end to end.
"""

from __future__ import annotations

# The access log rebuilt from ``events`` columns, as the parser should see it.
_LOGS = """
WITH logs AS (
  SELECT 'h' || CAST(user_id AS VARCHAR) || '.' || ['de','ca','sg','com'][(user_id % 4) + 1] AS host,
         CASE WHEN TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) = 0 THEN ''
              ELSE strftime(ts, '%d/%b/%Y:%H:%M:%S') || ' -0400' END AS "timestamp",
         'GET /' || event_type || ' HTTP/1.0' AS request,
         CASE WHEN event_type = 'error' THEN 404 ELSE 200 END AS "HTTP reply code",
         CAST(floor(value * 100) AS BIGINT) AS "bytes in the reply"
  FROM events
  WHERE value >= 0.5
),
countries(country_code, country) AS (VALUES ('de','Germany'), ('ca','Canada'), ('sg','Singapore')),
clogs AS (
  SELECT l.*, c.country_code, c.country FROM logs l JOIN countries c ON l.host LIKE '%.' || c.country_code
),
host_counts AS (
  SELECT country_code, country, host, COUNT(*) AS count FROM clogs GROUP BY 1, 2, 3
),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY country_code ORDER BY count DESC, host ASC) AS INTEGER) AS rank
  FROM host_counts
)
"""

SQL: dict[str, str] = {}

SQL["log_parse"] = _LOGS + "SELECT host, \"timestamp\", request, \"HTTP reply code\", \"bytes in the reply\" FROM logs"

SQL["log_preview"] = _LOGS + """
SELECT host, "timestamp", request, "HTTP reply code", "bytes in the reply" FROM logs
ORDER BY try_strptime("timestamp", '%d/%b/%Y:%H:%M:%S %z') NULLS LAST, host, "timestamp", request,
         "HTTP reply code", "bytes in the reply"
LIMIT 20"""

SQL["country_preview"] = _LOGS + """
, p AS (
  SELECT host, "timestamp", request, "HTTP reply code", "bytes in the reply", country_code,
         CAST(row_number() OVER (PARTITION BY country_code
              ORDER BY try_strptime("timestamp", '%d/%b/%Y:%H:%M:%S %z') NULLS LAST, host, "timestamp", request,
                       "HTTP reply code", "bytes in the reply") AS INTEGER) AS rank
  FROM clogs
)
SELECT * FROM p WHERE rank <= 5"""

SQL["log_time"] = _LOGS + """
SELECT host, "timestamp",
       TRY_CAST(substr("timestamp", 1, 2) AS INTEGER) AS day,
       TRY_CAST(split_part("timestamp", ':', 2) AS INTEGER) AS hour,
       CAST(epoch(try_strptime("timestamp", '%d/%b/%Y:%H:%M:%S %z')) AS BIGINT) AS epoch_utc
FROM logs"""

SQL["country_requests"] = _LOGS + """
SELECT c.country_code, c.country, CAST(COUNT(l.host) AS BIGINT) AS requests
FROM countries c LEFT JOIN clogs l ON l.country_code = c.country_code
GROUP BY 1, 2"""

SQL["country_unique_hosts"] = _LOGS + """
SELECT c.country_code, c.country, CAST(COUNT(DISTINCT l.host) AS BIGINT) AS unique_hosts
FROM countries c LEFT JOIN clogs l ON l.country_code = c.country_code
GROUP BY 1, 2"""

SQL["country_top_hosts"] = _LOGS + """
SELECT country_code, country, rank, host, count FROM ranked WHERE rank <= 9"""

SQL["top_hosts_by_buckets"] = SQL["country_top_hosts"]

SQL["unique_hosts_by_period"] = _LOGS + """
, periods(from_day, to_day) AS (VALUES (1, 7), (8, 14), (15, 21), (22, 31), (1, 15), (16, 31), (1, 31))
SELECT l.country_code, p.from_day, p.to_day, CAST(COUNT(DISTINCT l.host) AS BIGINT) AS unique_hosts, TRUE AS within_error
FROM clogs l JOIN periods p ON TRY_CAST(substr(l."timestamp", 1, 2) AS INTEGER) BETWEEN p.from_day AND p.to_day
GROUP BY 1, 2, 3"""

SQL["host_share_rest"] = _LOGS + """
, totals AS (SELECT country_code, COUNT(*) AS requests FROM clogs GROUP BY 1),
rows AS (
  SELECT country_code, country, rank, host, count FROM ranked WHERE rank <= 9
  UNION ALL
  SELECT t.country_code, c.country, 10 AS rank, 'Rest' AS host,
         t.requests - COALESCE((SELECT SUM(count) FROM ranked r WHERE r.rank <= 9
                                AND r.country_code = t.country_code), 0) AS count
  FROM totals t JOIN countries c USING (country_code)
)
SELECT r.country_code, r.country, r.rank, r.host, CAST(r.count AS BIGINT) AS count,
       round(r.count / t.requests * 100.0, 6) AS percent
FROM rows r JOIN totals t USING (country_code)"""

SQL["busiest_host_grid"] = _LOGS + """
, top1 AS (SELECT country_code, country, host FROM ranked WHERE rank = 1),
hits AS (
  SELECT l.country_code, TRY_CAST(substr(l."timestamp", 1, 2) AS INTEGER) AS day,
         TRY_CAST(split_part(l."timestamp", ':', 2) AS INTEGER) AS hour, COUNT(*) AS n
  FROM clogs l JOIN top1 t ON l.country_code = t.country_code AND l.host = t.host
  GROUP BY 1, 2, 3
)
SELECT t.country_code, t.country, t.host, CAST(d.day AS INTEGER) AS day, CAST(h.hour AS INTEGER) AS hour,
       CAST(COALESCE(hits.n, 0) AS BIGINT) AS count
FROM top1 t
CROSS JOIN generate_series(1, 31) d(day)
CROSS JOIN generate_series(0, 23) h(hour)
LEFT JOIN hits ON hits.country_code = t.country_code AND hits.day = d.day AND hits.hour = h.hour"""

# ---------------------------------------------------------------- claims
_CLAIMS = """
WITH lines AS (
  SELECT l_orderkey, COUNT(*) AS n_lines, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS n_returned
  FROM lineitem GROUP BY 1
),
claims AS (
  SELECT o.o_orderkey AS IDpol, CAST(COALESCE(l.n_returned, 0) AS INTEGER) AS ClaimNb,
         (COALESCE(l.n_lines, 0) + 1) / 8.0 AS Exposure,
         o.o_orderpriority, o.o_orderstatus, c.c_mktsegment, o.o_totalprice, c.c_acctbal,
         CASE WHEN COALESCE(l.n_returned, 0) > 0 THEN 1 ELSE 0 END AS hasClaim
  FROM orders o LEFT JOIN lines l ON o.o_orderkey = l.l_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey
),
split AS (
  SELECT *, CASE WHEN CAST(('0x' || substr(md5('claims' || CAST(IDpol AS VARCHAR)), 1, 8)) AS BIGINT)
                      / 4294967296.0 < 0.7 THEN 'train' ELSE 'test' END AS part
  FROM claims
),
ix1 AS (SELECT o_orderpriority AS label, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, o_orderpriority) - 1 AS DOUBLE) AS idx,
               COUNT(*) OVER () AS k FROM claims GROUP BY 1),
ix2 AS (SELECT o_orderstatus AS label, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, o_orderstatus) - 1 AS DOUBLE) AS idx,
               COUNT(*) OVER () AS k FROM claims GROUP BY 1),
ix3 AS (SELECT c_mktsegment AS label, CAST(row_number() OVER (ORDER BY COUNT(*) DESC, c_mktsegment) - 1 AS DOUBLE) AS idx,
               COUNT(*) OVER () AS k FROM claims GROUP BY 1),
coded AS (
  SELECT c.IDpol, a.idx AS i1, a.k - 1 AS w1, b.idx AS i2, b.k - 1 AS w2, d.idx AS i3, d.k - 1 AS w3,
         c.Exposure, c.o_totalprice, c.c_acctbal
  FROM claims c JOIN ix1 a ON c.o_orderpriority = a.label JOIN ix2 b ON c.o_orderstatus = b.label
  JOIN ix3 d ON c.c_mktsegment = d.label
),
long AS (
  SELECT IDpol, CAST(g.p AS INTEGER) AS position, CASE WHEN i1 = g.p THEN 1.0 ELSE 0.0 END AS value
  FROM coded, LATERAL (SELECT * FROM range(w1)) g(p)
  UNION ALL
  SELECT IDpol, CAST(w1 + g.p AS INTEGER), CASE WHEN i2 = g.p THEN 1.0 ELSE 0.0 END
  FROM coded, LATERAL (SELECT * FROM range(w2)) g(p)
  UNION ALL
  SELECT IDpol, CAST(w1 + w2 + g.p AS INTEGER), CASE WHEN i3 = g.p THEN 1.0 ELSE 0.0 END
  FROM coded, LATERAL (SELECT * FROM range(w3)) g(p)
  UNION ALL SELECT IDpol, CAST(w1 + w2 + w3 AS INTEGER), Exposure FROM coded
  UNION ALL SELECT IDpol, CAST(w1 + w2 + w3 + 1 AS INTEGER), o_totalprice FROM coded
  UNION ALL SELECT IDpol, CAST(w1 + w2 + w3 + 2 AS INTEGER), c_acctbal FROM coded
),
mu AS (SELECT o_orderpriority, AVG(ClaimNb) AS mu, AVG(hasClaim) AS p FROM split WHERE part = 'train' GROUP BY 1),
scored AS (
  SELECT s.ClaimNb, s.hasClaim, m.mu, m.p,
         CASE WHEN m.p > (SELECT AVG(hasClaim) FROM split WHERE part = 'train') THEN 1 ELSE 0 END AS pred
  FROM split s JOIN mu m USING (o_orderpriority) WHERE s.part = 'test'
)
"""

SQL["claim_flag"] = _CLAIMS + "SELECT * FROM claims"

SQL["stratified_split"] = _CLAIMS + "SELECT IDpol, hasClaim, part FROM split"

SQL["set_difference"] = _CLAIMS + """
SELECT IDpol, ClaimNb, Exposure, o_orderpriority, o_orderstatus, c_mktsegment, o_totalprice, c_acctbal, hasClaim
FROM claims
EXCEPT
SELECT IDpol, ClaimNb, Exposure, o_orderpriority, o_orderstatus, c_mktsegment, o_totalprice, c_acctbal, hasClaim
FROM split WHERE part = 'train'"""

SQL["set_difference_all"] = _CLAIMS + """
SELECT hasClaim, o_orderpriority, c_mktsegment FROM claims
EXCEPT ALL
SELECT hasClaim, o_orderpriority, c_mktsegment FROM split WHERE part = 'train'"""

SQL["digest_difference"] = SQL["set_difference"]

SQL["digest_difference_all"] = SQL["set_difference_all"]

SQL["category_index"] = _CLAIMS + """
SELECT IDpol, i1 AS o_orderpriority_index, i2 AS o_orderstatus_index, i3 AS c_mktsegment_index FROM coded"""

SQL["one_hot"] = _CLAIMS + """
SELECT IDpol, 'o_orderpriority' AS feature, CAST(w1 AS INTEGER) AS width,
       CAST(CASE WHEN i1 < w1 THEN i1 ELSE -1 END AS INTEGER) AS hot FROM coded
UNION ALL
SELECT IDpol, 'o_orderstatus', CAST(w2 AS INTEGER), CAST(CASE WHEN i2 < w2 THEN i2 ELSE -1 END AS INTEGER) FROM coded
UNION ALL
SELECT IDpol, 'c_mktsegment', CAST(w3 AS INTEGER), CAST(CASE WHEN i3 < w3 THEN i3 ELSE -1 END AS INTEGER) FROM coded"""

SQL["assembled_features"] = _CLAIMS + "SELECT IDpol, position, value FROM long"

SQL["sparse_features"] = _CLAIMS + """
SELECT l.IDpol, l.position, l.value, CAST(c.w1 + c.w2 + c.w3 + 3 AS INTEGER) AS width
FROM long l JOIN coded c ON c.IDpol = l.IDpol WHERE l.value <> 0"""

SQL["scaled_features"] = _CLAIMS + """
, sd AS (SELECT position, stddev_samp(value) AS sd FROM long GROUP BY 1)
SELECT IDpol, position,
       round(CASE WHEN sd.sd = 0 OR sd.sd IS NULL THEN 0.0 ELSE value * (1.0 / sd.sd) END, 6) AS value
FROM long JOIN sd USING (position)"""

SQL["poisson_rates"] = _CLAIMS + "SELECT o_orderpriority, round(mu, 6) AS rate FROM mu"

SQL["logistic_rates"] = _CLAIMS + "SELECT o_orderpriority, round(p, 6) AS rate FROM mu"

SQL["regression_metrics"] = _CLAIMS + """
SELECT round(sqrt(avg((mu - ClaimNb) * (mu - ClaimNb))), 6) AS rmse,
       round(avg((mu - ClaimNb) * (mu - ClaimNb)), 6) AS mse,
       round(avg(abs(mu - ClaimNb)), 6) AS mae, COUNT(*) AS n
FROM scored"""

SQL["accuracy"] = _CLAIMS + """
SELECT round(avg(CASE WHEN pred = hasClaim THEN 1.0 ELSE 0.0 END), 6) AS accuracy, COUNT(*) AS n FROM scored"""

SQL["weighted_f1"] = _CLAIMS + """
, cls AS (SELECT hasClaim AS c, COUNT(*) AS n_actual FROM scored GROUP BY 1),
per AS (
  SELECT c, n_actual,
         (SELECT COUNT(*) FROM scored WHERE hasClaim = c AND pred = c) AS tp,
         (SELECT COUNT(*) FROM scored WHERE pred = c) AS n_pred
  FROM cls
),
f AS (
  SELECT n_actual,
         CASE WHEN n_pred > 0 THEN tp / n_pred ELSE 0.0 END AS pr, tp / n_actual AS rc FROM per
)
SELECT round(SUM(n_actual * CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END) / SUM(n_actual), 6)
       AS weighted_f1, CAST(SUM(n_actual) AS BIGINT) AS n
FROM f"""

_AUC = """
, per AS (SELECT {s} AS s, COUNT(*) FILTER (WHERE hasClaim = 1) AS np, COUNT(*) FILTER (WHERE hasClaim <> 1) AS nn
          FROM scored GROUP BY 1),
cum AS (SELECT np, nn, COALESCE(SUM(nn) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
        FROM per)
SELECT round(SUM(np * (nb + nn / 2.0)) / (SUM(np) * SUM(nn)), 6) AS {name},
       CAST(SUM(np) + SUM(nn) AS BIGINT) AS n FROM cum"""

SQL["auc_scores"] = _CLAIMS + _AUC.format(s="p", name="auc")
SQL["auc_hard"] = _CLAIMS + _AUC.format(s="pred", name="auc_hard")

# ---------------------------------------------------------------- ratings
_RATINGS = """
WITH pairs AS (
  SELECT o.o_custkey, l.l_partkey, SUM(l.l_quantity) AS q, COUNT(*) AS n, MAX(o.o_orderdate) AS d
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY 1, 2
),
ratings AS (
  SELECT CAST(o_custkey AS BIGINT) AS userId, CAST(l_partkey AS BIGINT) AS movieId,
         q / (CAST(n AS DOUBLE) * 10.0) AS rating, CAST(epoch(d) AS BIGINT) AS "timestamp"
  FROM pairs
),
ranked AS (SELECT *, percent_rank() OVER (ORDER BY "timestamp") AS percent_rank FROM ratings),
splits(split) AS (VALUES (0.4::DOUBLE), (0.6::DOUBLE), (0.8::DOUBLE)),
train AS (SELECT s.split, r.* FROM ranked r JOIN splits s ON r.percent_rank < s.split),
seg AS (SELECT c_mktsegment AS cluster, COUNT(*) AS n FROM customer GROUP BY 1),
members AS (
  SELECT CAST(c_custkey AS BIGINT) AS id FROM customer
  WHERE c_mktsegment = (SELECT cluster FROM seg ORDER BY n DESC, cluster ASC LIMIT 1)
),
liked AS (
  SELECT split, movieId, AVG(rating) AS average_rating, COUNT(*) AS n_ratings
  FROM train WHERE rating >= 4 AND userId IN (SELECT id FROM members)
  GROUP BY 1, 2 HAVING AVG(rating) >= 4
),
movies AS (
  SELECT CAST(p_partkey AS BIGINT) AS movieId,
         array_to_string(CASE WHEN p_size >= 45
                              THEN string_split(p_name, ' ') || [p_type] || [string_split(p_name, ' ')[1]]
                              ELSE string_split(p_name, ' ') || [p_type] END, '|') AS genres
  FROM part
)
"""

SQL["time_percent_rank"] = _RATINGS + "SELECT * FROM ranked"

SQL["time_split_sizes"] = _RATINGS + """
SELECT s.split AS fraction, COUNT(*) FILTER (WHERE r.percent_rank < s.split) AS train_rows,
       COUNT(*) FILTER (WHERE r.percent_rank >= s.split) AS test_rows
FROM splits s CROSS JOIN ranked r GROUP BY 1"""

SQL["time_cuts"] = SQL["time_split_sizes"]

SQL["liked_items"] = _RATINGS + """
SELECT split, movieId, round(average_rating, 6) AS average_rating, n_ratings FROM liked"""

SQL["top_tags_rows"] = _RATINGS + """
, tag_rows AS (SELECT l.split, unnest(string_split(m.genres, '|')) AS genre FROM liked l JOIN movies m USING (movieId)),
counts AS (SELECT split, genre, COUNT(*) AS count FROM tag_rows GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY split ORDER BY count DESC, genre) AS INTEGER) AS rank FROM counts)
SELECT split, rank, genre, count FROM r WHERE rank <= 10"""

SQL["top_tags_items"] = _RATINGS + """
, tag_rows AS (SELECT l.split, l.movieId, unnest(list_distinct(string_split(m.genres, '|'))) AS genre
               FROM liked l LEFT JOIN movies m USING (movieId)),
counts AS (SELECT split, genre, COUNT(*) AS count FROM tag_rows WHERE genre IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY split ORDER BY count DESC, genre) AS INTEGER) AS rank FROM counts)
SELECT split, rank, genre, count FROM r WHERE rank <= 10"""

# ---------------------------------------------------------------- classifiers
_COLLISION = """
WITH feats AS (SELECT vec_id, CAST(CAST(embedding[1] AS DOUBLE) + CAST(embedding[2] AS DOUBLE)
            + 4.0::DOUBLE * CAST(embedding[3] AS DOUBLE) * CAST(embedding[4] AS DOUBLE) > 0 AS DOUBLE) AS label FROM embeddings),
cc AS (SELECT label, COUNT(*) AS n FROM feats GROUP BY 1),
cls AS (
  SELECT label, n, n / SUM(n) OVER () AS fraction, SUM(n) OVER () / (COUNT(*) OVER () * n) AS weight,
         MIN(n) OVER () / n AS keep_fraction
  FROM cc
)
"""

SQL["class_balance"] = _COLLISION + """
SELECT label, n, round(fraction, 6) AS fraction, round(weight, 6) AS weight,
       round(keep_fraction, 6) AS keep_fraction FROM cls"""

SQL["class_weights"] = _COLLISION + """
SELECT f.vec_id, f.label, round(c.weight, 6) AS weight FROM feats f JOIN cls c USING (label)"""

SQL["rebalanced"] = _COLLISION + """
SELECT vec_id, label FROM feats
QUALIFY row_number() OVER (PARTITION BY label ORDER BY substr(md5('collision' || CAST(vec_id AS VARCHAR)), 1, 15), vec_id)
        <= (SELECT MIN(n) FROM cc)"""

SQL["exact_stratified_sample"] = _COLLISION + """
SELECT vec_id, label FROM feats JOIN cc USING (label)
QUALIFY row_number() OVER (PARTITION BY label ORDER BY substr(md5('collision-strata' || CAST(vec_id AS VARCHAR)), 1, 15), vec_id)
        <= floor(n * CASE label WHEN 0 THEN 0.5 ELSE 0.25 END)"""

SQL["exact_sample"] = _RATINGS + """
SELECT userId, movieId FROM ratings
QUALIFY row_number() OVER (ORDER BY substr(md5('ratings' || userId || ':' || movieId), 1, 15), userId, movieId)
        <= (SELECT floor(COUNT(*) * 0.1) FROM ratings)"""

SQL["chart_series"] = _LOGS + """
, totals AS (SELECT country_code, COUNT(*) AS requests FROM clogs GROUP BY 1),
share_rows AS (
  SELECT country_code, rank, host, count FROM ranked WHERE rank <= 9
  UNION ALL
  SELECT t.country_code, 10, 'Rest',
         t.requests - COALESCE((SELECT SUM(count) FROM ranked r WHERE r.rank <= 9
                                AND r.country_code = t.country_code), 0)
  FROM totals t
),
top1 AS (SELECT country_code, country, host FROM ranked WHERE rank = 1),
hits AS (
  SELECT l.country_code, TRY_CAST(substr(l."timestamp", 1, 2) AS INTEGER) AS day,
         TRY_CAST(split_part(l."timestamp", ':', 2) AS INTEGER) AS hour, COUNT(*) AS n
  FROM clogs l JOIN top1 t ON l.country_code = t.country_code AND l.host = t.host
  GROUP BY 1, 2, 3
)
SELECT 'requests' AS series, c.country AS x, CAST(COUNT(l.host) AS DOUBLE) AS y
FROM countries c LEFT JOIN clogs l ON l.country_code = c.country_code GROUP BY c.country
UNION ALL
SELECT 'unique_hosts', c.country, CAST(COUNT(DISTINCT l.host) AS DOUBLE)
FROM countries c LEFT JOIN clogs l ON l.country_code = c.country_code GROUP BY c.country
UNION ALL
SELECT 'share:' || c.country, s.host, round(s.count / t.requests * 100.0, 6)
FROM share_rows s JOIN totals t USING (country_code) JOIN countries c USING (country_code)
UNION ALL
SELECT 'activity:' || t.country, lpad(CAST(d.day AS VARCHAR), 2, '0') || '-' || lpad(CAST(h.hour AS VARCHAR), 2, '0'),
       CAST(COALESCE(hits.n, 0) AS DOUBLE)
FROM top1 t CROSS JOIN generate_series(1, 31) d(day) CROSS JOIN generate_series(0, 23) h(hour)
LEFT JOIN hits ON hits.country_code = t.country_code AND hits.day = d.day AND hits.hour = h.hour"""

SQL["csv_round_trip"] = SQL["claim_flag"]

SQL["poisson_coefficients"] = _CLAIMS + """
, tr AS (SELECT * FROM split WHERE part = 'train'),
ixt AS (
  SELECT o_orderpriority AS label, row_number() OVER (ORDER BY COUNT(*) DESC, o_orderpriority) - 1 AS idx,
         COUNT(*) OVER () AS k, AVG(ClaimNb) AS mu
  FROM tr GROUP BY 1
),
base AS (SELECT mu AS mu0 FROM ixt WHERE idx = k - 1)
SELECT '(intercept)' AS feature, CAST(-1 AS INTEGER) AS position, round(ln(mu0), 6) AS coefficient FROM base
UNION ALL
SELECT 'o_orderpriority_index_ohe_' || label, CAST(idx AS INTEGER), round(ln(mu) - ln(mu0), 6)
FROM ixt, base WHERE idx < k - 1"""

_FEATURE_COLS = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(64))

SQL["parquet_round_trip"] = f"""
SELECT vec_id, CAST(CAST(embedding[1] AS DOUBLE) + CAST(embedding[2] AS DOUBLE)
            + 4.0::DOUBLE * CAST(embedding[3] AS DOUBLE) * CAST(embedding[4] AS DOUBLE) > 0 AS DOUBLE) AS label, {_FEATURE_COLS} FROM embeddings"""

SQL["headerless_csv"] = f"""
SELECT CAST(vec_id AS DOUBLE) AS vec_id, CAST(CAST(embedding[1] AS DOUBLE) + CAST(embedding[2] AS DOUBLE)
            + 4.0::DOUBLE * CAST(embedding[3] AS DOUBLE) * CAST(embedding[4] AS DOUBLE) > 0 AS DOUBLE) AS label, {_FEATURE_COLS} FROM embeddings"""

SQL["tag_indicators"] = """
WITH movies AS (
  SELECT CAST(p_partkey AS BIGINT) AS movieId,
         array_to_string(CASE WHEN p_size >= 45
                              THEN string_split(p_name, ' ') || [p_type] || [string_split(p_name, ' ')[1]]
                              ELSE string_split(p_name, ' ') || [p_type] END, '|') AS genres
  FROM part
)
SELECT movieId, unnest(list_distinct(string_split(genres, '|'))) AS genre FROM movies"""


SQL["headerless_csv_typed"] = SQL["headerless_csv"]

# ---------------------------------------------------------------- repeatable samples
_UNIFORM = "CAST(('0x' || substr(md5('{salt}' || CAST(IDpol AS VARCHAR)), 1, 8)) AS BIGINT) / 4294967296.0"

SQL["hash_sample"] = _CLAIMS + f"""
SELECT IDpol, ClaimNb, hasClaim FROM split WHERE part = 'train' AND {_UNIFORM.format(salt='claims-sample')} < 0.1"""

SQL["random_hash_split"] = _CLAIMS + f"""
SELECT IDpol, CASE WHEN {_UNIFORM.format(salt='claims-random')} < 0.7 THEN 'part' ELSE 'rest' END AS side FROM claims"""

# ---------------------------------------------------------------- closed forms of models
_TRAIN = _CLAIMS + f"""
, tr AS (SELECT *, CAST(floor({_UNIFORM.format(salt='claims-fold')} * 3) AS INTEGER) AS fold,
              CASE WHEN o_orderstatus = 'F' THEN hasClaim ELSE 1 - hasClaim END AS turned FROM split WHERE part = 'train')
"""

SQL["exact_search"] = _TRAIN + """
, folds AS (SELECT unnest(range(3)) AS f),
cells AS (
  SELECT IDpol, fold, ClaimNb, turned, unnest(['o_orderpriority', 'o_orderstatus', 'c_mktsegment']) AS col,
         unnest([o_orderpriority, o_orderstatus, c_mktsegment]) AS v FROM tr
),
means AS (SELECT f, col, v, AVG(ClaimNb) AS mu, AVG(turned) AS p FROM folds JOIN cells ON fold <> f GROUP BY 1, 2, 3),
held AS (SELECT c.*, m.mu, m.p FROM cells c JOIN means m ON c.fold = m.f AND c.col = m.col AND c.v = m.v),
per AS (
  SELECT 'threshold' AS model, 'threshold=' || CAST(t AS VARCHAR) AS params, 'accuracy' AS metric, fold,
         AVG(CASE WHEN (p > t) = (turned = 1) THEN 1.0 ELSE 0.0 END) AS m
  FROM held, (SELECT unnest([0.1, 0.5, 0.9]) AS t) WHERE col = 'o_orderstatus' GROUP BY t, fold
  UNION ALL
  SELECT 'column', 'featuresCol=' || col || '_index_ohe', 'rmse', fold, sqrt(AVG((mu - ClaimNb) * (mu - ClaimNb)))
  FROM held GROUP BY col, fold
),
means_of AS (SELECT model, params, metric, AVG(m) AS a, stddev_pop(m) AS s, metric = 'accuracy' AS larger FROM per GROUP BY 1, 2, 3)
SELECT model, params, metric, round(a, 6) AS avg_metric, round(s, 6) AS std_metric, larger AS larger_is_better,
       row_number() OVER (PARTITION BY model ORDER BY CASE WHEN larger THEN -a ELSE a END, params) = 1 AS best
FROM means_of"""

SQL["best_model_scores"] = _TRAIN + """
, folds AS (SELECT unnest(range(3)) AS f),
cells AS (
  SELECT fold, ClaimNb, unnest(['o_orderpriority', 'o_orderstatus', 'c_mktsegment']) AS col,
         unnest([o_orderpriority, o_orderstatus, c_mktsegment]) AS v FROM tr
),
means AS (SELECT f, col, v, AVG(ClaimNb) AS mu FROM folds JOIN cells ON fold <> f GROUP BY 1, 2, 3),
per AS (
  SELECT c.col, c.fold, sqrt(AVG((mu - ClaimNb) * (mu - ClaimNb))) AS m
  FROM cells c JOIN means m ON c.fold = m.f AND c.col = m.col AND c.v = m.v GROUP BY 1, 2
),
best AS (SELECT col FROM per GROUP BY 1 ORDER BY AVG(m) LIMIT 1),
rates AS (SELECT v, AVG(ClaimNb) AS mu FROM cells JOIN best USING (col) GROUP BY 1),
seen AS (SELECT DISTINCT o_orderpriority, o_orderstatus, c_mktsegment FROM tr),
groups AS (
  SELECT o_orderpriority, o_orderstatus, c_mktsegment, COUNT(*) AS n_test
  FROM split JOIN seen USING (o_orderpriority, o_orderstatus, c_mktsegment) WHERE part = 'test' GROUP BY 1, 2, 3
)
SELECT o_orderpriority, o_orderstatus, c_mktsegment, n_test, round(mu, 6) AS predicted
FROM groups, best JOIN rates ON v = CASE col WHEN 'o_orderpriority' THEN o_orderpriority
                                             WHEN 'o_orderstatus' THEN o_orderstatus ELSE c_mktsegment END"""

_SEPARABLE = _RATINGS + f"""
, pairs_of_sizes AS (
  SELECT DISTINCT userId, CAST(p_size AS BIGINT) AS movieId, CAST(c_nationkey % 4 + 1 AS INTEGER) AS taste,
         CAST(p_size % 5 + 1 AS INTEGER) AS quality
  FROM ratings JOIN customer ON userId = c_custkey JOIN part ON movieId = p_partkey
),
separable AS (
  SELECT *, {_UNIFORM.format(salt='separable').replace('CAST(IDpol AS VARCHAR)', "userId || ':' || movieId")} < 0.6 AS known
  FROM pairs_of_sizes
),
known AS (SELECT * FROM separable WHERE known)
"""

SQL["exact_factorisation"] = _SEPARABLE + """
SELECT userId, movieId, CAST(taste * quality AS DOUBLE) AS predicted FROM separable
WHERE NOT known AND userId IN (SELECT userId FROM known) AND movieId IN (SELECT movieId FROM known)"""

SQL["factor_clusters"] = _SEPARABLE + """
SELECT taste AS least, taste AS largest, COUNT(DISTINCT userId) AS size FROM known GROUP BY taste"""

SQL["factor_cluster_items"] = _SEPARABLE + """
, largest AS (SELECT taste FROM known GROUP BY 1 ORDER BY COUNT(DISTINCT userId) DESC LIMIT 1)
SELECT movieId, CAST(AVG(taste * quality) AS DOUBLE) AS average_rating, COUNT(*) AS n_ratings
FROM known JOIN largest USING (taste) WHERE taste * quality >= 4 GROUP BY 1"""

SQL["lasso_limit"] = _TRAIN + """
SELECT CAST((SELECT MAX(w1 + w2 + w3) + 3 FROM coded) AS INTEGER) AS n_coefficients, CAST(0 AS INTEGER) AS n_nonzero,
       round(AVG(hasClaim), 6) AS least, round(AVG(hasClaim), 6) AS largest FROM tr"""

SQL["one_split_trees"] = _TRAIN + """
, cells AS (
  SELECT turned AS y, unnest(['o_orderpriority', 'o_orderstatus', 'c_mktsegment']) AS col,
         unnest([o_orderpriority, o_orderstatus, c_mktsegment]) AS v FROM tr
),
levels AS (SELECT col, v, COUNT(*) AS n, SUM(y) AS s FROM cells GROUP BY 1, 2),
cuts AS (
  SELECT col, v, row_number() OVER (PARTITION BY col ORDER BY s / n) AS r, SUM(n) OVER w AS nl, SUM(s) OVER w AS sl,
         SUM(n) OVER (PARTITION BY col) AS na, SUM(s) OVER (PARTITION BY col) AS sa
  FROM levels WINDOW w AS (PARTITION BY col ORDER BY s / n ROWS UNBOUNDED PRECEDING)
),
best AS (
  SELECT col, r, sl / nl AS p_low, (sa - sl) / (na - nl) AS p_high FROM cuts WHERE nl < na
  ORDER BY sl * (1 - sl / nl) + (sa - sl) * (1 - (sa - sl) / (na - nl)) LIMIT 1
),
sides AS (SELECT c.col, c.v, CASE WHEN c.r <= b.r THEN p_low ELSE p_high END AS p FROM cuts c JOIN best b USING (col)),
groups AS (SELECT DISTINCT o_orderpriority, o_orderstatus, c_mktsegment FROM tr)
SELECT o_orderpriority, o_orderstatus, c_mktsegment, round(p, 6) AS tree,
       round(1 / (1 + exp(-2 * (2 * p - 1))), 6) AS boosted
FROM groups g JOIN sides s ON s.v = CASE s.col WHEN 'o_orderpriority' THEN o_orderpriority
                                         WHEN 'o_orderstatus' THEN o_orderstatus ELSE c_mktsegment END"""

SQL["boosting_rounds"] = _TRAIN.replace("WITH ", "WITH RECURSIVE ", 1) + """
, sides AS (
  SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS is_f, AVG(turned)::DOUBLE AS p FROM tr GROUP BY 1
),
margins AS (
  SELECT is_f, p, 1 AS rounds, 2 * p - 1 AS margin FROM sides
  UNION ALL
  SELECT is_f, p, rounds + 1,
         margin + 0.2::DOUBLE * (p * 4 / (1 + exp(2 * margin)) - (1 - p) * 4 / (1 + exp(-2 * margin)))
  FROM margins WHERE rounds < 4
)
SELECT is_f, rounds, round(1 / (1 + exp(-2 * margin)), 6) AS score FROM margins"""

SQL["layerless_perceptron"] = _TRAIN + """
SELECT o_orderstatus, CASE WHEN AVG(turned) > 0.5 THEN 1 ELSE 0 END AS predicted FROM tr GROUP BY 1"""

SQL["separated_clusters"] = """
WITH sizes AS (SELECT c_mktsegment, COUNT(*) AS size FROM customer GROUP BY 1)
SELECT size, COUNT(*) AS clusters FROM sizes GROUP BY 1"""

SQL["als_coverage"] = _RATINGS + """
, users AS (SELECT DISTINCT split, userId FROM train), items AS (SELECT DISTINCT split, movieId FROM train),
test AS (SELECT s.split, r.userId, r.movieId FROM ranked r JOIN splits s ON r.percent_rank >= s.split)
SELECT t.split, COUNT(*) AS n_test, COUNT(u.userId + i.movieId) AS n_scored,
       round(COUNT(u.userId + i.movieId) / COUNT(*), 6) AS covered
FROM test t LEFT JOIN users u ON t.split = u.split AND t.userId = u.userId
LEFT JOIN items i ON t.split = i.split AND t.movieId = i.movieId GROUP BY 1"""

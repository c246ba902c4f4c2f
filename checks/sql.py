"""Shared table expressions of the DuckDB oracles, and their assembly into full queries."""

from __future__ import annotations

import re

# name -> body; a query gets exactly the expressions it mentions, in this order.
CTES: dict[str, str] = {}


def cte(name: str, body: str) -> None:
    CTES[name] = body


cte("base", """
SELECT CASE WHEN l.l_orderkey % 101 = 0 THEN NULL ELSE 'U' || CAST(o.o_custkey AS VARCHAR) END AS user_id,
       CASE WHEN l.l_orderkey % 103 = 0 THEN NULL ELSE 'P' || CAST(l.l_partkey AS VARCHAR) END AS product_id,
       CAST(floor(l.l_quantity / 7) - 1 AS DOUBLE) AS rating,
       CAST(epoch_ms(l.l_shipdate) AS BIGINT) AS timestamp,
       l.l_returnflag <> 'R' AS verified_purchase,
       CAST(round(l.l_discount * 100) AS BIGINT) AS helpful_vote,
       p.p_type AS category, l.l_orderkey AS ok, l.l_linenumber AS ln
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
                JOIN part p ON l.l_partkey = p.p_partkey""")
cte("reviews", "SELECT * FROM base UNION ALL SELECT * FROM base WHERE ok % 50 = 0")

cte("interactions", """
SELECT user_id, product_id, rating, timestamp,
       CASE WHEN verified_purchase THEN 'purchase' WHEN NOT verified_purchase THEN 'review' END AS interaction_type,
       CASE WHEN verified_purchase THEN 1 ELSE 0 END AS converted,
       strftime(make_timestamp(timestamp * 1000), '%Y-%m') AS year_month,
       helpful_vote, category
FROM reviews""")
cte("clean", """
SELECT * REPLACE (CASE WHEN rating < 0 THEN 0.0 WHEN rating > 5 THEN 5.0 ELSE rating END AS rating)
FROM interactions WHERE user_id IS NOT NULL AND product_id IS NOT NULL""")
cte("dedup", """
SELECT * FROM clean
QUALIFY row_number() OVER (PARTITION BY user_id, product_id, timestamp
  ORDER BY rating DESC NULLS LAST, converted DESC, helpful_vote DESC, category) = 1""")
cte("silver", """
SELECT *, user_interaction_count / CAST(recency_rank AS DOUBLE) AS rf_score FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY timestamp DESC, product_id) AS recency_rank,
         count(*) OVER (PARTITION BY user_id) AS user_interaction_count
  FROM dedup)""")
cte("stats", """
SELECT product_id, count(*) AS nb_interactions, CAST(sum(converted) AS BIGINT) AS nb_conversions,
       sum(converted) / CAST(count(*) AS DOUBLE) AS conversion_rate
FROM silver GROUP BY product_id""")
cte("popularity", """
SELECT *, ln(1 + nb_interactions) / (SELECT max(ln(1 + nb_interactions)) FROM stats) AS popularity_score
FROM stats""")
cte("partials", """
SELECT category, user_id, count(product_id) AS total_interactions,
       CAST(sum(converted) AS BIGINT) AS total_purchases, avg(rating) AS avg_rating,
       sum(rating) AS rating_sum, count(rating) AS rating_n
FROM interactions WHERE user_id IS NOT NULL GROUP BY ALL""")
cte("merged", """
SELECT user_id, CAST(sum(total_interactions) AS BIGINT) AS total_interactions,
       CAST(sum(total_purchases) AS BIGINT) AS total_purchases, avg(avg_rating) AS avg_rating,
       sum(rating_sum) / sum(rating_n) AS avg_rating_weighted
FROM partials GROUP BY user_id""")
cte("users", """
SELECT *, CASE WHEN total_purchases >= (SELECT quantile_cont(total_purchases, 0.9) FROM merged) THEN 'power_user'
               WHEN total_purchases >= (SELECT quantile_cont(total_purchases, 0.5) FROM merged) THEN 'regular_user'
               ELSE 'casual_user' END AS segment
FROM merged""")
cte("warm_products", """
SELECT product_id FROM interactions WHERE product_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 32""")
cte("warm_users", """
SELECT user_id FROM interactions WHERE user_id IS NOT NULL GROUP BY 1 HAVING count(*) >= 32""")
cte("supported", """
SELECT * FROM interactions WHERE user_id IN (FROM warm_users) AND product_id IN (FROM warm_products)""")
cte("popular", """
SELECT product_id, category, nb_interactions,
       row_number() OVER (ORDER BY nb_interactions DESC, product_id) AS rank
FROM (SELECT i.product_id, p.category, i.nb_interactions
      FROM (SELECT product_id, count(*) AS nb_interactions FROM interactions
            WHERE product_id IS NOT NULL GROUP BY 1) i JOIN products p USING (product_id)
      ORDER BY nb_interactions DESC, product_id LIMIT 500)""")
cte("by_category", """
SELECT category, product_id, nb_interactions,
       row_number() OVER (PARTITION BY category ORDER BY nb_interactions DESC, product_id) AS rank
FROM (SELECT category, product_id, count(*) AS nb_interactions FROM interactions
      WHERE product_id IS NOT NULL GROUP BY ALL)
QUALIFY rank <= 10""")

cte("products", """
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category, p_name AS title,
       p_retailprice AS price, CAST(NULL AS DOUBLE) AS average_rating,
       CAST(NULL AS BIGINT) AS rating_number, p_brand AS store
FROM part""")
for _name, _least in (("gold", 5), ("gold_high", 32)):
    cte(_name, f"""
SELECT p.*, coalesce(s.conversion_rate, 0.0) AS conversion_rate,
       coalesce(s.popularity_score, 0.0) AS popularity_score,
       coalesce(s.nb_interactions, 0) AS nb_interactions,
       coalesce(s.nb_interactions, 0) < {_least} AS is_cold
FROM products p LEFT JOIN popularity s USING (product_id)""")

cte("pv", """
SELECT 'P' || CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category, p_size,
       CAST(embedding[1:16] AS DOUBLE[]) AS p, CAST(embedding[17:32] AS DOUBLE[]) AS b
FROM part JOIN embeddings ON vec_id = p_partkey % (SELECT count(*) FROM embeddings)""")
cte("uv", """
SELECT 'U' || CAST(c_custkey AS VARCHAR) AS user_id, CAST(embedding[1:16] AS DOUBLE[]) AS u
FROM customer JOIN embeddings ON vec_id = (c_custkey * 7 + 3) % (SELECT count(*) FROM embeddings)""")
cte("scores", """
SELECT user_id, product_id, category, round(list_dot_product(u, p), 6) + 0.0 AS score FROM uv, pv""")
cte("factor_items", """
SELECT product_id, p FROM pv WHERE product_id IN (SELECT product_id FROM supported)""")
cte("factor_users", """
SELECT user_id, u FROM uv WHERE user_id IN (SELECT user_id FROM supported)""")
cte("bridged_items", "SELECT product_id, b AS p FROM pv WHERE p_size > 5")
cte("fused_products", """
SELECT p.*, coalesce(f.p, b.p, [0.0 for x in range(16)]) AS p,
       CASE WHEN f.p IS NOT NULL THEN 'als' WHEN b.p IS NOT NULL THEN 'bridge' ELSE 'zero' END AS vector_source,
       p.product_id NOT IN (FROM warm_products) AS is_cold
FROM products p LEFT JOIN factor_items f USING (product_id) LEFT JOIN bridged_items b USING (product_id)""")
cte("seen_means", """
SELECT user_id, list(m ORDER BY pos) AS u FROM (
  SELECT user_id, pos, CAST(CAST(avg(v) AS FLOAT) AS DOUBLE) AS m FROM (
    SELECT i.user_id, unnest(f.p) AS v, unnest(range(1, 17)) AS pos
    FROM interactions i JOIN fused_products f USING (product_id)
    WHERE i.user_id IS NOT NULL AND i.user_id NOT IN (SELECT user_id FROM factor_users))
  GROUP BY ALL)
GROUP BY user_id""")
cte("fused_users", """
SELECT s.user_id, s.segment, coalesce(f.u, m.u, [0.0 for x in range(16)]) AS u,
       CASE WHEN f.u IS NOT NULL THEN 'als' WHEN m.u IS NOT NULL THEN 'mean' ELSE 'zero' END AS vector_source,
       s.user_id NOT IN (FROM warm_users) AS is_cold
FROM users s LEFT JOIN factor_users f USING (user_id) LEFT JOIN seen_means m USING (user_id)""")

_VARIANT = "CASE WHEN right(md5({0}), 1) IN ('0','2','4','6','8','a','c','e') THEN 'control' ELSE 'treatment' END"
cte("ev", f"""
SELECT event_id, ts, 'U' || CAST(user_id AS VARCHAR) AS user_id, event_type, value,
       CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       {_VARIANT.format("'U' || CAST(user_id AS VARCHAR)")} AS variant
FROM events""")
cte("impressions", "SELECT user_id, variant AS ab_variant, ts FROM ev WHERE event_type = 'view'")
cte("raw_feedback", """
SELECT event_id, user_id, 'P' || CAST(k AS VARCHAR) AS product_id,
       CASE WHEN event_type = 'error' THEN 'skip' ELSE event_type END AS interaction_type,
       CASE WHEN event_id % 37 <> 0 THEN variant WHEN variant = 'control' THEN 'treatment' ELSE 'control' END AS ab_variant,
       variant, ts
FROM ev WHERE event_type <> 'view'""")
cte("feedback", "SELECT * FROM raw_feedback WHERE interaction_type IN ('click', 'purchase', 'skip')")
cte("requests", """
SELECT user_id, ts, value AS latency_ms, k % 2 = 0 AS cache_hit FROM ev WHERE event_type = 'view'""")
cte("asks", """
SELECT 'R' || CAST(c_custkey AS VARCHAR) AS request_id,
       CASE WHEN c_acctbal < 0 THEN 'X' ELSE 'U' END || CAST(c_custkey AS VARCHAR) AS user_id,
       c_nationkey + 1 AS n,
       CASE WHEN c_nationkey >= 12 THEN ['ECONOMY', 'SMALL', 'STANDARD', 'PROMO'][(c_nationkey - 12) % 4 + 1] END AS category,
       c_mktsegment <> 'BUILDING' AS exclude_seen
FROM customer""")
cte("seen", "SELECT DISTINCT user_id, product_id FROM interactions WHERE user_id IS NOT NULL AND product_id IS NOT NULL")
cte("recommended", """
SELECT request_id, user_id, product_id, category, round((score - low) / (high - low + 1e-8), 6) AS score, rank,
       'als' AS source, false AS is_cold_user FROM (
  SELECT r.request_id, r.user_id, r.n, s.product_id, s.category, s.score,
         min(s.score) OVER w AS low, max(s.score) OVER w AS high,
         row_number() OVER (PARTITION BY r.request_id ORDER BY s.score DESC, s.product_id) AS rank
  FROM asks r JOIN scores s ON s.user_id = r.user_id AND (r.category IS NULL OR r.category = s.category)
  WHERE NOT (r.exclude_seen AND EXISTS (SELECT 1 FROM seen x WHERE x.user_id = r.user_id AND x.product_id = s.product_id))
  WINDOW w AS (PARTITION BY r.request_id)
) WHERE rank <= n
UNION ALL
SELECT request_id, user_id, product_id, category,
       round(1.0 - (rank - 1) / CAST(count(*) OVER (PARTITION BY request_id) AS DOUBLE), 4), rank, 'popular', true FROM (
  SELECT r.request_id, r.user_id, r.n, p.product_id, p.category,
         row_number() OVER (PARTITION BY r.request_id ORDER BY p.rank) AS rank
  FROM asks r JOIN popular p ON r.category IS NULL OR r.category = p.category
  WHERE r.user_id NOT IN (SELECT user_id FROM uv)
    AND NOT (r.exclude_seen AND EXISTS (SELECT 1 FROM seen x WHERE x.user_id = r.user_id AND x.product_id = p.product_id))
) WHERE rank <= n""")

_ORDER = """timestamp, product_id NULLS LAST, rating DESC NULLS LAST, converted DESC, helpful_vote DESC, category"""
for _name, _from in (
    ("split_all", "interactions WHERE user_id IS NOT NULL"),
    ("split_sample", "interactions WHERE user_id IN (FROM eval_users)"),
):
    if _name == "split_sample":
        cte("eval_users", """
SELECT user_id FROM (SELECT user_id, count(*) AS c FROM interactions WHERE user_id IS NOT NULL GROUP BY 1)
WHERE c >= 10""")
        cte("eval_drawn", "SELECT user_id FROM eval_users ORDER BY md5('42:' || user_id), user_id LIMIT 1000")
    cte(_name, f"""
SELECT *, CASE WHEN rn <= floor(n * (1 - CAST(0.2 AS DOUBLE))) THEN 'train' ELSE 'test' END AS split FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY {_ORDER}) AS rn,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM {_from})""")
cte("top10", """
SELECT product_id, nb_interactions, row_number() OVER (ORDER BY nb_interactions DESC, product_id) AS rank FROM (
  SELECT product_id, count(*) AS nb_interactions FROM split_sample
  WHERE split = 'train' AND product_id IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 10)""")
cte("relevant", """
SELECT DISTINCT user_id, product_id FROM split_sample WHERE split = 'test' AND product_id IS NOT NULL""")
cte("ndcg", """
SELECT user_id, coalesce(sum(1 / log2(rank + 1)), 0.0)
       / list_sum([1 / log2(i + 1) for i in range(1, CAST(least(count(*), 10) AS BIGINT) + 1)]) AS ndcg
FROM relevant LEFT JOIN top10 USING (product_id) GROUP BY user_id""")

_KS = """CASE WHEN lam < 0.2 THEN 1.0 ELSE greatest(least(list_sum(
  [(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END) * exp(-2.0 * k * k * lam * lam) for k in range(1, 101)]), 1.0), 0.0) END"""
_LAM = "ks_statistic * sqrt(CAST(n_a AS DOUBLE) * n_b / (CAST(n_a AS DOUBLE) + n_b))"
cte("months", """
SELECT year_month, count(*) AS n, avg(converted) AS rate FROM interactions GROUP BY 1""")
cte("month_pairs", """
SELECT year_month AS month_a, lead(year_month) OVER w AS month_b, n AS n_a, lead(n) OVER w AS n_b,
       rate AS conv_rate_a, lead(rate) OVER w AS conv_rate_b
FROM months WINDOW w AS (ORDER BY year_month)""")
cte("drift", f"""
SELECT month_a, month_b, n_a, n_b, conv_rate_a, conv_rate_b, ks_statistic, {_KS} AS p_value FROM (
  SELECT *, {_LAM} AS lam FROM (
    SELECT *, abs(conv_rate_a - conv_rate_b) AS ks_statistic FROM month_pairs WHERE n_a >= 10 AND n_b >= 10))""")
cte("drift_rating", f"""
SELECT month_a, month_b, n_a, n_b, ks_statistic, {_KS} AS p_value FROM (
  SELECT *, {_LAM} AS lam FROM (
    SELECT month_a, month_b, n_a, n_b, max(abs(cum_a / n_a - cum_b / n_b)) AS ks_statistic FROM (
      SELECT month_a, month_b, n_a, n_b, x,
             sum(a) OVER (PARTITION BY month_a ORDER BY x) AS cum_a,
             sum(b) OVER (PARTITION BY month_a ORDER BY x) AS cum_b FROM (
        SELECT m.month_a, m.month_b, m.n_a, m.n_b, i.rating AS x,
               count(*) FILTER (i.year_month = m.month_a) AS a, count(*) FILTER (i.year_month = m.month_b) AS b
        FROM month_pairs m JOIN interactions i ON i.year_month IN (m.month_a, m.month_b)
        WHERE m.n_a >= 10 AND m.n_b >= 10 GROUP BY ALL))
    GROUP BY ALL))""")

cte("ab", """
SELECT ab_variant, max(n_users) AS n_users, max(n_impressions) AS n_impressions, max(n_clicks) AS n_clicks FROM (
  SELECT ab_variant, count(DISTINCT user_id) AS n_users, count(*) AS n_impressions, 0 AS n_clicks FROM impressions GROUP BY 1
  UNION ALL
  SELECT ab_variant, 0, 0, count(*) FROM feedback WHERE interaction_type IN ('click', 'purchase') GROUP BY 1)
GROUP BY 1""")
cte("ab_wide", """
SELECT *, cc / nc AS rc, ct / nt AS rt, (cc + ct) / (nc + nt) AS pool FROM (
  SELECT CAST(sum(n_users) FILTER (ab_variant = 'control') AS DOUBLE) AS nc,
         CAST(sum(n_users) FILTER (ab_variant = 'treatment') AS DOUBLE) AS nt,
         CAST(sum(n_clicks) FILTER (ab_variant = 'control') AS DOUBLE) AS cc,
         CAST(sum(n_clicks) FILTER (ab_variant = 'treatment') AS DOUBLE) AS ct,
         CAST(sum(n_impressions) FILTER (ab_variant = 'control') AS DOUBLE) AS ic,
         CAST(sum(n_impressions) FILTER (ab_variant = 'treatment') AS DOUBLE) AS it FROM ab)""")
cte("ab_tested", """
SELECT *, CASE WHEN se > 0 THEN (0.254829592*t - 0.284496736*t*t + 1.421413741*t*t*t - 1.453152027*t*t*t*t
                 + 1.061405429*t*t*t*t*t) * exp(-x*x) ELSE 1.0 END AS p FROM (
  SELECT *, 1 / (1 + 0.3275911 * x) AS t FROM (
    SELECT *, CASE WHEN se > 0 THEN abs(rt - rc) / se / sqrt(2.0) ELSE 0.0 END AS x FROM (
      SELECT *, sqrt(greatest(pool * (1 - pool) * (1 / nc + 1 / nt), 0.0)) AS se FROM ab_wide)))""")
cte("lifespan", """
SELECT product_id, strftime(make_timestamp(lo * 1000), '%Y-%m-%d') AS first_date,
       strftime(make_timestamp(hi * 1000), '%Y-%m-%d') AS last_date,
       CAST(date_diff('day', CAST(make_timestamp(lo * 1000) AS DATE), CAST(make_timestamp(hi * 1000) AS DATE)) AS BIGINT) AS lifespan_days,
       early AS n_first_half, late AS n_second_half,
       CASE WHEN late > early * (1 + CAST(0.1 AS DOUBLE)) THEN 'increasing'
            WHEN late < early * (1 - CAST(0.1 AS DOUBLE)) THEN 'decreasing' ELSE 'stable' END AS trend FROM (
  SELECT product_id, lo, hi, count(*) FILTER (timestamp * 2 <= lo + hi) AS early,
         count(*) FILTER (timestamp * 2 > lo + hi) AS late
  FROM (SELECT product_id, timestamp, min(timestamp) OVER (PARTITION BY product_id) AS lo,
               max(timestamp) OVER (PARTITION BY product_id) AS hi
        FROM interactions WHERE product_id IS NOT NULL)
  GROUP BY ALL)""")


# Computed once, and joined as what they are: their own joins must not be mixed with those of a query.
HELD = {
    "pv", "uv", "supported", "warm_products", "warm_users", "factor_items", "factor_users", "bridged_items",
    "fused_products", "seen_means",
}


def full(query: str) -> str:
    """Prefix ``query`` with the expressions it needs, directly or through others."""
    needed: set[str] = set()
    pending = [query]
    while pending:
        words = set(re.findall(r"[a-z_0-9]+", pending.pop()))
        for name in words & CTES.keys() - needed:
            needed.add(name)
            pending.append(CTES[name])
    ordered = _sorted(needed)
    if not ordered:
        return query
    return "WITH " + ",\n".join(f"{n} AS {'MATERIALIZED ' if n in HELD else ''}({CTES[n]})" for n in ordered) + "\n" + query


def _sorted(needed: set[str]) -> list[str]:
    done: list[str] = []

    def visit(name: str) -> None:
        if name in done:
            return
        for other in sorted(set(re.findall(r"[a-z_0-9]+", CTES[name])) & needed - {name}):
            visit(other)
        done.append(name)

    for name in sorted(needed):
        visit(name)
    return done

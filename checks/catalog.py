"""Every registered query with its oracle, by family. Keys are the operator names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from checks.sql import full
from recolens.functions import scalars as S, vectors as V
from recolens.functions.stats import EXACT_ROWS
from recolens.operators import (
    abtest, als, bounded, bridge as br, bronze, cold_start, content, drift, eda, evaluate, features,
    fuse, gold, incremental, ivf, quality, serve, service, silver, skew,
)
from recolens.sources import ingest, readers, writers
from recolens.sources.bind import SUPPORT, Lake
from recolens.streaming import logs, partials, stateful

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

START, TODAY = "2024-01-01", "2024-01-31"
DIGITS = 6


def _rounded(df: DataFrame) -> DataFrame:
    """Doubles to six digits, dates and times as text: one form in both engines."""
    return df.select(
        *[
            F.round(f.name, DIGITS).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.date_format(f.name, "yyyy-MM-dd HH:mm:ss").alias(f.name)
            if isinstance(f.dataType, T.TimestampType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def query(name: str, sql: str | None = None):
    def register(build: Callable[[Lake], DataFrame]):
        QUERIES[name] = lambda spark, folder: _rounded(build(Lake(spark, folder)))
        if sql is not None:
            ORACLES[name] = full(sql)
        return build

    return register


def simple(name: str, build: Callable[[Lake], DataFrame], sql: str | None = None) -> None:
    query(name, sql)(build)


def _tall(df: DataFrame, key: str, vector: str, *extra: str) -> DataFrame:
    """A vector column as (key, pos, value) rows."""
    return df.select(key, *extra, F.posexplode(vector).alias("pos", "value")).withColumn(
        "value", F.col("value").cast("double")
    )


_INTER = "user_id, product_id, rating, timestamp, interaction_type, converted, year_month, helpful_vote, category"
_SILVER = _INTER + ", recency_rank, user_interaction_count, round(rf_score, 6) AS rf_score"
_TALL = "unnest(range(0, 16)) AS pos, round(unnest({0}), 6) + 0.0 AS value"

def _scaled_popularity(products: DataFrame) -> DataFrame:
    score = F.col("popularity_score")
    ends = products.agg(F.struct(F.min(score).alias("low"), F.max(score).alias("high"))).scalar()
    scaled = S.minmax(score, ends.getField("low"), ends.getField("high"))
    return products.select("product_id", scaled.alias("scaled"))


def _listed(popular: DataFrame) -> DataFrame:
    size = popular.agg(F.count(F.lit(1))).scalar()
    return popular.select("product_id", "rank", serve.popular_rank_score(F.col("rank"), size).alias("score"))


# --- A: sources and sinks ----------------------------------------------------------------


@query("read_reviews", """
SELECT user_id, product_id AS asin, rating, timestamp, verified_purchase, helpful_vote, category FROM reviews""")
def _(lake: Lake) -> DataFrame:
    path = lake.scratch("reviews")
    writers.write_partitioned(lake.reviews(), path)
    return readers.read_reviews(lake.spark, path)


@query("read_metadata", """
SELECT product_id, category, title, p_brand AS first_description, price, store
FROM products JOIN part ON product_id = 'P' || p_partkey""")
def _(lake: Lake) -> DataFrame:
    path = lake.scratch("metadata")
    raw = lake.metadata().withColumnRenamed("product_id", "asin")
    writers.write_partitioned(raw, path)
    return readers.read_metadata(lake.spark, path).select(
        "product_id", "category", "title",
        F.try_element_at("description", F.lit(1)).alias("first_description"), "price", "store",
    )


simple("common_categories", lambda k: readers.common_categories(k.reviews(), k.metadata(), 4), """
SELECT category FROM (SELECT category FROM reviews INTERSECT SELECT category FROM products)
ORDER BY category LIMIT 4""")


@query("skip_done", """
SELECT category, count(*) AS n FROM interactions
WHERE category NOT IN (SELECT category FROM interactions GROUP BY 1 ORDER BY 1 LIMIT 2) GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    path = lake.scratch("interactions")
    rows = lake.interactions()
    done = rows.select("category").distinct().orderBy("category").limit(2)
    writers.write_partitioned(rows.join(F.broadcast(done), "category", "left_semi"), path)
    ingested = readers.scan_table(lake.spark, path)
    return readers.skip_done(rows, ingested).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("scan_table", f"SELECT {_INTER} FROM interactions")
def _(lake: Lake) -> DataFrame:
    path = lake.scratch("interactions")
    writers.write_partitioned(lake.interactions(), path)
    return readers.scan_table(lake.spark, path)


@query("scan_columns", """
SELECT year_month, converted, count(*) AS n FROM interactions GROUP BY ALL""")
def _(lake: Lake) -> DataFrame:
    path = lake.scratch("interactions")
    writers.write_partitioned(lake.interactions(), path)
    rows = readers.scan_columns(lake.spark, path, ["year_month", "converted"])
    return rows.groupBy("year_month", "converted").agg(F.count(F.lit(1)).alias("n"))


@query("append_logs", """
SELECT 'feedback' AS log, ab_variant, count(*) AS n FROM feedback GROUP BY ALL
UNION ALL SELECT 'impressions', ab_variant, count(*) FROM impressions GROUP BY ALL""")
def _(lake: Lake) -> DataFrame:
    fb, imp = lake.scratch("feedback"), lake.scratch("impressions")
    writers.append_feedback(lake.feedback(), fb)
    writers.append_impressions(lake.impressions(), imp)
    both = [(fb, "feedback"), (imp, "impressions")]
    parts = [
        lake.spark.read.parquet(path).groupBy("ab_variant").agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(log).alias("log"), "ab_variant", "n")
        for path, log in both
    ]
    return parts[0].unionByName(parts[1])


simple("plot_ratings", lambda k: eda.rating_distribution(k.interactions(), 4), """
SELECT rating, count(*) AS nb, round(count(*) / sum(count(*)) OVER () * 100, 4) AS pct
FROM interactions WHERE rating > 0 GROUP BY 1""")
simple("plot_categories", lambda k: eda.category_share(k.interactions(), eda.TOP_CATEGORIES), """
SELECT category, nb_interactions, round(nb_interactions / sum(nb_interactions) OVER () * 100, 1) AS pct FROM (
  SELECT category, count(*) AS nb_interactions FROM interactions GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15)""")
simple(
    "plot_ctr",
    lambda k: abtest.ctr_table(
        abtest.ab_results(abtest.ab_counts(k.impressions(), k.feedback()), START, TODAY)
    ),
    "SELECT 'control' AS variant, round(rc, 4) AS ctr FROM ab_wide UNION ALL SELECT 'treatment', round(rt, 4) FROM ab_wide",
)

# --- B: projections, filters, scalars ----------------------------------------------------

simple("bronze_interactions", lambda k: k.interactions(), f"SELECT {_INTER} FROM interactions")
simple(
    "interaction_type",
    lambda k: k.reviews().select(
        S.interaction_type(F.col("verified_purchase")).alias("interaction_type"),
        S.converted(S.interaction_type(F.col("verified_purchase"))).alias("converted"),
        S.year_month(F.col("timestamp")).alias("year_month"),
    ).groupBy("interaction_type", "converted", "year_month").agg(F.count(F.lit(1)).alias("n")),
    "SELECT interaction_type, converted, year_month, count(*) AS n FROM interactions GROUP BY ALL",
)
_NO_METADATA = ("p", "average_rating", "rating_number")  # columns the tables cannot fill
simple("bronze_products", lambda k: k.products().drop(*_NO_METADATA), """
SELECT product_id, category, title, price, store FROM products""")
simple("drop_null_keys", lambda k: silver.drop_null_keys(k.interactions()), f"""
SELECT {_INTER} FROM interactions WHERE user_id IS NOT NULL AND product_id IS NOT NULL""")
simple(
    "clamp_rating",
    lambda k: silver.clamp_ratings(silver.drop_null_keys(k.interactions())),
    f"SELECT {_INTER} FROM clean",
)
simple(
    "category_filter",
    lambda k: readers.category_filter(k.interactions(), ["ECONOMY", "SMALL"]),
    f"SELECT {_INTER} FROM interactions WHERE category IN ('ECONOMY', 'SMALL')",
)
simple("rated_only", lambda k: eda.rated_only(k.interactions()), f"""
SELECT {_INTER} FROM interactions WHERE rating > 0""")
simple(
    "valid_months",
    lambda k: k.interactions().filter(S.valid_month(F.col("year_month"))),
    f"SELECT {_INTER} FROM interactions WHERE year_month IS NOT NULL",
)
simple("segment", lambda k: k.users().select("user_id", "segment"), "SELECT user_id, segment FROM users")
simple(
    "placeholders",
    lambda k: k.users().select(
        "user_id", "avg_order_value", F.size("u").alias("dims"), V.norm(F.col("u")).alias("length")
    ),
    "SELECT user_id, 0.0::DOUBLE AS avg_order_value, 16::INTEGER AS dims, 0.0::DOUBLE AS length FROM users",
)
simple(
    "fill_defaults",
    lambda k: gold.fill_defaults(
        k.products().select("product_id").join(
            gold.popularity_score(gold.product_stats(k.silver())).drop("nb_conversions"),
            "product_id", "left",
        )
    ),
    """SELECT product_id, nb_interactions, round(conversion_rate, 6) AS conversion_rate,
              round(popularity_score, 6) AS popularity_score FROM gold_high""",
)
simple(
    "zero_fill",
    lambda k: _tall(
        k.products().select("product_id").join(k.bridged_items(), "product_id", "left")
        .select("product_id", V.or_zeros(F.col("p")).alias("p")),
        "product_id", "p",
    ),
    f"""SELECT product_id, {_TALL.format("coalesce(b.p, [0.0 for x in range(16)])")}
        FROM products LEFT JOIN bridged_items b USING (product_id)""",
)
simple("is_cold", lambda k: k.gold_products(SUPPORT).select("product_id", "nb_interactions", "is_cold"), """
SELECT product_id, nb_interactions, is_cold FROM gold_high""")
simple("build_corpus", lambda k: content.build_corpus(k.metadata()), """
SELECT product_id, trim(title || ' ' || store) AS text FROM products""")
simple(
    "dot",
    lambda k: k.product_vectors().select("product_id", V.dot(F.col("p"), F.col("p")).alias("d")),
    "SELECT product_id, round(list_dot_product(p, p), 6) AS d FROM pv",
)
simple(
    "l2_normalize",
    lambda k: _tall(
        k.product_vectors().select("product_id", V.l2_normalize(F.col("p")).alias("p")),
        "product_id", "p",
    ),
    f"""SELECT product_id, {_TALL.format("[x / sqrt(list_dot_product(p, p)) for x in p]")} FROM pv""",
)
simple(
    "minmax",
    lambda k: _scaled_popularity(k.gold_products(SUPPORT)),
    """SELECT product_id, round((popularity_score - (SELECT min(popularity_score) FROM gold_high))
       / ((SELECT max(popularity_score) - min(popularity_score) FROM gold_high) + 1e-8), 6) AS scaled FROM gold_high""",
)
simple(
    "clip01",
    lambda k: k.table("customer").select("c_custkey", S.clip01(F.col("c_acctbal") / 1000).alias("clipped")),
    "SELECT c_custkey, round(greatest(least(c_acctbal / 1000, 1.0), 0.0), 6) AS clipped FROM customer",
)
simple(
    "source_label",
    lambda k: k.gold_products(SUPPORT).select("product_id", S.source_label(F.col("is_cold")).alias("source")),
    "SELECT product_id, CASE WHEN is_cold THEN 'bridge' ELSE 'als' END AS source FROM gold_high",
)
_FB = "event_id, user_id, product_id, interaction_type, ab_variant, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts"
simple("validate_feedback", lambda k: abtest.validate_feedback(k.raw_feedback())[0], f"SELECT {_FB} FROM feedback")
simple("rejected_feedback", lambda k: abtest.validate_feedback(k.raw_feedback())[1], f"""
SELECT {_FB}, 'invalid interaction_type' AS reason FROM raw_feedback
WHERE interaction_type NOT IN ('click', 'purchase', 'skip')""")


def _spoiled(recs: DataFrame) -> DataFrame:
    """Recommendations of which some break the checks: ranks 2 lose their score, 3 are scaled, 4 relabelled."""
    rank = F.col("rank")
    return recs.withColumns(
        {
            "score": F.when(rank == 3, F.col("score") * 2 + 0.5).when(rank != 2, F.col("score")),
            "source": F.when(rank == 4, "other").otherwise(F.col("source")),
        }
    )


simple("validate_scores", lambda k: quality.dq_scores(_spoiled(_recommended(k))), """
SELECT 'recommendations' AS table_name, c.check_name, c.failed, t.total, c.failed = 0 AS success FROM (
  SELECT count(*) AS total, count(*) FILTER (score IS NULL OR score NOT BETWEEN 0 AND 1) AS f1,
         count(*) FILTER (source NOT IN ('als', 'bridge', 'popular')) AS f2 FROM (
    SELECT CASE WHEN rank = 3 THEN score * 2 + 0.5 WHEN rank <> 2 THEN score END AS score,
           CASE WHEN rank = 4 THEN 'other' ELSE source END AS source FROM recommended)) t,
  LATERAL (SELECT 'score_between' AS check_name, t.f1 AS failed UNION ALL SELECT 'source_in_set', t.f2
           UNION ALL SELECT 'row_count', CAST(t.total = 0 AS BIGINT)) c""")
simple(
    "n_days",
    lambda k: k.table("orders").select(
        "o_orderkey",
        S.days_running(F.to_date("o_orderdate"), F.lit("2000-01-01").cast("date")).alias("n_days"),
    ),
    """SELECT o_orderkey, CAST(greatest(date_diff('day', CAST(o_orderdate AS DATE), DATE '2000-01-01') + 1, 1) AS INTEGER) AS n_days
       FROM orders""",
)

# --- C: joins ------------------------------------------------------------------------------

simple(
    "attach_factors",
    lambda k: _tall(
        fuse.attach_factors(k.products(), k.factor_items(), "product_id", "p").select(
            "product_id", V.or_zeros(F.col("p")).alias("p")
        ),
        "product_id", "p",
    ),
    f"""SELECT product_id, {_TALL.format("coalesce(f.p, [0.0 for x in range(16)])")}
        FROM products LEFT JOIN factor_items f USING (product_id)""",
)
simple(
    "coalesce_vectors",
    lambda k: _tall(
        fuse.coalesce_vectors(
            fuse.attach_factors(k.products(), k.factor_items(), "product_id", "p"),
            k.bridged_items(), "product_id", "p",
        ).filter(F.col("p").isNotNull()),
        "product_id", "p",
    ),
    f"""SELECT product_id, {_TALL.format("coalesce(f.p, b.p)")} FROM products
        LEFT JOIN factor_items f USING (product_id) LEFT JOIN bridged_items b USING (product_id)
        WHERE coalesce(f.p, b.p) IS NOT NULL""",
)
simple(
    "interaction_vectors",
    lambda k: fuse.interaction_vectors(k.interactions(), k.product_vectors())
    .groupBy("user_id")
    .agg(F.count("p").alias("n_vectors"), F.avg(F.col("p")[0].cast("double")).alias("mean_first")),
    """SELECT user_id, count(p) AS n_vectors, round(avg(p[1]), 6) AS mean_first
       FROM interactions LEFT JOIN pv USING (product_id) GROUP BY user_id""",
)
simple("min_support_filter", lambda k: k.supported, f"SELECT {_INTER} FROM supported")
simple(
    "semi_by_ids",
    lambda k: cold_start.semi_by_ids(
        k.interactions(), cold_start.warm_ids(k.interactions(), "product_id", SUPPORT), "product_id"
    ),
    f"SELECT {_INTER} FROM interactions WHERE product_id IN (FROM warm_products)",
)
simple(
    "cold_ids",
    lambda k: cold_start.cold_ids(
        k.products(), cold_start.warm_ids(k.interactions(), "product_id", SUPPORT), "product_id"
    ),
    "SELECT product_id FROM products EXCEPT FROM warm_products",
)
simple(
    "exclude_seen",
    lambda k: cold_start.exclude_seen(
        k.recommend_requests().select("user_id", F.col("category").alias("c"))
        .join(cold_start.popularity_by_category(k.interactions()), F.col("c") == F.col("category"))
        .select("user_id", "product_id"),
        cold_start.seen_items(k.interactions()),
    ),
    """SELECT r.user_id, p.product_id FROM asks r JOIN by_category p USING (category)
       WHERE NOT EXISTS (SELECT 1 FROM seen x WHERE x.user_id = r.user_id AND x.product_id = p.product_id)""",
)
_GOLD = """product_id, category, title, price, store,
round(conversion_rate, 6) AS conversion_rate, round(popularity_score, 6) AS popularity_score, nb_interactions, is_cold"""
simple("gold_products", lambda k: k.gold_products().drop(*_NO_METADATA), f"SELECT {_GOLD} FROM gold")
simple("gold_products_sparse", lambda k: k.gold_products(SUPPORT).drop(*_NO_METADATA), f"SELECT {_GOLD} FROM gold_high")
def _gold_interactions(lake: Lake) -> DataFrame:
    """As in the pipeline: from the written bronze and silver tables and the written statistics."""
    source, path = lake.scratch("interactions"), lake.scratch("silver")
    lake.interactions().write.parquet(source)
    writers.write_partitioned(silver.silver_interactions(lake.spark.read.parquet(source)), path)
    rows = readers.scan_table(lake.spark, path)
    stats = skew.cut(gold.popularity_score(gold.product_stats(rows)))
    return gold.gold_interactions(rows, stats)


simple("gold_interactions", _gold_interactions, f"""
SELECT {_SILVER}, round(coalesce(p.conversion_rate, 0.0), 6) AS conversion_rate,
       round(coalesce(p.popularity_score, 0.0), 6) AS popularity_score
FROM silver LEFT JOIN popularity p USING (product_id)""")
_JOINED = """SELECT i.product_id, i.user_id, i.timestamp, i.rating, p.title, p.price
FROM interactions i LEFT JOIN products p USING (product_id)"""


def _join_sides(lake: Lake) -> tuple[DataFrame, DataFrame]:
    rows = lake.interactions().select("product_id", "user_id", "timestamp", "rating")
    return rows, lake.products().select("product_id", "title", "price")


simple("join_sortmerge", lambda k: gold.join_sortmerge(*_join_sides(k)), _JOINED)
simple("join_broadcast", lambda k: gold.join_broadcast(*_join_sides(k)), _JOINED)
simple(
    "active_users",
    lambda k: eda.active_users(k.customers(), k.interactions()),
    "SELECT 'U' || c_custkey AS user_id FROM customer WHERE 'U' || c_custkey IN (SELECT user_id FROM interactions)",
)
simple(
    "purchases_by_segment", lambda k: eda.purchases_by_segment(k.interactions(), k.users()), """
SELECT segment, CAST(n AS BIGINT) AS purchases, round(n / sum(n) OVER () * 100, 1) AS pct_purchases FROM (
  SELECT segment, count(*) AS n FROM interactions LEFT JOIN users USING (user_id)
  WHERE interaction_type = 'purchase' GROUP BY 1)""",
)
simple("score_matrix", lambda k: serve.score_matrix(k.user_vectors(), k.product_vectors()), """
SELECT user_id, count(*) AS n_scores, min(score) AS min_score, max(score) AS max_score,
       round(sum(score), 6) AS total_score, arg_max(product_id, (score, -1 * rn)) AS best_product
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY product_id) AS rn FROM scores) GROUP BY user_id""")
simple("orphan_rate", lambda k: gold.orphan_rate(k.interactions(), k.products()), """
SELECT count(*) FILTER (p.product_id IS NULL) AS n_orphans, count(*) AS n_rows,
       round(count(*) FILTER (p.product_id IS NULL) / count(*), 6) AS orphan_rate
FROM interactions i LEFT JOIN products p USING (product_id)""")
simple(
    "index_ids", lambda k: skew.dense_index(k.interactions(), "user_id", "user_id_int"), """
SELECT row_number() OVER (ORDER BY user_id) - 1 AS user_id_int, user_id
FROM (SELECT DISTINCT user_id FROM interactions WHERE user_id IS NOT NULL)""",
)

# --- D: aggregations -----------------------------------------------------------------------

simple("user_profile_partial", lambda k: bronze.user_profile_partial(k.interactions()), """
SELECT * REPLACE (round(avg_rating, 6) AS avg_rating) FROM partials""")
simple("user_profile", lambda k: k.users().drop("avg_order_value", "u"), """
SELECT * REPLACE (round(avg_rating, 6) AS avg_rating, round(avg_rating_weighted, 6) AS avg_rating_weighted) FROM users""")
simple("user_profile_sparse", lambda k: k.users().drop("avg_order_value", "u"), """
SELECT * REPLACE (round(avg_rating, 6) AS avg_rating, round(avg_rating_weighted, 6) AS avg_rating_weighted) FROM users""")
simple(
    "purchase_quantiles",
    lambda k: bronze.purchase_quantiles(
        bronze.merge_profiles(bronze.user_profile_partial(k.interactions()))
    ),
    "SELECT round(quantile_cont(total_purchases, 0.5), 6) AS p50, round(quantile_cont(total_purchases, 0.9), 6) AS p90 FROM merged",
)
simple("product_stats", lambda k: gold.product_stats(k.silver()), """
SELECT * REPLACE (round(conversion_rate, 6) AS conversion_rate) FROM stats""")
simple("popularity_score", lambda k: gold.popularity_score(gold.product_stats(k.silver())), """
SELECT * REPLACE (round(conversion_rate, 6) AS conversion_rate, round(popularity_score, 6) AS popularity_score)
FROM popularity""")
simple("pair_counts", lambda k: cold_start.pair_counts(k.interactions()), """
SELECT user_id, product_id, count(*) AS count FROM interactions
WHERE user_id IS NOT NULL AND product_id IS NOT NULL GROUP BY ALL""")
simple("classify_warm_cold", lambda k: cold_start.classify_warm_cold(k.interactions(), "user_id", SUPPORT), """
SELECT user_id, count(*) AS nb_interactions, count(*) < 32 AS is_cold
FROM interactions WHERE user_id IS NOT NULL GROUP BY 1""")
simple("cold_start_report", lambda k: cold_start.cold_start_report(k.interactions(), SUPPORT), """
SELECT entity, n_warm, n_cold, round(n_warm * 100.0 / (n_warm + n_cold), 6) AS pct_warm,
       round(n_cold * 100.0 / (n_warm + n_cold), 6) AS pct_cold FROM (
  SELECT entity, count(*) FILTER (n >= 32) AS n_warm, count(*) FILTER (n < 32) AS n_cold FROM (
    SELECT 'products' AS entity, product_id AS id, count(*) AS n FROM interactions WHERE product_id IS NOT NULL GROUP BY ALL
    UNION ALL SELECT 'users', user_id, count(*) FROM interactions WHERE user_id IS NOT NULL GROUP BY ALL)
  GROUP BY 1)""")
simple("popular_global", lambda k: cold_start.popular_global(k.interactions(), k.products()), """
SELECT product_id, nb_interactions, category, CAST(rank AS INTEGER) AS rank FROM popular""")
simple("seen_items", lambda k: cold_start.seen_items(k.interactions()), "SELECT user_id, product_id FROM seen")
simple(
    "cold_user_vectors",
    lambda k: _tall(
        fuse.cold_user_vectors(
            k.interactions(),
            fuse.fuse_products(k.products(), k.factor_items(), k.bridged_items(), k.interactions(), SUPPORT),
            k.factor_users(),
        ),
        "user_id", "u",
    ),
    f"SELECT user_id, {_TALL.format('u')} FROM seen_means",
)
simple("sparsity", lambda k: eda.sparsity(k.interactions(), k.users(), k.products()), """
SELECT n_interactions, n_pairs, n_users, n_products,
       round((1 - n_interactions / (n_users * n_products)) * 100, 6) AS sparsity_pct,
       round((1 - n_pairs / (n_users * n_products)) * 100, 6) AS sparsity_distinct_pct
FROM (SELECT (SELECT count(*) FROM interactions) AS n_interactions, (SELECT count(*) FROM seen) AS n_pairs,
             (SELECT count(*) FROM users) AS n_users, (SELECT count(*) FROM products) AS n_products)""")
simple("interaction_type_share", lambda k: eda.interaction_type_share(k.interactions()), """
SELECT interaction_type, count(*) AS nb, round(count(*) / 1e6, 2) AS millions,
       round(avg(converted), 3) AS conv_rate, round(count(*) / sum(count(*)) OVER () * 100, 1) AS pct
FROM interactions GROUP BY 1""")
simple("helpful_stats", lambda k: eda.helpful_stats(k.interactions()), """
SELECT count(*) FILTER (helpful_vote > 0) AS with_helpful_vote, round(avg(helpful_vote), 2) AS helpful_mean,
       max(helpful_vote) AS helpful_max FROM interactions""")
simple("rating_distribution", lambda k: eda.rating_distribution(k.interactions()), """
SELECT rating, count(*) AS nb, round(count(*) / sum(count(*)) OVER () * 100, 1) AS pct
FROM interactions WHERE rating > 0 GROUP BY 1""")
simple("rating_stats", lambda k: eda.rating_stats(k.interactions()), """
SELECT round(avg(rating), 3) AS mean_rating, round(stddev(rating), 3) AS stddev_rating,
       min(rating) AS min_rating, max(rating) AS max_rating FROM interactions WHERE rating > 0""")
simple("category_share", lambda k: eda.category_share(k.interactions()), """
SELECT category, count(*) AS nb_interactions, round(count(*) / sum(count(*)) OVER () * 100, 1) AS pct
FROM interactions GROUP BY 1""")
for _name, _id in (("long_tail_products", "product_id"), ("long_tail_users", "user_id")):
    simple(
        _name,
        lambda k, c=_id: eda.long_tail(
            k.interactions(), c, k.products() if c == "product_id" else k.customers()
        ),
        f"""SELECT CAST(s AS INTEGER) AS threshold, count(*) FILTER (n <= s) AS n_rare,
                   round(count(*) FILTER (n <= s) * 100.0 / (SELECT count(*) FROM {'part' if _id == 'product_id' else 'customer'}), 4) AS pct
            FROM (SELECT {_id}, count(*) AS n FROM interactions WHERE {_id} IS NOT NULL GROUP BY 1),
                 (SELECT unnest([1, 5, 10, 20, 50]) AS s) GROUP BY s""",
    )
simple("segment_stats", lambda k: eda.segment_stats(k.users()), """
SELECT segment, count(*) AS nb_users, round(avg(total_purchases), 1) AS mean_purchases,
       round(avg(avg_rating), 2) AS mean_rating, CAST(sum(total_purchases) AS BIGINT) AS total_purchases,
       round(count(*) / sum(count(*)) OVER () * 100, 1) AS pct_users FROM users GROUP BY 1""")
simple("monthly_volume", lambda k: eda.monthly_volume(k.interactions()), """
SELECT year_month, count(*) AS nb FROM interactions GROUP BY 1""")
simple("embedding_means", lambda k: eda.embedding_means(k.product_vectors()), """
SELECT category, round(avg(p[1]), 4) AS P1, round(avg(p[2]), 4) AS P2, round(avg(p[3]), 4) AS P3,
       round(avg(p[4]), 4) AS P4 FROM pv GROUP BY 1""")
simple("eda_recap", lambda k: eda.eda_recap(k.interactions(), k.users(), k.products(), SUPPORT), """
SELECT round((1 - n / (CAST(u AS DOUBLE) * p)) * 100, 4) AS sparsity_pct, round(reviews * 100.0 / n, 1) AS review_pct,
       round(five * 100.0 / rated, 1) AS five_star_pct, round(rare * 100.0 / p, 4) AS rare_product_pct,
       round(power * 100.0 / u, 1) AS power_user_pct
FROM (SELECT count(*) AS n, count(*) FILTER (interaction_type = 'review') AS reviews,
             count(*) FILTER (rating = 5) AS five, count(*) FILTER (rating > 0) AS rated FROM interactions),
     (SELECT count(*) AS u, count(*) FILTER (segment = 'power_user') AS power FROM users),
     (SELECT count(*) AS p FROM products),
     (SELECT count(*) AS rare FROM (SELECT product_id FROM interactions WHERE product_id IS NOT NULL GROUP BY 1 HAVING count(*) < 32))""")
simple("relevant_sets", lambda k: evaluate.relevant_sets(evaluate.test_rows(evaluate.sampled_split(k.interactions()))), """
SELECT user_id, product_id FROM relevant""")
simple("recs_summary", lambda k: serve.recs_summary(serve.batch_recommend(k.user_vectors(), k.product_vectors())), """
SELECT count(*) AS n_recommendations, round(avg(score), 6) AS avg_score FROM (
  SELECT score FROM scores QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) <= 10)""")
simple("layer_counts", lambda k: silver.layer_counts(k.interactions(), k.silver()), """
SELECT (SELECT count(*) FROM interactions) AS n_before, (SELECT count(*) FROM silver) AS n_after,
       (SELECT count(*) FROM interactions) - (SELECT count(*) FROM silver) AS n_removed""")
simple(
    "catalog_counts",
    lambda k: eda.catalog_counts(k.products(), k.users(), cold_start.popular_global(k.interactions(), k.products())),
    """SELECT (SELECT count(*) FROM products) AS products, (SELECT count(*) FROM users) AS users,
              (SELECT count(*) FROM popular) AS popular_products""",
)

# --- E, F, G: windows, sorts, sets ---------------------------------------------------------

simple("silver_interactions", lambda k: k.silver(), f"SELECT {_SILVER} FROM silver")
simple("silver_interactions_sparse", lambda k: k.silver(), f"SELECT {_SILVER} FROM silver")
simple("recency_rank", lambda k: k.silver().select("user_id", "product_id", "timestamp", "recency_rank"), """
SELECT user_id, product_id, timestamp, recency_rank FROM silver""")
simple(
    "user_interaction_count",
    lambda k: k.silver().select("user_id", "user_interaction_count").distinct(),
    "SELECT DISTINCT user_id, user_interaction_count FROM silver",
)
simple("rf_score", lambda k: k.silver().groupBy("user_id").agg(F.sum("rf_score").alias("rf_total")), """
SELECT user_id, round(sum(rf_score), 6) AS rf_total FROM silver GROUP BY 1""")
simple("dedup_interactions", lambda k: silver.dedup_interactions(silver.clamp_ratings(silver.drop_null_keys(k.interactions()))), f"""
SELECT {_INTER} FROM dedup""")
simple("split_train_test", lambda k: evaluate.split_train_test(k.interactions()), f"""
SELECT {_INTER}, split FROM split_all""")
simple("popularity_by_category", lambda k: cold_start.popularity_by_category(k.interactions()), """
SELECT category, product_id, nb_interactions, CAST(rank AS INTEGER) AS rank FROM by_category""")
_TOP = "user_id, product_id, score, CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS INTEGER) AS rank"
simple(
    "topn_per_user",
    lambda k: serve.batch_recommend(k.user_vectors(), k.product_vectors(), 5, item_block=400).drop("generated_at"),
    f"SELECT {_TOP} FROM scores QUALIFY rank <= 5",
)
# The same rows from norm classes of 50 products. In the second query the products' vectors are weighted by
# demand, so that norms differ as those of factors do; the third says what that saves.
simple(
    "batch_recommend_bounded",
    lambda k: serve.batch_recommend_bounded(k.user_vectors(), k.product_vectors(), 10, class_items=50).rows,
    f"SELECT {_TOP} FROM scores QUALIFY rank <= 10",
)


def _in_demand(lake: Lake) -> serve.Bounded:
    demand = lake.interactions().where("product_id is not null").groupBy("product_id").agg(F.count(F.lit(1)).alias("m"))
    weighted = lake.product_vectors().join(demand, "product_id").withColumn("p", F.transform("p", lambda x: (x * F.col("m")).cast("float")))
    return serve.batch_recommend_bounded(lake.user_vectors(), weighted, 10, class_items=50)


_DEMAND = """
WITH m AS (SELECT product_id, count(*) AS m FROM interactions WHERE product_id IS NOT NULL GROUP BY 1),
d AS (SELECT product_id, list_transform(p, lambda x: CAST(CAST(x * m AS FLOAT) AS DOUBLE)) AS p FROM pv JOIN m USING (product_id))"""
simple("recommend_by_demand", lambda k: _in_demand(k).rows, f"""
SELECT * FROM ({_DEMAND}, scores AS (SELECT user_id, product_id, round(list_dot_product(u, p), 6) + 0.0 AS score FROM uv, d)
SELECT {_TOP} FROM scores QUALIFY rank <= 10)""")
simple(
    "bounded_work",
    lambda k: bounded.left_out(_in_demand(k).work).select("n_pairs", (F.col("left_out") > 0.05).alias("saves")),
    f"SELECT * FROM ({_DEMAND} SELECT (SELECT count(*) FROM uv) * (SELECT count(*) FROM d) AS n_pairs, true AS saves)",
)


def _indexed(lake: Lake) -> tuple[DataFrame, DataFrame]:
    """Nearest vectors of every fiftieth one, by the index and exactly."""
    vectors = lake.content_vectors()
    wanted = vectors.where(F.col("product_id").cast("long") % 50 == 0)
    index = ivf.write_index(ivf.build_index(vectors), lake.scratch("index"))
    return ivf.similar_in_index(index, wanted, 10, ivf.probes_for(index, 10)), serve.similar_items(vectors, 10, wanted.select("product_id"))


simple("similar_items_index", lambda k: _indexed(k)[0])
simple(
    "index_recall",
    lambda k: ivf.recall(*_indexed(k)).select("n_queries", "n_neighbours", (F.col("recall") >= 0.9).alias("enough")),
    """SELECT count(*) AS n_queries, sum(least(10, n - 1))::BIGINT AS n_neighbours, true AS enough
       FROM embeddings, (SELECT count(*) AS n FROM embeddings) WHERE vec_id % 50 = 0""",
)
simple("consecutive_months", lambda k: drift.consecutive_months(eda.distinct_months(k.interactions())), """
SELECT month_a, month_b FROM month_pairs WHERE month_b IS NOT NULL""")
simple(
    "popular_rank_score",
    lambda k: _listed(cold_start.popular_global(k.interactions(), k.products())),
    """SELECT product_id, CAST(rank AS INTEGER) AS rank,
              round(1.0 - (rank - 1) / CAST((SELECT count(*) FROM popular) AS DOUBLE), 4) AS score FROM popular""",
)
simple("top_products", lambda k: evaluate.top_products(evaluate.train_rows(evaluate.sampled_split(k.interactions()))), """
SELECT product_id, nb_interactions, CAST(rank AS INTEGER) AS rank FROM top10""")
simple("median_month", lambda k: eda.median_month(k.interactions()), """
SELECT year_month FROM (SELECT year_month, row_number() OVER (ORDER BY year_month) AS rn, count(*) OVER () AS n FROM months)
WHERE rn = n // 2 + 1""")
simple("distinct_months", lambda k: eda.distinct_months(k.interactions()), "SELECT year_month FROM months")
simple("distinct_users", lambda k: k.interactions().select("user_id").distinct(), "SELECT DISTINCT user_id FROM interactions")
simple("intersect_categories", lambda k: readers.common_categories(k.reviews(), k.metadata()), """
SELECT category FROM reviews INTERSECT SELECT category FROM products""")
simple(
    "except_ids",
    lambda k: cold_start.cold_ids(k.customers(), cold_start.warm_ids(k.interactions(), "user_id", SUPPORT), "user_id"),
    "SELECT 'U' || c_custkey AS user_id FROM customer EXCEPT FROM warm_users",
)
simple("dedup_products", lambda k: bronze.dedup_products(k.metadata().unionByName(k.metadata())).drop("description"), """
SELECT product_id, category, title, price, store FROM products""")
simple(
    "union_partials",
    lambda k: bronze.merge_profiles(
        bronze.user_profile_partial(readers.category_filter(k.interactions(), ["ECONOMY", "SMALL", "MEDIUM"]))
        .unionByName(
            bronze.user_profile_partial(readers.category_filter(k.interactions(), ["LARGE", "PROMO", "STANDARD"]))
        )
    ),
    """SELECT * REPLACE (round(avg_rating, 6) AS avg_rating, round(avg_rating_weighted, 6) AS avg_rating_weighted) FROM merged""",
)

# --- I: models, serving, evaluation --------------------------------------------------------


@query("content_embed", "SELECT product_id, 1.0::DOUBLE AS length FROM products")
def _(lake: Lake) -> DataFrame:
    vectors = content.content_embed(content.build_corpus(lake.metadata()))
    return vectors.select("product_id", V.norm(F.col("embedding")).alias("length"))


@query("content_embed_documents", r"""
SELECT CAST(doc_id AS VARCHAR) AS product_id,
       CASE WHEN regexp_matches(text, '[\p{L}\p{N}]') THEN 1.0::DOUBLE ELSE 0.0 END AS length FROM documents""")
def _(lake: Lake) -> DataFrame:
    texts = lake.table("documents").select(F.col("doc_id").cast("string").alias("product_id"), "text")
    return content.content_embed(texts).select("product_id", V.norm(F.col("embedding")).alias("length"))


def _trained(lake: Lake, supported: bool = True):
    rows = lake.interactions().select("user_id", "product_id")
    if supported:
        # Written once: the filter reads the rows three times.
        path = lake.scratch("ids")
        rows.write.parquet(path)
        rows = cold_start.min_support_filter(lake.spark.read.parquet(path), SUPPORT)
    pairs = skew.cut(cold_start.pair_counts(rows))
    ids = als.index_ids(pairs)
    model = als.als_fit(ids.pairs)
    return ids, model, *als.als_factors(model, ids)


@query("als_fit", """
SELECT DISTINCT 'user' AS kind, user_id AS id, 16::INTEGER AS rank FROM seen
UNION ALL SELECT DISTINCT 'product', product_id, 16 FROM seen""")
def _(lake: Lake) -> DataFrame:
    _, _, users, items = _trained(lake, supported=False)
    u = users.select(F.lit("user").alias("kind"), F.col("user_id").alias("id"), F.size("u").alias("rank"))
    return u.unionByName(
        items.select(F.lit("product").alias("kind"), F.col("product_id").alias("id"), F.size("p").alias("rank"))
    )


simple("als_factors", lambda k: _tall(_trained(k)[3], "product_id", "p"))


def _bridge_parts(lake: Lake):
    _, _, users, items = _trained(lake)
    items, users = skew.cut(items), skew.cut(users)
    embeddings = skew.cut(content.content_embed(content.build_corpus(lake.metadata())))
    warm = cold_start.warm_ids(lake.interactions(), "product_id", SUPPORT)
    train = br.bridge_training_set(items, embeddings, warm)
    return users, items, embeddings, skew.cut(train)


simple(
    "bridge_training_set",
    lambda k: _bridge_parts(k)[3].select("product_id", F.size("x").alias("dx"), F.size("y").alias("dy")),
    """SELECT product_id, 384::INTEGER AS dx, 16::INTEGER AS dy FROM products
       WHERE product_id IN (SELECT product_id FROM supported) AND product_id IN (FROM warm_products)""",
)


@query("bridge_fit")
def _(lake: Lake) -> DataFrame:
    train = _bridge_parts(lake)[3]
    return br.bridge_rmse(train, br.ridge_fit(train))


@query("bridge_fit_mlp")
def _(lake: Lake) -> DataFrame:
    train = _bridge_parts(lake)[3]
    return br.bridge_rmse(train, br.mlp_fit(train))


@query("bridge_predict")
def _(lake: Lake) -> DataFrame:
    _, items, embeddings, train = _bridge_parts(lake)
    cold = embeddings.join(skew.by_shuffle(items.select("product_id")), "product_id", "left_anti")
    return _tall(br.bridge_predict(cold, br.ridge_fit(train)), "product_id", "p")


@query("fuse_trained")
def _(lake: Lake) -> DataFrame:
    users, items, embeddings, train = _bridge_parts(lake)
    predicted = br.bridge_predict(embeddings, br.ridge_fit(train))
    rows = lake.interactions()
    products = skew.cut(fuse.fuse_products(lake.products(), items, predicted, rows, SUPPORT))
    fused = fuse.fuse_users(lake.users(), users, rows, products, SUPPORT)
    return fuse.fusion_summary(products, fused)


simple(
    "bridge_rmse",
    lambda k: br.rmse(
        k.product_vectors().select("product_id", "p").join(
            k.bridged_items().withColumnRenamed("p", "b"), "product_id"
        ),
        "p", "b",
    ),
    """SELECT round(sqrt(sum(power(x - y, 2)) / count(*)), 6) AS rmse, CAST(count(*) / 16 AS BIGINT) AS n
            FROM (SELECT unnest(p) AS x, unnest(b) AS y FROM pv WHERE p_size > 5)""",
)


def _fused(lake: Lake) -> tuple[DataFrame, DataFrame]:
    rows = lake.interactions()
    products = fuse.fuse_products(lake.products(), lake.factor_items(), lake.bridged_items(), rows, SUPPORT)
    return products, fuse.fuse_users(lake.users(), lake.factor_users(), rows, products, SUPPORT)


simple("fuse_products", lambda k: _tall(_fused(k)[0], "product_id", "p", "vector_source", "is_cold"), f"""
SELECT product_id, vector_source, is_cold, {_TALL.format('p')} FROM fused_products""")
simple("fuse_users", lambda k: _tall(_fused(k)[1], "user_id", "u", "vector_source", "is_cold", "segment"), f"""
SELECT user_id, segment, vector_source, is_cold, {_TALL.format('u')} FROM fused_users""")
simple("fusion_summary", lambda k: fuse.fusion_summary(*_fused(k)), """
SELECT *, round(n_warm * 100.0 / n_total, 6) AS pct_warm, round(n_cold * 100.0 / n_total, 6) AS pct_cold FROM (
  SELECT 'products' AS entity, count(*) FILTER (NOT is_cold) AS n_warm, count(*) FILTER (is_cold) AS n_cold, count(*) AS n_total FROM fused_products
  UNION ALL SELECT 'users', count(*) FILTER (NOT is_cold), count(*) FILTER (is_cold), count(*) FROM fused_users)""")
simple("batch_recommend", lambda k: serve.batch_recommend(k.user_vectors(), k.product_vectors()).drop("generated_at"), f"""
SELECT {_TOP} FROM scores QUALIFY rank <= 10""")


def _recommended(lake: Lake) -> DataFrame:
    cold = lake.gold_products().select("product_id", "is_cold")
    products = lake.product_vectors().join(cold, "product_id")
    popular = cold_start.popular_global(lake.interactions(), lake.products())
    seen = cold_start.seen_items(lake.interactions())
    return serve.recommend(lake.recommend_requests(), lake.user_vectors(), products, popular, seen)


simple("recommend", _recommended, """
SELECT request_id, user_id, product_id, category, score, CAST(rank AS INTEGER) AS rank, source, is_cold_user FROM recommended""")
simple(
    "rejected_requests",
    lambda k: serve.rejected_requests(k.recommend_requests().withColumn("n", F.col("n") * 5), serve.RECOMMEND_LIMITS)
    .select("request_id", "n", "reason"),
    "SELECT request_id, n * 5 AS n, 'n outside 1..100' AS reason FROM asks WHERE n * 5 > 100",
)
simple(
    "unknown_products",
    lambda k: serve.unknown_products(
        k.feedback().select("product_id"), k.products().filter("category <> 'PROMO'")
    ),
    """SELECT DISTINCT product_id FROM feedback
       WHERE product_id NOT IN (SELECT product_id FROM products WHERE category <> 'PROMO')""",
)
simple(
    "recommend_response",
    lambda k: serve.recommend_response(_recommended(k), k.users()).select(
        "request_id", "user_id", "segment",
        F.array_join(F.col("recommendations.product_id"), ",").alias("items"),
    ),
    """SELECT request_id, r.user_id, CASE WHEN is_cold_user THEN 'casual_user' ELSE coalesce(any_value(u.segment), 'regular_user') END AS segment,
              string_agg(product_id, ',' ORDER BY rank) AS items
       FROM recommended r LEFT JOIN users u ON u.user_id = r.user_id GROUP BY request_id, r.user_id, is_cold_user""",
)
simple(
    "recommend_cold",
    lambda k: serve_cold(k),
    """SELECT request_id, user_id, category, product_id, CAST(rank AS INTEGER) AS rank FROM (
         SELECT r.request_id, r.user_id, r.category, p.product_id, p.rank FROM asks r JOIN by_category p USING (category)
         UNION ALL
         SELECT r.request_id, r.user_id, r.category, p.product_id, p.rank FROM asks r, popular p
         WHERE r.category IS NULL AND p.rank <= 10)""",
)


def serve_cold(lake: Lake) -> DataFrame:
    rows = lake.interactions()
    return cold_start.recommend_cold(
        lake.recommend_requests().select("request_id", "user_id", "category"),
        cold_start.popularity_by_category(rows),
        cold_start.popular_global(rows, lake.products()),
    )


_UNIT = """SELECT {0} AS id, {1} AS category, [CAST(x / sqrt(list_dot_product(v, v)) AS FLOAT)::DOUBLE for x in v] AS v
FROM (SELECT *, CAST({2} AS DOUBLE[]) AS v FROM {3})"""


def _similar(unit: str, n: int) -> str:
    return f"""
SELECT product_id, similar_id, greatest(least(score, 1.0), 0.0) AS score, CAST(rank AS INTEGER) AS rank, category FROM (
  SELECT a.id AS product_id, b.id AS similar_id, b.category, round(list_dot_product(a.v, b.v), 6) + 0.0 AS score,
         row_number() OVER (PARTITION BY a.id ORDER BY round(list_dot_product(a.v, b.v), 6) DESC, b.id) AS rank
  FROM ({unit}) a JOIN ({unit}) b ON a.id <> b.id) WHERE rank <= {n}"""


simple("similar_items", lambda k: serve.similar_items(k.content_vectors(), 5),
       _similar(_UNIT.format("CAST(vec_id AS VARCHAR)", "CAST(label AS VARCHAR)", "embedding", "embeddings"), 5))
simple("similar_products", lambda k: serve.similar_items(k.product_vectors().drop("size"), 10),
       _similar(_UNIT.format("product_id", "category", "p", "pv"), 10))
simple("eval_sample", lambda k: evaluate.eval_sample(k.interactions()), "SELECT user_id FROM eval_drawn")


def _popularity_ndcg(lake: Lake) -> DataFrame:
    return evaluate.popularity_ndcg(evaluate.sampled_split(lake.interactions()))


simple("ndcg_at_k", _popularity_ndcg, "SELECT user_id, round(ndcg, 6) AS ndcg FROM ndcg")
simple("evaluate_popularity", lambda k: evaluate.evaluate_popularity(k.interactions()), """
SELECT round(avg(ndcg), 6) AS ndcg, count(*) AS n_users FROM ndcg""")
simple(
    "evaluate_popularity_unseen",
    lambda k: evaluate.evaluate_popularity(k.interactions(), exclude_seen_in_baseline=True),
    """SELECT round(avg(ndcg), 6) AS ndcg, count(*) AS n_users FROM (
         SELECT user_id, coalesce(sum(1 / log2(rank + 1)), 0.0)
           / list_sum([1 / log2(i + 1) for i in range(1, CAST(least(count(*), 10) AS BIGINT) + 1)]) AS ndcg
         FROM relevant r LEFT JOIN (SELECT user_id, product_id, rank FROM top10, (SELECT DISTINCT user_id FROM relevant)
           EXCEPT SELECT user_id, product_id, rank FROM split_sample JOIN top10 USING (product_id) WHERE split = 'train') t
         USING (user_id, product_id) GROUP BY user_id)""",
)
simple("evaluate_als", lambda k: evaluate.evaluate_als(k.interactions()))


@query("lift", """
SELECT user_id, round(ndcg, 6) AS ndcg, round(m, 6) AS mean_ndcg, round((ndcg - m) / m * 100, 4) AS lift_pct
FROM ndcg, (SELECT avg(ndcg) AS m FROM ndcg)""")
def _(lake: Lake) -> DataFrame:
    scores = _popularity_ndcg(lake)
    mean = scores.agg(F.avg("ndcg")).scalar()
    lifted = evaluate.lift(scores.withColumn("mean_ndcg", mean), "ndcg", "mean_ndcg")
    return lifted.withColumn("lift_pct", F.round("lift_pct", 4))


simple("grid_search", lambda k: evaluate.grid_search(k.interactions()))


@query("best_run", """
SELECT run_id, score, 'Production' AS model_stage FROM (
  SELECT 'user-' || user_id AS run_id, round(ndcg, 6) AS score FROM ndcg) ORDER BY score DESC, run_id LIMIT 1""")
def _(lake: Lake) -> DataFrame:
    runs = _popularity_ndcg(lake).select(
        F.concat(F.lit("user-"), "user_id").alias("run_id"),
        F.lit("metric").alias("kind"),
        F.lit("ndcg_at_10").alias("key"),
        F.round("ndcg", 6).cast("string").alias("value"),
    )
    return evaluate.best_run(runs)


# --- J: quality, drift, experiments, service metrics ---------------------------------------

_DQ = """SELECT '{0}' AS table_name, unnest([{1}]) AS check_name, unnest([{2}]) AS failed, total,
unnest([{2}]) = 0 AS success FROM (SELECT *, CASE WHEN total > 0 THEN 0 ELSE 1 END::BIGINT AS f_rows FROM ({3}))"""
_DQ_INTER = _DQ.format(
    "interactions", "'rating_between', 'user_id_not_null', 'product_id_not_null', 'row_count'", "a, b, c, f_rows",
    """SELECT count(*) AS total, count(*) FILTER (rating NOT BETWEEN 0 AND 5) AS a,
       count(*) FILTER (user_id IS NULL) AS b, count(*) FILTER (product_id IS NULL) AS c FROM interactions""",
)
_DQ_GOLD = _DQ.format(
    "gold_products", "'product_id_not_null', 'conversion_rate_between', 'row_count'", "a, b, f_rows",
    """SELECT count(*) AS total, count(*) FILTER (product_id IS NULL) AS a,
       count(*) FILTER (conversion_rate NOT BETWEEN 0 AND 1) AS b FROM gold""",
)
simple("dq_interactions", lambda k: quality.dq_interactions(k.interactions()), _DQ_INTER)
simple("dq_gold_products", lambda k: quality.dq_gold_products(k.gold_products()), _DQ_GOLD)
simple("dq_global_conversion", lambda k: quality.dq_global_conversion(k.gold_products()), """
SELECT round(avg(conversion_rate), 6) AS mean_conversion_rate, avg(conversion_rate) BETWEEN 0.17 AND 0.23 AS success FROM gold""")
simple(
    "dq_summary",
    lambda k: quality.dq_summary(quality.dq_interactions(k.interactions()), quality.dq_gold_products(k.gold_products())),
    f"""SELECT table_name, count(*) FILTER (success) AS passed, count(*) AS total
        FROM (({_DQ_INTER}) UNION ALL ({_DQ_GOLD})) GROUP BY 1""",
)
# Smirnov's exact law: of all lattice paths from (0, 0) to (n_a, n_b), those that leave the band. Column i of
# the band holds the number of paths inside it, divided by e ** grow a column to stay in range.
simple("drift_ks_exact", lambda k: drift.drift_ks(k.interactions(), method="auto"), f"""
SELECT month_a, month_b, n_a, n_b, round(conv_rate_a, 6) AS conv_rate_a, round(conv_rate_b, 6) AS conv_rate_b,
       round(ks_statistic, 6) AS ks_statistic, round(p, 6) AS p_value, p < 0.05 AS drift_detected FROM (
  WITH RECURSIVE pairs AS (
    SELECT *, ks_statistic - 1e-12 AS d, ln((n_a + n_b) / n_a) + n_b / n_a * ln((n_a + n_b) / n_b) AS grow FROM drift),
  walk AS (
    SELECT month_a, 0 AS i, j, 1.0::DOUBLE AS v FROM (SELECT *, unnest(range(n_b + 1)) AS j FROM pairs WHERE greatest(n_a, n_b) <= {EXACT_ROWS})
    WHERE j / n_b < d
    UNION ALL
    SELECT month_a, i, j, sum(v) OVER (PARTITION BY month_a ORDER BY j ROWS UNBOUNDED PRECEDING) / exp(grow) AS v FROM (
      SELECT w.month_a, w.i + 1 AS i, e.j, CASE WHEN e.j = w.j THEN w.v ELSE 0.0 END AS v, grow, d, n_a, n_b
      FROM (SELECT *, max(j) OVER (PARTITION BY month_a) AS top FROM walk) w JOIN pairs USING (month_a),
           LATERAL (SELECT unnest(CASE WHEN w.j = top THEN range(w.j, least(n_b + 1, ceil(n_b * ((w.i + 1) / n_a + d))::BIGINT + 2))
                                  ELSE [w.j] END) AS j) e WHERE w.i < n_a)
    WHERE abs(i / n_a - j / n_b) < d),
  inside AS (
    SELECT month_a, exp(ln(v) + n_a * grow - lgamma(n_a + n_b + 1) + lgamma(n_a + 1) + lgamma(n_b + 1)) AS share
    FROM walk JOIN pairs USING (month_a) WHERE i = n_a AND j = n_b)
  SELECT pairs.*, CASE WHEN greatest(n_a, n_b) > {EXACT_ROWS} THEN p_value ELSE greatest(0, least(1, 1 - coalesce(share, 0))) END AS p
  FROM pairs LEFT JOIN inside USING (month_a))""")
simple("drift_ks", lambda k: drift.drift_ks(k.interactions(), method="asymptotic"), """
SELECT month_a, month_b, n_a, n_b, round(conv_rate_a, 6) AS conv_rate_a, round(conv_rate_b, 6) AS conv_rate_b,
       round(ks_statistic, 6) AS ks_statistic, round(p_value, 6) AS p_value, p_value < 0.05 AS drift_detected FROM drift""")
simple("drift_ks_numeric", lambda k: drift.drift_ks_numeric(k.interactions(), "rating", method="asymptotic"), """
SELECT month_a, month_b, n_a, n_b, round(ks_statistic, 6) AS ks_statistic, round(p_value, 6) AS p_value,
       p_value < 0.05 AS drift_detected FROM drift_rating""")
simple("drift_summary", lambda k: drift.drift_summary(drift.drift_ks(k.interactions(), method="asymptotic")), """
SELECT count(*) AS n_pairs, count(*) FILTER (p_value < 0.05) AS n_drift FROM drift""")
simple("ab_variant", lambda k: abtest.ab_variant(k.customers()), """
SELECT 'U' || c_custkey AS user_id, CASE WHEN right(md5('U' || c_custkey), 1) IN ('0','2','4','6','8','a','c','e')
  THEN 'control' ELSE 'treatment' END AS ab_variant FROM customer""")
simple("ab_counts", lambda k: abtest.ab_counts(k.impressions(), k.feedback()), "SELECT * FROM ab")
simple("ab_counts_by_segment", lambda k: abtest.ab_counts_by_segment(k.impressions(), k.feedback(), k.users()), """
SELECT segment, ab_variant, CAST(sum(u) AS BIGINT) AS n_users, CAST(sum(i) AS BIGINT) AS n_impressions, CAST(sum(c) AS BIGINT) AS n_clicks FROM (
  SELECT coalesce(segment, 'casual_user') AS segment, ab_variant, count(DISTINCT user_id) AS u, count(*) AS i, 0 AS c
  FROM impressions LEFT JOIN users USING (user_id) GROUP BY ALL
  UNION ALL
  SELECT coalesce(segment, 'casual_user'), ab_variant, 0, 0, count(*) FROM feedback LEFT JOIN users USING (user_id)
  WHERE interaction_type IN ('click', 'purchase') GROUP BY ALL) GROUP BY ALL""")
simple("ab_results", lambda k: abtest.ab_results(abtest.ab_counts(k.impressions(), k.feedback()), START, TODAY), f"""
SELECT 'hybrid_vs_als_only' AS experiment_id, '{START}' AS start_date, 31::BIGINT AS n_days,
       round(rc, 4) AS control_ctr, round(rt, 4) AS treatment_ctr,
       round(CASE WHEN rc > 0 THEN (rt - rc) / rc * 100 ELSE 0.0 END, 2) AS lift_pct, round(p, 4) AS p_value,
       p < 0.05 AS significant, CAST(nc AS BIGINT) AS n_users_control, CAST(nt AS BIGINT) AS n_users_treatment,
       round(cc / ic, 4) AS control_ctr_per_impression, round(ct / it, 4) AS treatment_ctr_per_impression FROM ab_tested""")
simple(
    "ab_results_by_segment",
    lambda k: abtest.ab_results(
        abtest.ab_counts_by_segment(k.impressions(), k.feedback(), k.users()), START, TODAY, keys=("segment",)
    ).select("segment", "control_ctr", "treatment_ctr", "n_users_control", "n_users_treatment"),
    """SELECT segment, round(coalesce(cc / nullif(nc, 0), 0.0), 4) AS control_ctr,
              round(coalesce(ct / nullif(nt, 0), 0.0), 4) AS treatment_ctr, nc AS n_users_control, nt AS n_users_treatment FROM (
         SELECT segment, count(DISTINCT user_id) FILTER (shown AND ab_variant = 'control') AS nc,
                count(DISTINCT user_id) FILTER (shown AND ab_variant = 'treatment') AS nt,
                count(*) FILTER (NOT shown AND ab_variant = 'control') AS cc,
                count(*) FILTER (NOT shown AND ab_variant = 'treatment') AS ct FROM (
           SELECT coalesce(u.segment, 'casual_user') AS segment, e.* FROM (
             SELECT user_id, ab_variant, true AS shown FROM impressions
             UNION ALL SELECT user_id, ab_variant, false FROM feedback WHERE interaction_type IN ('click', 'purchase')) e
           LEFT JOIN users u USING (user_id)) GROUP BY 1)""",
)
_5M = "strftime(time_bucket(INTERVAL '5 minutes', ts), '%Y-%m-%d %H:%M:%S') AS window_start"
simple("latency_p95", lambda k: service.latency_p95(k.requests()), f"""
SELECT {_5M}, count(*) AS n_requests, round(quantile_cont(latency_ms, 0.95), 6) AS latency_p95 FROM requests GROUP BY 1""")
simple("cache_hit_rate", lambda k: service.cache_hit_rate(k.requests()), f"""
SELECT {_5M}, count(*) FILTER (cache_hit) AS hits, count(*) AS n_requests,
       round(count(*) FILTER (cache_hit) / count(*), 6) AS hit_rate FROM requests GROUP BY 1""")
simple("ctr_rate", lambda k: service.ctr_rate(k.requests(), k.feedback()), """
SELECT strftime(w, '%Y-%m-%d %H:%M:%S') AS window_start, coalesce(n_requests, 0) AS n_requests,
       coalesce(n_feedback, 0) AS n_feedback, round(coalesce(n_feedback, 0) / n_requests, 6) AS ctr
FROM (SELECT date_trunc('hour', ts) AS w, count(*) AS n_requests FROM requests GROUP BY 1)
FULL JOIN (SELECT date_trunc('hour', ts) AS w, count(*) AS n_feedback FROM feedback GROUP BY 1) USING (w)""")
simple("variant_mismatch", lambda k: abtest.variant_mismatch(k.feedback()), """
SELECT count(*) AS n_feedback, count(*) FILTER (ab_variant <> variant) AS n_mismatch,
       round(count(*) FILTER (ab_variant <> variant) / count(*), 6) AS mismatch_rate FROM feedback""")

# --- K: features specified by formula --------------------------------------------------------

simple("category_stats", lambda k: features.category_stats(k.interactions()), """
SELECT category, count(DISTINCT user_id) AS nb_users, count(DISTINCT product_id) AS nb_products,
       round(avg(rating), 6) AS avg_rating, round(avg(converted), 6) AS conversion_rate,
       round(count(user_id) / count(DISTINCT user_id), 6) AS avg_interactions_per_user FROM interactions GROUP BY 1""")
simple("category_month_stats", lambda k: features.category_month_stats(k.interactions()), """
SELECT category, year_month, count(*) AS nb_interactions, round(avg(converted), 6) AS conversion_rate,
       round(avg(rating), 6) AS avg_rating FROM interactions GROUP BY ALL""")
simple("product_lifespan", lambda k: features.product_lifespan(k.interactions()), "SELECT * FROM lifespan")
simple("user_diversity", lambda k: features.user_diversity(k.interactions()), """
SELECT user_id, count(*) AS nb_categories, arg_min(category, (-n, category)) AS main_category,
       round(greatest(-sum(n / t * log2(n / t)), 0.0), 6) + 0.0 AS diversity_index FROM (
  SELECT user_id, category, count(*) AS n, sum(count(*)) OVER (PARTITION BY user_id) AS t
  FROM interactions WHERE user_id IS NOT NULL GROUP BY user_id, category) GROUP BY 1""")
simple("review_quality", lambda k: features.review_quality(k.interactions()), """
SELECT product_id, round(avg(helpful_vote), 6) AS avg_helpful_votes, round(avg(converted) * 100, 6) AS pct_verified_purchases,
       round(count(*) FILTER (rating BETWEEN 4 AND 5)
         / nullif(count(*) FILTER (rating BETWEEN 4 AND 5 OR rating BETWEEN 1 AND 2), 0), 6) AS sentiment_ratio
FROM interactions WHERE product_id IS NOT NULL GROUP BY 1""")
simple("segment_category", lambda k: features.segment_category(k.interactions(), k.users()), """
SELECT segment, category, round(avg(rating), 6) AS avg_rating, round(avg(converted), 6) AS conversion_rate,
       count(*) AS nb_interactions FROM interactions JOIN users USING (user_id) GROUP BY ALL""")
_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
simple(
    "segment_category_matrix",
    lambda k: features.segment_category_matrix(k.interactions(), k.users(), _TYPES),
    "SELECT segment, "
    + ", ".join(f"round(avg(converted) FILTER (category = '{c}'), 6) AS {c}" for c in _TYPES)
    + " FROM interactions JOIN users USING (user_id) GROUP BY 1",
)
simple("user_cadence", lambda k: features.user_cadence(k.interactions(), "2002-01-01"), """
SELECT user_id, count(*) AS n_purchases, round(avg(gap), 6) AS avg_days_between,
       round(CASE WHEN avg(gap) > 0 THEN stddev_samp(gap) / avg(gap) END, 6) AS regularity_score,
       CAST(date_diff('day', max(d), DATE '2002-01-01') AS BIGINT) AS last_purchase_days_ago FROM (
  SELECT user_id, d, date_diff('day', lag(d) OVER (PARTITION BY user_id ORDER BY d), d) AS gap FROM (
    SELECT user_id, CAST(make_timestamp(timestamp * 1000) AS DATE) AS d FROM interactions
    WHERE interaction_type = 'purchase' AND user_id IS NOT NULL)) GROUP BY 1""")
simple("weighted_pair_counts", lambda k: features.weighted_pair_counts(k.interactions()), """
SELECT user_id, product_id, round(sum((CASE WHEN interaction_type = 'purchase' THEN 2.0 ELSE 1.0 END) * (1 + ln(1 + helpful_vote))), 6) AS weight
FROM interactions WHERE user_id IS NOT NULL AND product_id IS NOT NULL GROUP BY ALL""")
simple(
    "hybrid_score",
    lambda k: serve.hybrid_score(
        k.user_vectors(), k.product_vectors().select("product_id", "p"), k.bridged_items(), 0.25
    ),
    f"""SELECT {_TOP} FROM (SELECT user_id, product_id, round(list_dot_product(u, h), 6) + 0.0 AS score FROM uv, (
          SELECT product_id, CASE WHEN p_size > 5
            THEN [CAST(p[i] * 0.25::DOUBLE + b[i] * 0.75::DOUBLE AS FLOAT)::DOUBLE for i in range(1, 17)] ELSE p END AS h FROM pv))
        QUALIFY rank <= 10""",
)
simple(
    "diversify",
    lambda k: serve.diversify(k.user_vectors(), k.product_vectors()),
    """SELECT user_id, product_id, category, score,
              CAST(row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) AS INTEGER) AS rank FROM (
         SELECT *, row_number() OVER (PARTITION BY user_id, category ORDER BY score DESC, product_id) AS c FROM scores)
       WHERE c <= 2 QUALIFY rank <= 10""",
)
simple(
    "ndcg_by_segment",
    lambda k: evaluate.ndcg_by_segment(_popularity_ndcg(k), k.users()),
    "SELECT segment, round(avg(ndcg), 6) AS ndcg, count(*) AS n_users FROM ndcg JOIN users USING (user_id) GROUP BY 1",
)
simple(
    "precompute_top100",
    lambda k: serve.precompute_top(k.user_vectors(), k.product_vectors(), k.interactions(), "2001-06-01"),
    f"""SELECT {_TOP} FROM scores WHERE user_id IN (SELECT user_id FROM interactions
          WHERE make_timestamp(timestamp * 1000) BETWEEN TIMESTAMP '2001-05-02' AND TIMESTAMP '2001-06-01')
        QUALIFY rank <= 100""",
)
simple("feedback_to_interactions", lambda k: features.feedback_to_interactions(k.feedback(), k.products()), """
SELECT user_id, product_id, CAST(NULL AS DOUBLE) AS rating, epoch_us(ts) // 1000 AS timestamp,
       CASE WHEN interaction_type = 'purchase' THEN 'purchase' ELSE 'review' END AS interaction_type,
       CASE WHEN interaction_type = 'purchase' THEN 1 ELSE 0 END AS converted, strftime(ts, '%Y-%m') AS year_month,
       0::BIGINT AS helpful_vote, p.category
FROM feedback LEFT JOIN products p USING (product_id) WHERE interaction_type IN ('click', 'purchase')""")
simple(
    "declining_penalty",
    lambda k: features.declining_penalty(
        serve.batch_recommend(k.user_vectors(), k.product_vectors()).select("user_id", "product_id", "score"),
        features.product_lifespan(k.interactions()),
    ).withColumn("score", F.format_string("%.8f", "score")),  # half a six-digit score has seven
    """SELECT user_id, product_id, printf('%.8f', CASE WHEN trend = 'decreasing' THEN score * 0.5 ELSE score END) AS score FROM (
         SELECT user_id, product_id, score FROM scores QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, product_id) <= 10)
       LEFT JOIN lifespan USING (product_id)""",
)

# --- L: streams, run to the end of the tables ------------------------------------------------


def _finished(lake: Lake, running) -> None:
    running.awaitTermination()
    if running.exception() is not None:
        raise running.exception()


def _files(lake: Lake, result: DataFrame, name: str) -> DataFrame:
    path = lake.scratch(name)
    _finished(lake, logs.start_files(result, path, lake.scratch("stream")))
    return lake.spark.read.parquet(path)


def _state(lake: Lake, result: DataFrame, *keys: str) -> DataFrame:
    """The final rows of a running aggregate."""
    path = lake.scratch("updates")
    _finished(lake, logs.start_updates(result, path, lake.scratch("stream")))
    return logs.latest(lake.spark.read.parquet(path), *keys)


@query("stream_feedback", f"""
SELECT 'accepted' AS outcome, {_FB}, NULL AS reason FROM feedback
UNION ALL SELECT 'rejected', {_FB}, 'invalid interaction_type' FROM raw_feedback
WHERE interaction_type NOT IN ('click', 'purchase', 'skip')""")
def _(lake: Lake) -> DataFrame:
    ok, bad = lake.scratch("accepted"), lake.scratch("rejected")
    _finished(lake, logs.stream_feedback(lake.raw_feedback(True), ok, bad, lake.scratch("stream")))
    good = lake.spark.read.parquet(ok).withColumn("reason", F.lit(None).cast("string"))
    both = good.withColumn("outcome", F.lit("accepted")).unionByName(
        lake.spark.read.parquet(bad).withColumn("outcome", F.lit("rejected"))
    )
    return both.drop("batch_id")


simple("stream_impressions", lambda k: _files(k, logs.impressions_of(k.requests(True)), "impressions"), """
SELECT user_id, ab_variant, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM impressions""")


@query("stream_ab_counts", "SELECT ab_variant, n_users, n_clicks FROM ab")
def _(lake: Lake) -> DataFrame:
    shown = logs.ab_users(logs.impressions_of(lake.requests(True)))
    accepted = lake.raw_feedback(True).filter(abtest.rejection_reason().isNull())
    users = _state(lake, shown, "ab_variant")
    return users.join(_state(lake, logs.ab_clicks(accepted), "ab_variant"), "ab_variant")


def _partials(lake: Lake, stream: DataFrame, partial) -> DataFrame:
    path = lake.scratch("partials")
    _finished(lake, partials.start_partials(stream, partial, path, lake.scratch("stream")))
    return lake.spark.read.parquet(path)


simple(
    "stream_service_metrics",
    lambda k: partials.merge_latency(_partials(k, k.requests(True), partials.latency)),
    f"""SELECT {_5M}, count(*) AS n_requests, count(*) FILTER (cache_hit) AS hits,
               round(quantile_cont(latency_ms, 0.95), 6) AS latency_p95 FROM requests GROUP BY 1""",
)


@query("stream_ctr_rate", """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
       count(*) FILTER (event_type = 'view') AS n_requests, count(*) FILTER (event_type <> 'view') AS n_feedback,
       round(count(*) FILTER (event_type <> 'view') / nullif(count(*) FILTER (event_type = 'view'), 0), 6) AS ctr
FROM ev WHERE event_type <> 'signup' GROUP BY 1""")
def _(lake: Lake) -> DataFrame:
    events = lake.events(True).filter("event_type <> 'signup'")
    posts = events.select(F.col("ts").cast("timestamp").alias("ts"), (F.col("event_type") == "view").alias("is_request"))
    return partials.merge_clicks(_partials(lake, posts, partials.clicks))


def _timed_interactions(lake: Lake) -> DataFrame:
    rows = bronze.bronze_interactions(lake.reviews(stream=True))
    return silver.drop_null_keys(rows).withColumn("ts", S.event_time(F.col("timestamp")))


simple(
    "stream_dedup",
    lambda k: partials.dedup(
        _partials(k, _timed_interactions(k).drop("ts"), partials.dedup).drop("batch_id")
    ).select("user_id", "product_id", "timestamp"),
    "SELECT user_id, product_id, timestamp FROM dedup",
)
simple(
    "stream_popularity",
    lambda k: partials.merge_popularity(
        _partials(k, _timed_interactions(k), lambda rows: partials.popularity(rows, "30 days"))
    ),
    """SELECT strftime(time_bucket(INTERVAL '30 days', make_timestamp(timestamp * 1000), TIMESTAMP '1970-01-01'), '%Y-%m-%d %H:%M:%S') AS window_start,
              category, product_id, count(*) AS nb_interactions FROM interactions
       WHERE user_id IS NOT NULL AND product_id IS NOT NULL GROUP BY ALL""",
)


@query("ingest_files", f"SELECT {_INTER} FROM interactions")
def _(lake: Lake) -> DataFrame:
    """Two deliveries; the first run dies before its commit, the second finds both, the third nothing new."""
    source, table = lake.scratch("deliveries"), lake.scratch("table")
    rows = lake.interactions().withColumn("part", F.pmod(F.xxhash64("user_id", "product_id", "timestamp"), F.lit(2)))
    rows.where("part = 0").drop("part").write.parquet(f"{source}/one")

    def die() -> None:
        raise RuntimeError("killed")

    try:
        ingest.ingest(lake.spark, source, table, before_commit=die)
    except RuntimeError:
        pass
    rows.where("part = 1").drop("part").write.parquet(f"{source}/two")
    for _ in range(2):
        ingest.ingest(lake.spark, source, table)
    return ingest.read_committed(lake.spark, table)


@query("user_profile_incremental", """
SELECT user_id, total_interactions, total_purchases, round(avg_rating, 6) AS avg_rating,
       round(avg_rating_weighted, 6) AS avg_rating_weighted FROM merged""")
def _(lake: Lake) -> DataFrame:
    """Three batches of interactions, one of them delivered again, old ones compacted."""
    path, source = lake.scratch("profiles"), lake.scratch("interactions")
    dealt = F.pmod(F.xxhash64("user_id", "product_id", "timestamp"), F.lit(10)).alias("part")
    # Written once with what profiles need; every delivery reads its share of it.
    lake.interactions().select("user_id", "product_id", "rating", "converted", "category", dealt).write.parquet(source)
    rows, part = lake.spark.read.parquet(source), F.col("part")
    for batch, share in ((1, part < 6), (2, part.between(6, 8)), (2, part.between(6, 8)), (3, part == 9)):
        incremental.add_batch(rows.where(share), path, batch)
        if batch == 1:
            incremental.compact(lake.spark, path)
    return incremental.profiles(lake.spark, path)


# Estimates at three levels, all from the sketches per month and category, against exact counts.


@query("distinct_users_rollup", """
SELECT 'month and category' AS level, year_month, category, count(DISTINCT user_id) AS n_exact, true AS within_bound
FROM interactions WHERE user_id IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'category', NULL, category, count(DISTINCT user_id), true FROM interactions WHERE user_id IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'all', NULL, NULL, count(DISTINCT user_id), true FROM interactions""")
def _(lake: Lake) -> DataFrame:
    rows = lake.interactions().select("user_id", "year_month", "category")
    sketches = skew.cut(incremental.user_sketches(rows))
    out = None
    for level, keys in (("month and category", ["year_month", "category"]), ("category", ["category"]), ("all", [])):
        exact = rows.distinct().where("user_id is not null").groupBy(*keys).agg(F.countDistinct("user_id").alias("n_exact"))
        about = incremental.distinct_users_at(sketches, *keys)
        both = exact.join(about, keys) if keys else exact.crossJoin(F.broadcast(about))  # one row each
        error = F.greatest(F.lit(1.0), 4 * incremental.estimate_error() * F.col("n_exact"))
        part = both.select(
            F.lit(level).alias("level"), *[(F.col(c) if c in keys else F.lit(None).cast("string")).alias(c) for c in ("year_month", "category")],
            "n_exact", (F.abs(F.col("n_users") - F.col("n_exact")) <= error).alias("within_bound"),
        )
        out = part if out is None else out.unionByName(part)
    return out


# Streams under a watermark. Events come in six batches, five days each; every tenth comes one to three
# batches late. A batch is judged by the newest time of the batches before it; the engine's own late
# filter takes the watermark of one batch earlier, so that chained operators agree.
_ARRIVAL = """CAST(least(5, (day(ts) - 1) {0} 5 + CASE WHEN event_id % 10 = 3 THEN 1 + event_id % 3 ELSE 0 END) AS INT)"""
_ARRIVED = f"""
WITH a AS (SELECT *, {_ARRIVAL.format('//')} AS arrival FROM events WHERE {{0}}),
m AS (SELECT arrival, max(epoch_ms(ts)) AS top FROM a GROUP BY 1),
w AS (SELECT x.arrival, (SELECT max(top) FROM m y WHERE y.arrival < x.arrival - {{1}}) - 86400000 AS mark FROM m x),
t AS (SELECT a.*, mark FROM a JOIN w USING (arrival))"""


def _arriving(lake: Lake, rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("arrival", F.expr(_ARRIVAL.format("div")))
    return lake.arrivals(rows, F.col("arrival"))


@query("stream_late_rows", _ARRIVED.format("true", 0) + """
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, arrival, late, count(*) FILTER (late) OVER () AS n_late,
       count(*) FILTER (NOT late) OVER () AS n_on_time
FROM (SELECT *, coalesce(epoch_us(ts) < mark * 1000, false) AS late FROM t)""")
def _(lake: Lake) -> DataFrame:
    path = lake.scratch("split")
    stream = _arriving(lake, lake.table("events").select("event_id", "ts"))
    _finished(lake, stateful.start_split(stateful.split_late(stream, "1 day"), path, lake.scratch("stream")))
    split = stateful.read_split(lake.spark, path)
    counts = stateful.late_counts(split)
    # One row of counts, from the state.
    return split.select("event_id", "ts", "arrival", "late").crossJoin(F.broadcast(counts))


@query("stream_latency_sketch", _ARRIVED.format("event_type = 'view'", 1) + f"""
, r AS (SELECT date_trunc('day', ts) AS d, value, CAST(json_extract(props, '$.k') AS BIGINT) % 2 = 0 AS hit FROM t
        WHERE coalesce(epoch_ms(date_trunc('day', ts)) + 86400000 > mark, true))
SELECT strftime(d, '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS n_requests, count(*) FILTER (hit) AS hits,
       round(CASE WHEN count(value) <= {stateful.SKETCH} THEN quantile_disc(value, 0.95) END, 6) AS exact_p95, true AS within_bound
FROM r GROUP BY d""")
def _(lake: Lake) -> DataFrame:
    path, log = lake.scratch("sketches"), lake.scratch("log")
    views = lake.events().filter("event_type = 'view'").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("latency_ms"), (F.col("k") % 2 == 0).alias("cache_hit")
    )
    stream = _arriving(lake, views)
    _finished(lake, stateful.start_sketches(stateful.latency_sketches(stream, "1 day", "1 day"), path, lake.scratch("stream")))
    found = logs.latest(lake.spark.read.parquet(path), "window_start").withColumn("p95", stateful.sketch_quantile())
    # Ranks of the sketch's value among the rows that the windows have taken in.
    kept = _arriving_rows(views).where(F.coalesce(F.expr("window_start + interval 1 day > timestamp_millis(mark)"), F.lit(True)))
    ranks = kept.join(found.select("window_start", "p95"), "window_start").groupBy("window_start").agg(
        F.avg((F.col("latency_ms") < F.col("p95")).cast("double")).alias("low"),
        F.avg((F.col("latency_ms") <= F.col("p95")).cast("double")).alias("high"),
    )
    error = 2 * stateful.rank_error()
    within = (F.col("low") - error <= 0.95) & (F.col("high") + error >= 0.95)
    return found.join(ranks, "window_start").select(
        "window_start", "n_requests", "hits",
        F.when(F.col("n_timed") <= stateful.SKETCH, F.col("p95")).alias("exact_p95"), within.alias("within_bound"),
    )


def _arriving_rows(rows: DataFrame) -> DataFrame:
    """The same arrivals as a table, with the watermark (``mark``) that met each row and its day."""
    rows = rows.withColumn("arrival", F.expr(_ARRIVAL.format("div")))
    tops = rows.groupBy("arrival").agg(F.max(F.unix_millis("ts")).alias("top"))  # a row per batch
    earlier = tops.alias("x").join(tops.alias("y"), F.expr("y.arrival < x.arrival - 1"), "left").groupBy("x.arrival").agg(
        (F.max("y.top") - 86400000).alias("mark")
    )
    return rows.join(F.broadcast(earlier), "arrival").withColumn("window_start", F.window("ts", "1 day")["start"])


@query("stream_dedup_state", """
SELECT DISTINCT user_id, product_id, timestamp FROM interactions WHERE user_id IS NOT NULL AND product_id IS NOT NULL""")
def _(lake: Lake) -> DataFrame:
    path = lake.scratch("unique")
    rows = silver.drop_null_keys(lake.interactions()).select("user_id", "product_id", "timestamp", "rating").withColumn(
        "ts", S.event_time(F.col("timestamp"))
    )
    # By ship date, a year a batch; an eighth comes one batch later. So nothing is 1000 days late.
    late = F.when(F.pmod(F.xxhash64("user_id", "product_id", "timestamp", "rating"), F.lit(8)) == 0, 1).otherwise(0)
    batch = F.least(F.lit(6), F.floor(F.datediff("ts", F.lit("1995-01-01")) / 365) + late)
    stream = lake.arrivals(rows, batch, 7)
    _finished(lake, stateful.start_dedup(stateful.dedup_state(stream, "1000 days"), path, lake.scratch("stream")))
    return lake.spark.read.parquet(path).select("user_id", "product_id", "timestamp")


@query("experiment_log", """
SELECT 'ndcg-' || CAST(n_users AS VARCHAR) AS run_id, 'metric' AS kind, 'ndcg_at_10' AS key,
       round(ndcg, 6) AS value FROM (SELECT avg(ndcg) AS ndcg, count(*) AS n_users FROM ndcg)""")
def _(lake: Lake) -> DataFrame:
    path = lake.scratch("runs")
    score = evaluate.evaluate_popularity(lake.interactions()).first()
    writers.append_run(lake.spark, path, f"ndcg-{score.n_users}", {}, {"ndcg_at_10": score.ndcg})
    return writers.read_runs(lake.spark, path).withColumn("value", F.col("value").cast("double"))

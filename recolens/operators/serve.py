"""Recommendations, similar items and fallbacks for sets of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from recolens.functions import scalars as S
from recolens.functions.vectors import blend, l2_normalize
from recolens.operators.bounded import Bounded, top_items_bounded
from recolens.operators.scoring import top_items
from recolens.operators.skew import cut

RECOMMEND_LIMITS = (1, 100)
SIMILAR_LIMITS = (1, 50)


def _queries(users: DataFrame) -> DataFrame:
    return users.select(F.col("user_id").alias("query_id"), F.col("u").alias("vec"))


def _items(products: DataFrame) -> DataFrame:
    return products.select(
        "product_id", *[c for c in ("category", "is_cold") if c in products.columns],
        F.col("p").alias("vec"),
    )


def batch_recommend(
    users: DataFrame, products: DataFrame, k: int = 10, generated_at: str | None = None, **blocks
) -> DataFrame:
    """Top-k by raw inner product for every user, nothing excluded."""
    recs = top_items(_queries(users), _items(products), k, **blocks).select(
        F.col("query_id").alias("user_id"), "product_id", "score", "rank"
    )
    stamp = F.current_timestamp() if generated_at is None else F.lit(generated_at).cast("timestamp")
    return recs.withColumn("generated_at", stamp)


def batch_recommend_bounded(users: DataFrame, products: DataFrame, k: int = 10, **blocks) -> Bounded:
    """:func:`batch_recommend` without the product blocks whose norms can't reach a user's list."""
    found = top_items_bounded(_queries(users), _items(products), k, **blocks)
    rows = found.rows.select(F.col("query_id").alias("user_id"), "product_id", "score", "rank")
    return Bounded(rows, found.work)


def recs_summary(recs: DataFrame) -> DataFrame:
    return recs.agg(
        F.count(F.lit(1)).alias("n_recommendations"), F.avg("score").alias("avg_score")
    )


def score_matrix(users: DataFrame, products: DataFrame, **blocks) -> DataFrame:
    """Every user scored against every product, summarised per user.

    The matrix itself exists only block by block inside the tasks: one row per user leaves
    with the number of scores, their range and sum, and the best product.
    """
    best = top_items(_queries(users), _items(products), 1, with_range=True, **blocks)
    return best.select(
        F.col("query_id").alias("user_id"),
        F.col("candidates").alias("n_scores"),
        F.col("low").alias("min_score"),
        F.col("high").alias("max_score"),
        F.col("total").alias("total_score"),
        F.col("product_id").alias("best_product"),
    )


def valid_requests(requests: DataFrame, limits: tuple[int, int]) -> DataFrame:
    """Requests whose n is within the service's bounds."""
    return requests.filter(F.col("n").between(*limits))


def rejected_requests(requests: DataFrame, limits: tuple[int, int]) -> DataFrame:
    """The other requests, with the reason why they get no answer."""
    inside = F.coalesce(F.col("n").between(*limits), F.lit(False))
    return requests.filter(~inside).withColumn("reason", F.lit(f"n outside {limits[0]}..{limits[1]}"))


def unknown_products(wanted: DataFrame, products: DataFrame) -> DataFrame:
    """Wanted ids the catalogue doesn't have; :func:`similar_items` has no rows for them."""
    asked = wanted.filter(F.col("product_id").isNotNull()).select("product_id").distinct()
    return asked.join(products.select("product_id"), "product_id", "left_anti")


def recommend(
    requests: DataFrame,
    users: DataFrame,
    products: DataFrame,
    popular: DataFrame,
    seen: DataFrame,
    **blocks,
) -> DataFrame:
    """Personal recommendations for requests (request_id, user_id, n, category, exclude_seen).

    Users with a vector: candidates are filtered by category and by what they have seen,
    scored, min-max scaled over all their candidates, and the best n kept. Other users: the
    popular list under the same filters, scored by place. No candidates, no rows.
    """
    asked = valid_requests(requests, RECOMMEND_LIMITS)
    vectors = users.select("user_id", "u")
    known = asked.join(vectors, "user_id")
    unknown = asked.join(vectors.select("user_id"), "user_id", "left_anti")
    # Written once: it is counted, dealt into blocks, and taken out of the fallback.
    hidden = cut(
        asked.filter("exclude_seen")
        .select("request_id", "user_id")
        .join(seen.select("user_id", "product_id"), "user_id")
        .select("request_id", "product_id")
        .distinct()
    )
    scored = top_items(
        known.select(F.col("request_id").alias("query_id"), "n", "category", F.col("u").alias("vec")),
        _items(products),
        RECOMMEND_LIMITS[1],
        masked=hidden.select(F.col("request_id").alias("query_id"), "product_id"),
        with_range="ends",
        **blocks,
    )
    personal = scored.select(
        F.col("query_id").alias("request_id"),
        "product_id",
        F.coalesce("category", F.lit("")).alias("category"),
        F.round(S.minmax(F.col("score"), F.col("low"), F.col("high")), 6).alias("score"),
        "rank",
        S.source_label(F.col("is_cold")).alias("source"),
        F.lit(False).alias("is_cold_user"),
    ).join(known.select("request_id", "user_id"), "request_id")
    return personal.unionByName(_fallback(unknown, popular, hidden).select(personal.columns))


def _fallback(requests: DataFrame, popular: DataFrame, hidden: DataFrame) -> DataFrame:
    """Popular products per request. ``popular`` has at most 500 rows by construction, and
    every one is listed once for its category and once for requests without one."""
    listed = popular.select("product_id", "category", "rank")
    scoped = listed.withColumn("scope", F.lit("*")).unionByName(
        listed.withColumn("scope", F.concat(F.lit("="), "category"))
    )
    asked = requests.select(
        "request_id",
        "user_id",
        "n",
        F.coalesce(F.concat(F.lit("="), "category"), F.lit("*")).alias("scope"),
    )
    candidates = (
        asked.join(F.broadcast(scoped), "scope")
        .join(hidden.select("request_id", "product_id"), ["request_id", "product_id"], "left_anti")
        .drop("scope")
    )
    by_place = Window.partitionBy("request_id").orderBy("rank")
    kept = candidates.withColumn("place", F.row_number().over(by_place)).filter(
        F.col("place") <= F.col("n")
    )
    listed_n = F.count(F.lit(1)).over(Window.partitionBy("request_id"))
    return kept.select(
        "request_id",
        "user_id",
        "product_id",
        "category",
        popular_rank_score(F.col("place"), listed_n).alias("score"),
        F.col("place").alias("rank"),
        F.lit("popular").alias("source"),
        F.lit(True).alias("is_cold_user"),
    )


def popular_rank_score(place, size):
    """1 for the first of a list, falling evenly by place."""
    return F.round(1.0 - (place - 1) / F.greatest(size, F.lit(1)), 4)


def recommend_response(recs: DataFrame, users: DataFrame) -> DataFrame:
    """One row per request: segment and the ranked items (at most 100 by the bounds)."""
    item = F.struct("rank", "product_id", "score", "source", "category")
    nested = recs.groupBy("request_id", "user_id", "is_cold_user").agg(
        F.sort_array(F.collect_list(item)).alias("recommendations")
    )
    segments = users.select("user_id", "segment")
    return nested.join(segments, "user_id", "left").select(
        "request_id",
        "user_id",
        F.when(F.col("is_cold_user"), S.CASUAL)
        .otherwise(F.coalesce("segment", F.lit(S.REGULAR)))
        .alias("segment"),
        "recommendations",
    )


def similar_items(
    products: DataFrame, n: int = 5, wanted: DataFrame | None = None, **blocks
) -> DataFrame:
    """Cosine nearest products of every product (or of the ``wanted`` ids) but itself.

    Vectors are normalised once; zero vectors score 0. Unknown ids have no rows.
    """
    if not SIMILAR_LIMITS[0] <= n <= SIMILAR_LIMITS[1]:
        raise ValueError(f"n must be within {SIMILAR_LIMITS}")
    unit = products.withColumn("p", l2_normalize(F.col("p")).cast("array<float>"))
    asked = unit if wanted is None else unit.join(wanted.select("product_id"), "product_id", "left_semi")
    best = top_items(
        asked.select(F.col("product_id").alias("query_id"), F.col("p").alias("vec")),
        _items(unit),
        n,
        exclude_self=True,
        **blocks,
    )
    return best.select(
        F.col("query_id").alias("product_id"),
        F.col("product_id").alias("similar_id"),
        S.clip01(F.col("score")).alias("score"),
        "rank",
        "category",
    )


def hybrid_products(als_items: DataFrame, bridged: DataFrame, alpha: float = 0.5) -> DataFrame:
    """Product vectors alpha * factors + (1 - alpha) * bridge; the one that exists otherwise.

    The inner product is linear, so blending vectors blends the scores.
    """
    a = als_items.select("product_id", F.col("p").alias("__als"))
    b = bridged.select("product_id", F.col("p").alias("__bridge"))
    both = blend(F.col("__als"), F.col("__bridge"), alpha)
    return a.join(b, "product_id", "full").select(
        "product_id", F.coalesce(both, "__als", "__bridge").alias("p")
    )


def hybrid_score(
    users: DataFrame, als_items: DataFrame, bridged: DataFrame, alpha: float = 0.5, k: int = 10
) -> DataFrame:
    recs = batch_recommend(users, hybrid_products(als_items, bridged, alpha), k)
    return recs.drop("generated_at")


def diversify(
    users: DataFrame, products: DataFrame, max_per_category: int = 2, n: int = 10, **blocks
) -> DataFrame:
    """Best n products of every user with at most ``max_per_category`` of one category.

    Exact: the scorer keeps the best of each category, so no prefix of a list decides. Products
    without a category count as one category.
    """
    recs = top_items(_queries(users), _items(products), n, per_category=max_per_category, **blocks)
    return recs.select(F.col("query_id").alias("user_id"), "product_id", "category", "score", "rank")


def precompute_top(
    users: DataFrame,
    products: DataFrame,
    interactions: DataFrame,
    today: str,
    days: int = 30,
    k: int = 100,
    **blocks,
) -> DataFrame:
    """Top-k lists for the users active in the last ``days`` days."""
    since = F.unix_millis(F.lit(today).cast("timestamp") - F.expr(f"INTERVAL {days} DAYS"))
    until = F.unix_millis(F.lit(today).cast("timestamp"))
    recent = interactions.filter((F.col("timestamp") >= since) & (F.col("timestamp") <= until))
    active = users.join(recent.select("user_id").distinct(), "user_id", "left_semi")
    return batch_recommend(active, products, k, **blocks).drop("generated_at")

"""Exploratory statistics. Totals over groups are windows on already aggregated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from recolens.functions import scalars as S

LONG_TAIL_THRESHOLDS = (1, 5, 10, 20, 50)
TOP_CATEGORIES = 15


def _rows() -> Column:
    return F.count(F.lit(1))


def _share(n: str, digits: int) -> Column:
    """Percentage of ``n`` in its total; used only on one row per group of a closed set."""
    return F.round(F.col(n) / F.sum(n).over(Window.partitionBy()) * 100, digits)


def active_users(users: DataFrame, interactions: DataFrame) -> DataFrame:
    """Users that have interactions."""
    seen = interactions.select("user_id").distinct()
    return users.join(seen, "user_id")


def sparsity(interactions: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    """Share of unobserved user-item pairs, by rows and by distinct pairs."""
    pairs = (
        interactions.filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
        .select("user_id", "product_id")
        .distinct()
        .agg(_rows())
    )
    counted = interactions.agg(_rows().alias("n_interactions")).select(
        "n_interactions",
        pairs.scalar().alias("n_pairs"),
        users.agg(_rows()).scalar().alias("n_users"),
        products.agg(_rows()).scalar().alias("n_products"),
    )
    cells = F.col("n_users").cast("double") * F.col("n_products")
    return counted.withColumn(
        "sparsity_pct", (1 - F.try_divide(F.col("n_interactions"), cells)) * 100
    ).withColumn("sparsity_distinct_pct", (1 - F.try_divide(F.col("n_pairs"), cells)) * 100)


def interaction_type_share(interactions: DataFrame) -> DataFrame:
    return (
        interactions.groupBy("interaction_type")
        .agg(
            _rows().alias("nb"),
            F.round(_rows() / 1e6, 2).alias("millions"),
            F.round(F.avg("converted"), 3).alias("conv_rate"),
        )
        .withColumn("pct", _share("nb", 1))
        .orderBy(F.col("nb").desc(), F.col("interaction_type").asc_nulls_last())
    )


def helpful_stats(interactions: DataFrame) -> DataFrame:
    return interactions.agg(
        F.count_if(F.col("helpful_vote") > 0).alias("with_helpful_vote"),
        F.round(F.avg("helpful_vote"), 2).alias("helpful_mean"),
        F.max("helpful_vote").alias("helpful_max"),
    )


def rated_only(interactions: DataFrame) -> DataFrame:
    return interactions.filter(F.col("rating") > 0)


def rating_distribution(interactions: DataFrame, digits: int = 1) -> DataFrame:
    return (
        rated_only(interactions)
        .groupBy("rating")
        .agg(_rows().alias("nb"))
        .withColumn("pct", _share("nb", digits))
        .orderBy("rating")
    )


def rating_stats(interactions: DataFrame) -> DataFrame:
    return rated_only(interactions).agg(
        F.round(F.avg("rating"), 3).alias("mean_rating"),
        F.round(F.stddev("rating"), 3).alias("stddev_rating"),
        F.min("rating").alias("min_rating"),
        F.max("rating").alias("max_rating"),
    )


def category_share(interactions: DataFrame, top: int | None = None) -> DataFrame:
    """Rows and share per category, largest first; shares are of the rows kept by ``top``."""
    counts = interactions.groupBy("category").agg(_rows().alias("nb_interactions"))
    order = (F.col("nb_interactions").desc(), F.col("category").asc_nulls_last())
    if top is not None:
        counts = counts.orderBy(*order).limit(top)
    return counts.withColumn("pct", _share("nb_interactions", 1)).orderBy(*order)


def long_tail(
    interactions: DataFrame,
    id_col: str,
    catalogue: DataFrame,
    thresholds: Sequence[int] = LONG_TAIL_THRESHOLDS,
) -> DataFrame:
    """Entities with at most s rows for each s, and their share of the catalogue; one pass."""
    counts = (
        interactions.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(_rows().alias("n"))
    )
    wide = counts.agg(*[F.count_if(F.col("n") <= s).alias(f"le_{s}") for s in thresholds])
    tall = wide.select(
        F.expr(
            f"stack({len(thresholds)}, "
            + ", ".join(f"{s}, le_{s}" for s in thresholds)
            + ") AS (threshold, n_rare)"
        )
    )
    total = catalogue.agg(_rows()).scalar()
    return tall.withColumn("pct", F.round(F.try_divide(F.col("n_rare") * 100.0, total), 4))


def segment_stats(users: DataFrame) -> DataFrame:
    return (
        users.groupBy("segment")
        .agg(
            _rows().alias("nb_users"),
            F.round(F.avg("total_purchases"), 1).alias("mean_purchases"),
            F.round(F.avg("avg_rating"), 2).alias("mean_rating"),
            F.sum("total_purchases").alias("total_purchases"),
        )
        .withColumn("pct_users", _share("nb_users", 1))
        .orderBy(F.col("nb_users").desc(), "segment")
    )


def purchases_by_segment(interactions: DataFrame, users: DataFrame) -> DataFrame:
    """Purchases per user segment; counted per user before the join."""
    per_user = (
        interactions.filter(F.col("interaction_type") == S.PURCHASE)
        .groupBy("user_id")
        .agg(_rows().alias("n"))
    )
    return (
        per_user.join(users.select("user_id", "segment"), "user_id", "left")
        .groupBy("segment")
        .agg(F.sum("n").alias("purchases"))
        .withColumn("pct_purchases", _share("purchases", 1))
        .orderBy(F.col("purchases").desc(), F.col("segment").asc_nulls_last())
    )


def monthly_volume(interactions: DataFrame) -> DataFrame:
    return (
        interactions.filter(S.valid_month(F.col("year_month")))
        .groupBy("year_month")
        .agg(_rows().alias("nb"))
        .orderBy("year_month")
    )


def distinct_months(interactions: DataFrame) -> DataFrame:
    return interactions.filter(S.valid_month(F.col("year_month"))).select("year_month").distinct()


def median_month(interactions: DataFrame) -> DataFrame:
    """The middle of the distinct months in order (the later one of an even number)."""
    w = Window.orderBy("year_month")
    ranked = distinct_months(interactions).select(
        "year_month",
        F.row_number().over(w).alias("rn"),
        F.count(F.lit(1)).over(Window.partitionBy()).alias("n"),
    )
    return ranked.filter(F.col("rn") == F.floor(F.col("n") / 2) + 1).select("year_month")


def embedding_means(products: DataFrame, vector: str = "p", dims: int = 4) -> DataFrame:
    return (
        products.groupBy("category")
        .agg(
            *[
                F.round(F.avg(F.col(vector)[i].cast("double")), 4).alias(f"P{i + 1}")
                for i in range(dims)
            ]
        )
        .orderBy("category")
    )


def eda_recap(
    interactions: DataFrame,
    users: DataFrame,
    products: DataFrame,
    min_interactions: int = S.MIN_INTERACTIONS,
) -> DataFrame:
    """The five headline numbers in one row."""
    n_products = products.agg(_rows()).scalar()
    n_users = users.agg(_rows()).scalar()
    rare = (
        interactions.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(_rows().alias("n"))
        .agg(F.count_if(F.col("n") < min_interactions))
        .scalar()
    )
    power = users.agg(F.count_if(F.col("segment") == S.POWER)).scalar()
    base = interactions.agg(
        _rows().alias("n"),
        F.count_if(F.col("interaction_type") == S.REVIEW).alias("reviews"),
        F.count_if(F.col("rating") == 5).alias("five"),
        F.count_if(F.col("rating") > 0).alias("rated"),
    )
    return base.select(
        F.round((1 - F.col("n") / (n_users.cast("double") * n_products)) * 100, 4).alias(
            "sparsity_pct"
        ),
        F.round(F.col("reviews") * 100.0 / F.col("n"), 1).alias("review_pct"),
        F.round(F.try_divide(F.col("five") * 100.0, F.col("rated")), 1).alias("five_star_pct"),
        F.round(F.try_divide(rare * 100.0, n_products), 4).alias("rare_product_pct"),
        F.round(F.try_divide(power * 100.0, n_users), 1).alias("power_user_pct"),
    )


def catalog_counts(products: DataFrame, users: DataFrame, popular: DataFrame) -> DataFrame:
    """What the service reports as loaded."""
    return products.agg(_rows().alias("products")).select(
        "products",
        users.agg(_rows()).scalar().alias("users"),
        popular.agg(_rows()).scalar().alias("popular_products"),
    )

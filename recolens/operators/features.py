"""Aggregated features of categories, products and users."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from recolens.functions import scalars as S

TREND_MARGIN = 0.10
DECLINE_FACTOR = 0.5


def _rows():
    return F.count(F.lit(1))


def category_stats(interactions: DataFrame) -> DataFrame:
    """Users, products, rating, conversion and rows per user of each category.

    Both distinct counts are taken from one (category, user) and one (category, product)
    aggregation, so no category's ids meet in a single task and no row is expanded.
    """
    users = (
        interactions.filter(F.col("user_id").isNotNull())
        .groupBy("category", "user_id")
        .agg(_rows().alias("n"))
        .groupBy("category")
        .agg(_rows().alias("nb_users"), F.sum("n").alias("user_rows"))
    )
    products = (
        interactions.groupBy("category", "product_id")
        .agg(
            F.sum("rating").alias("r"),
            F.count("rating").alias("rn"),
            F.sum("converted").alias("c"),
            _rows().alias("n"),
        )
        .groupBy("category")
        .agg(
            F.count("product_id").alias("nb_products"),
            F.try_divide(F.sum("r"), F.sum("rn")).alias("avg_rating"),
            F.try_divide(F.sum("c").cast("double"), F.sum("n")).alias("conversion_rate"),
        )
    )
    return products.join(users, "category", "left").select(
        "category",
        F.coalesce("nb_users", F.lit(0)).alias("nb_users"),
        "nb_products",
        "avg_rating",
        "conversion_rate",
        F.try_divide(F.col("user_rows").cast("double"), F.col("nb_users")).alias(
            "avg_interactions_per_user"
        ),
    )


def category_month_stats(interactions: DataFrame) -> DataFrame:
    return (
        interactions.filter(S.valid_month(F.col("year_month")))
        .groupBy("category", "year_month")
        .agg(
            _rows().alias("nb_interactions"),
            F.avg("converted").alias("conversion_rate"),
            F.avg("rating").alias("avg_rating"),
        )
    )


def product_lifespan(interactions: DataFrame) -> DataFrame:
    """First and last day, days between, and trend per product.

    Rows are first counted per (product, day), which leaves at most one row per calendar day
    of a product, however many interactions it has. The trend compares the days after the
    middle of the product's life with those up to it; within 10 % it is stable.
    """
    daily = (
        interactions.withColumn("day", F.to_date(S.event_time(F.col("timestamp"))))
        .filter(F.col("product_id").isNotNull() & F.col("day").isNotNull())
        .groupBy("product_id", "day")
        .agg(_rows().alias("n"))
    )
    life = Window.partitionBy("product_id")
    number = F.unix_date("day")
    late_day = number * 2 > F.min(number).over(life) + F.max(number).over(life)
    halves = (
        daily.withColumn("late", late_day)
        .groupBy("product_id")
        .agg(
            F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
            F.sum(F.when(F.col("late"), 0).otherwise(F.col("n"))).alias("n_first_half"),
            F.sum(F.when(F.col("late"), F.col("n")).otherwise(0)).alias("n_second_half"),
        )
    )
    early, late = F.col("n_first_half"), F.col("n_second_half")
    return halves.select(
        "product_id",
        F.col("first_day").cast("string").alias("first_date"),
        F.col("last_day").cast("string").alias("last_date"),
        F.datediff("last_day", "first_day").cast("long").alias("lifespan_days"),
        "n_first_half",
        "n_second_half",
        F.when(late > early * (1 + TREND_MARGIN), "increasing")
        .when(late < early * (1 - TREND_MARGIN), "decreasing")
        .otherwise("stable")
        .alias("trend"),
    )


def user_diversity(interactions: DataFrame) -> DataFrame:
    """Categories per user, the main one (ties by name), and Shannon entropy in bits.

    With N rows in counts n, the entropy -sum(p log2 p) is log2(N) - sum(n log2 n) / N, so
    two levels of combining aggregation suffice.
    """
    per_category = (
        interactions.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", "category")
        .agg(_rows().alias("n"))
    )
    return per_category.groupBy("user_id").agg(
        F.count("category").alias("nb_categories"),
        F.min(F.struct((-F.col("n")).alias("minus_n"), "category"))["category"].alias(
            "main_category"
        ),
        F.greatest(
            F.log2(F.sum("n")) - F.sum(F.col("n") * F.log2("n")) / F.sum("n"), F.lit(0.0)
        ).alias("diversity_index"),
    )


def review_quality(interactions: DataFrame) -> DataFrame:
    """Helpful votes, verified share and share of 4-5 star against 1-2 star ratings."""
    good = F.count_if(F.col("rating").between(4, 5))
    bad = F.count_if(F.col("rating").between(1, 2))
    return (
        interactions.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.avg("helpful_vote").alias("avg_helpful_votes"),
            (F.avg("converted") * 100).alias("pct_verified_purchases"),
            F.try_divide(good.cast("double"), good + bad).alias("sentiment_ratio"),
        )
    )


def segment_category(interactions: DataFrame, users: DataFrame) -> DataFrame:
    """Rating, conversion and rows per (segment, category); combined per user first."""
    per_user = interactions.filter(F.col("user_id").isNotNull()).groupBy("user_id", "category").agg(
        F.sum("rating").alias("r"),
        F.count("rating").alias("rn"),
        F.sum("converted").alias("c"),
        _rows().alias("n"),
    )
    return (
        per_user.join(users.select("user_id", "segment"), "user_id")
        .groupBy("segment", "category")
        .agg(
            F.try_divide(F.sum("r"), F.sum("rn")).alias("avg_rating"),
            F.try_divide(F.sum("c").cast("double"), F.sum("n")).alias("conversion_rate"),
            F.sum("n").alias("nb_interactions"),
        )
    )


def segment_category_matrix(
    interactions: DataFrame, users: DataFrame, categories: Sequence[str]
) -> DataFrame:
    """Conversion rate with one column per category; the list avoids a discovery job."""
    return (
        segment_category(interactions, users)
        .groupBy("segment")
        .pivot("category", list(categories))
        .agg(F.first("conversion_rate"))
    )


def user_cadence(interactions: DataFrame, today: str) -> DataFrame:
    """Days between purchases: mean, spread over mean, and days since the last one.

    Purchases are counted per (user, day) first. Purchases on one day give zero-day gaps,
    which the counts carry; the window then sees at most one row per calendar day of a
    user, however many purchases there are.
    """
    day = F.to_date(S.event_time(F.col("timestamp")))
    daily = (
        interactions.filter(
            (F.col("interaction_type") == S.PURCHASE) & F.col("user_id").isNotNull()
        )
        .withColumn("day", day)
        .filter(F.col("day").isNotNull())
        .groupBy("user_id", "day")
        .agg(_rows().alias("n"))
    )
    gap = F.datediff("day", F.lag("day").over(Window.partitionBy("user_id").orderBy("day")))
    sums = (
        daily.withColumn("gap", F.coalesce(gap, F.lit(0)).cast("double"))
        .groupBy("user_id")
        .agg(
            F.sum("n").alias("n_purchases"),
            F.sum("gap").alias("g1"),
            F.sum(F.col("gap") * F.col("gap")).alias("g2"),
            F.max("day").alias("last_day"),
        )
    )
    m = (F.col("n_purchases") - 1).cast("double")
    mean = F.try_divide(F.col("g1"), m)
    variance = F.when(m > 1, F.greatest((F.col("g2") - F.col("g1") * mean) / (m - 1), F.lit(0.0)))
    return sums.select(
        "user_id",
        "n_purchases",
        mean.alias("avg_days_between"),
        F.try_divide(F.sqrt(variance), mean).alias("regularity_score"),
        F.datediff(F.to_date(F.lit(today)), F.col("last_day"))
        .cast("long")
        .alias("last_purchase_days_ago"),
    )


def weighted_pair_counts(
    interactions: DataFrame, purchase_weight: float = 2.0, review_weight: float = 1.0
) -> DataFrame:
    """Implicit signal weighted by helpful votes, a purchase above a review."""
    kind = F.when(F.col("interaction_type") == S.PURCHASE, purchase_weight).otherwise(
        review_weight
    )
    votes = F.greatest(F.coalesce(F.col("helpful_vote"), F.lit(0)), F.lit(0))
    return (
        interactions.filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("user_id", "product_id")
        .agg(F.sum(kind * (1 + F.log1p(votes.cast("double")))).alias("weight"))
    )


def declining_penalty(
    scored: DataFrame, lifespan: DataFrame, factor: float = DECLINE_FACTOR
) -> DataFrame:
    """Scores of declining products times ``factor``."""
    falling = lifespan.filter(F.col("trend") == "decreasing").select(
        "product_id", F.lit(True).alias("declining")
    )
    return scored.join(falling, "product_id", "left").select(
        *[scored[c] for c in scored.columns if c != "score"],
        F.when(F.col("declining"), F.col("score") * factor)
        .otherwise(F.col("score"))
        .alias("score"),
    )


def feedback_to_interactions(feedback: DataFrame, products: DataFrame) -> DataFrame:
    """Clicks and purchases as new interaction rows; skips are negative and dropped."""
    kept = feedback.filter(F.col("interaction_type").isin("click", "purchase"))
    ms = F.unix_millis("ts")
    kind = F.when(F.col("interaction_type") == S.PURCHASE, S.PURCHASE).otherwise(S.REVIEW)
    return kept.join(products.select("product_id", "category"), "product_id", "left").select(
        "user_id",
        "product_id",
        F.lit(None).cast("double").alias("rating"),
        ms.alias("timestamp"),
        kind.alias("interaction_type"),
        S.converted(kind).alias("converted"),
        S.year_month(ms).alias("year_month"),
        F.lit(0).cast("long").alias("helpful_vote"),
        "category",
    )

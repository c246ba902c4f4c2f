"""Bronze layer: raw reviews and metadata to interactions, products and users."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from recolens.functions import scalars as S
from recolens.functions.vectors import zeros
from recolens.operators.skew import cut
from recolens.schema import INTERACTIONS, PRODUCTS, conform


def bronze_interactions(reviews: DataFrame) -> DataFrame:
    """Rename the id, derive type, conversion flag and month, keep the table's columns."""
    kind = S.interaction_type(F.col("verified_purchase"))
    typed = (
        reviews.withColumnRenamed("asin", "product_id")
        .withColumn("interaction_type", kind)
        .withColumn("converted", S.converted(F.col("interaction_type")))
        .withColumn("year_month", S.year_month(F.col("timestamp")))
    )
    return conform(typed, INTERACTIONS, ("user_id", "product_id", "category"))


def dedup_products(products: DataFrame) -> DataFrame:
    """One row per product_id; the winner is fixed by a total order over the columns.

    The rank filter becomes a group limit before the shuffle, so many copies of one id
    shrink to one row per map task.
    """
    rest = [F.col(c).asc_nulls_last() for c in products.columns if c != "product_id"]
    w = Window.partitionBy("product_id").orderBy(*rest)
    return (
        products.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")
    )


def bronze_products(metadata: DataFrame) -> DataFrame:
    """Keep-list projection of the metadata, unique on product_id, placeholder vector."""
    kept = conform(metadata, PRODUCTS, ("product_id", "category"))
    return dedup_products(kept).withColumn("p", zeros())


def user_profile_partial(interactions: DataFrame) -> DataFrame:
    """Per (category, user): rows with a product, conversions, mean rating."""
    return interactions.filter(F.col("user_id").isNotNull()).groupBy("category", "user_id").agg(
        F.count("product_id").alias("total_interactions"),
        F.sum("converted").cast("long").alias("total_purchases"),
        F.avg("rating").alias("avg_rating"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_n"),
    )


def merge_profiles(partials: DataFrame) -> DataFrame:
    """Users over all categories.

    ``avg_rating`` is the mean of the per-category means (the established definition);
    ``avg_rating_weighted`` weights every rating once.
    """
    return partials.groupBy("user_id").agg(
        F.sum("total_interactions").alias("total_interactions"),
        F.sum("total_purchases").alias("total_purchases"),
        F.avg("avg_rating").alias("avg_rating"),
        F.try_divide(F.sum("rating_sum"), F.sum("rating_n")).alias("avg_rating_weighted"),
    )


def purchase_quantiles(users: DataFrame) -> DataFrame:
    """Exact, interpolated p50 and p90 of total_purchases in one row.

    Users are first counted per distinct total: distinct totals number at most about the
    square root of all purchases, which bounds what the final task holds.
    """
    totals = users.groupBy("total_purchases").agg(F.count(F.lit(1)).alias("n"))
    return totals.agg(
        F.expr("percentile(total_purchases, 0.5D, n)").alias("p50"),
        F.expr("percentile(total_purchases, 0.9D, n)").alias("p90"),
    )


def with_segment(users: DataFrame) -> DataFrame:
    cuts = purchase_quantiles(users).select(F.struct("p50", "p90")).scalar()
    return users.withColumn(
        "segment",
        S.segment(F.col("total_purchases"), cuts.getField("p50"), cuts.getField("p90")),
    )


def user_profile(interactions: DataFrame) -> DataFrame:
    """Users with totals, ratings and segment; value and vector columns are placeholders.

    The profiles are written once: the quantile cuts and the labels both read them, and the
    interactions are passed over a single time.
    """
    merged = cut(merge_profiles(user_profile_partial(interactions)))
    return (
        with_segment(merged)
        .withColumn("avg_order_value", F.lit(0.0))
        .withColumn("u", zeros())
    )

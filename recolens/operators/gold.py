"""Gold layer: product statistics, popularity and cold tags."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recolens.functions import scalars as S
from recolens.operators.skew import broadcast_if_small

FEATURES = ("conversion_rate", "popularity_score")


def product_stats(interactions: DataFrame) -> DataFrame:
    """Rows, conversions and conversion rate per product (combined on the map side)."""
    return (
        interactions.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(
            F.count(F.lit(1)).alias("nb_interactions"),
            F.sum("converted").cast("long").alias("nb_conversions"),
        )
        .withColumn(
            "conversion_rate",
            F.col("nb_conversions").cast("double") / F.col("nb_interactions").cast("double"),
        )
    )


def popularity_score(stats: DataFrame) -> DataFrame:
    """log1p(n) over its maximum.

    The maximum is a scalar subquery. Its struct carries every column of the aggregate, so
    the subquery asks for the same exchange as the main branch and Spark reuses it.
    """
    logged = F.log1p(F.col("nb_interactions").cast("double"))
    rest = [c for c in stats.columns if c not in ("product_id", "nb_interactions")]
    top = stats.agg(F.max(F.struct("nb_interactions", *rest)).alias("m")).select(
        F.log1p(F.col("m.nb_interactions").cast("double"))
    )
    return stats.withColumn("popularity_score", logged / top.scalar())


def fill_defaults(df: DataFrame) -> DataFrame:
    present = [c for c in (*FEATURES, "nb_interactions") if c in df.columns]
    return df.fillna({c: 0 for c in present})


def gold_products(
    silver: DataFrame, products: DataFrame, min_interactions: int = S.MIN_INTERACTIONS
) -> DataFrame:
    """Catalogue with statistics; products without rows get zeros and count as cold.

    The statistics are the side a left join can broadcast. Their size is that of the active
    catalogue, so the choice is left to the size checks of Spark's planner.
    """
    stats = popularity_score(product_stats(silver)).select(
        "product_id", *FEATURES, "nb_interactions"
    )
    joined = fill_defaults(products.join(stats, "product_id", "left"))
    return joined.withColumn("is_cold", S.is_cold(F.col("nb_interactions"), min_interactions))


def gold_interactions(silver: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """Silver rows with their product's features.

    Pass ``stats`` (a written gold table) to check its size and broadcast it; without it the
    features come from the same silver rows and the planner decides.
    """
    if stats is None:
        features = popularity_score(product_stats(silver)).select("product_id", *FEATURES)
    else:
        features = broadcast_if_small(stats.select("product_id", *FEATURES))
    return fill_defaults(silver.join(features, "product_id", "left"))


def join_sortmerge(interactions: DataFrame, products: DataFrame) -> DataFrame:
    """The product join as a sort-merge join, whatever the sizes."""
    return interactions.join(products.hint("merge"), "product_id", "left")


def join_broadcast(interactions: DataFrame, products: DataFrame) -> DataFrame:
    """The product join as a broadcast join while the catalogue is within its bound."""
    return interactions.join(broadcast_if_small(products), "product_id", "left")


def orphan_rate(interactions: DataFrame, products: DataFrame) -> DataFrame:
    """Interactions whose product is not in the catalogue: count, total, share.

    Rows are counted per product first, so the join sees each product once.
    """
    per_product = interactions.groupBy("product_id").agg(F.count(F.lit(1)).alias("n"))
    known = products.select("product_id", F.lit(True).alias("known")).distinct()
    return (
        per_product.join(known, "product_id", "left")
        .agg(
            F.coalesce(F.sum(F.when(F.col("known").isNull(), F.col("n"))), F.lit(0)).alias(
                "n_orphans"
            ),
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        )
        .withColumn("orphan_rate", F.try_divide(F.col("n_orphans"), F.col("n_rows")))
    )

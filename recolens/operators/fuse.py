"""Fused vectors: learned factors where they exist, content or averages elsewhere."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recolens.functions import scalars as S
from recolens.functions.vectors import DIM, or_zeros
from recolens.operators.cold_start import interaction_counts, pair_counts
from recolens.operators.skew import by_shuffle


def attach_factors(df: DataFrame, factors: DataFrame, key: str, vector: str) -> DataFrame:
    """Left join that replaces the placeholder vector; NULL where there are no factors."""
    return df.drop(vector).join(by_shuffle(factors.select(key, vector)), key, "left")


def coalesce_vectors(df: DataFrame, predicted: DataFrame, key: str, vector: str) -> DataFrame:
    """Fill only missing vectors from ``predicted``."""
    other = predicted.select(key, F.col(vector).alias("__predicted"))
    return (
        df.join(by_shuffle(other), key, "left")
        .withColumn(vector, F.coalesce(vector, "__predicted"))
        .drop("__predicted")
    )


def interaction_vectors(interactions: DataFrame, products: DataFrame) -> DataFrame:
    """Each interaction with its product's vector (NULL outside the catalogue)."""
    return interactions.join(by_shuffle(products.select("product_id", "p")), "product_id", "left")


def mean_vectors(
    interactions: DataFrame, product_vectors: DataFrame, dim: int = DIM
) -> DataFrame:
    """Per user the mean of the vectors of the items seen, repeats counted, NULLs skipped.

    Repeats become weights before the join; the means are plain combining sums.
    """
    weighted = pair_counts(interactions).join(by_shuffle(product_vectors.select("product_id", "p")), "product_id")
    known = weighted.filter(F.col("p").isNotNull())
    sums = known.groupBy("user_id").agg(
        F.sum("count").alias("__n"),
        *[F.sum(F.col("p")[i].cast("double") * F.col("count")).alias(f"__s{i}") for i in range(dim)],
    )
    return sums.select(
        "user_id",
        F.array(*[(F.col(f"__s{i}") / F.col("__n")).cast("float") for i in range(dim)]).alias("u"),
    )


def cold_user_vectors(
    interactions: DataFrame, product_vectors: DataFrame, users_with_factors: DataFrame
) -> DataFrame:
    """Mean item vectors of the users that have no factors."""
    cold = interactions.join(users_with_factors.select("user_id"), "user_id", "left_anti")
    return mean_vectors(cold, product_vectors)


def _source(first: str, second: str, second_name: str):
    return (
        F.when(F.col(first).isNotNull(), "als")
        .when(F.col(second).isNotNull(), second_name)
        .otherwise("zero")
    )


def fuse_products(
    products: DataFrame,
    als_items: DataFrame,
    bridged: DataFrame,
    counts_from: DataFrame,
    min_interactions: int = S.MIN_INTERACTIONS,
) -> DataFrame:
    """Catalogue with ``p``, ``vector_source`` and the count-based ``is_cold``.

    ``counts_from`` are the interactions (bronze or silver) that decide warm and cold.
    """
    counts = interaction_counts(counts_from, "product_id")
    joined = (
        products.drop("p", "nb_interactions", "is_cold")
        .join(by_shuffle(als_items.select("product_id", F.col("p").alias("__als"))), "product_id", "left")
        .join(by_shuffle(bridged.select("product_id", F.col("p").alias("__bridge"))), "product_id", "left")
        .join(counts, "product_id", "left")
    )
    return (
        joined.withColumn("p", or_zeros(F.coalesce("__als", "__bridge")))
        .withColumn("vector_source", _source("__als", "__bridge", "bridge"))
        .withColumn("is_cold", S.is_cold(F.col("nb_interactions"), min_interactions))
        .drop("__als", "__bridge", "nb_interactions")
    )


def fuse_users(
    users: DataFrame,
    als_users: DataFrame,
    interactions: DataFrame,
    product_vectors: DataFrame,
    min_interactions: int = S.MIN_INTERACTIONS,
) -> DataFrame:
    """Users with ``u`` from factors, else the mean of seen items, else zeros."""
    counts = interaction_counts(interactions, "user_id")
    means = cold_user_vectors(interactions, product_vectors, als_users)
    joined = (
        users.drop("u", "is_cold")
        .join(by_shuffle(als_users.select("user_id", F.col("u").alias("__als"))), "user_id", "left")
        .join(by_shuffle(means.select("user_id", F.col("u").alias("__mean"))), "user_id", "left")
        .join(counts, "user_id", "left")
    )
    return (
        joined.withColumn("u", or_zeros(F.coalesce("__als", "__mean")))
        .withColumn("vector_source", _source("__als", "__mean", "mean"))
        .withColumn("is_cold", S.is_cold(F.col("nb_interactions"), min_interactions))
        .drop("__als", "__mean", "nb_interactions")
    )


def fusion_summary(products: DataFrame, users: DataFrame) -> DataFrame:
    """Warm and cold counts and shares of both fused tables."""

    def side(df: DataFrame, entity: str) -> DataFrame:
        return df.agg(
            F.lit(entity).alias("entity"),
            F.count_if(~F.col("is_cold")).alias("n_warm"),
            F.count_if("is_cold").alias("n_cold"),
            F.count(F.lit(1)).alias("n_total"),
        )

    both = side(products, "products").unionByName(side(users, "users"))
    return both.withColumn(
        "pct_warm", F.try_divide(F.col("n_warm") * 100.0, F.col("n_total"))
    ).withColumn("pct_cold", F.try_divide(F.col("n_cold") * 100.0, F.col("n_total")))

"""Warm / cold classification and popularity fallbacks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from recolens.functions import scalars as S

POPULAR_GLOBAL = 500


def interaction_counts(interactions: DataFrame, id_col: str) -> DataFrame:
    return (
        interactions.filter(F.col(id_col).isNotNull())
        .groupBy(id_col)
        .agg(F.count(F.lit(1)).alias("nb_interactions"))
    )


def classify_warm_cold(
    interactions: DataFrame, id_col: str, min_interactions: int = S.MIN_INTERACTIONS
) -> DataFrame:
    """Every id seen, with its row count and ``is_cold``."""
    counts = interaction_counts(interactions, id_col)
    return counts.withColumn("is_cold", S.is_cold(F.col("nb_interactions"), min_interactions))


def warm_ids(interactions: DataFrame, id_col: str, min_interactions: int = 5) -> DataFrame:
    return (
        interaction_counts(interactions, id_col)
        .filter(F.col("nb_interactions") >= min_interactions)
        .select(id_col)
    )


def cold_ids(all_ids: DataFrame, warm: DataFrame, id_col: str) -> DataFrame:
    """Set difference: ids of the table that are not warm (never seen counts as cold)."""
    return all_ids.select(id_col).distinct().join(warm, id_col, "left_anti")


def semi_by_ids(df: DataFrame, ids: DataFrame, id_col: str) -> DataFrame:
    """Membership filter."""
    return df.join(ids.select(id_col), id_col, "left_semi")


def min_support_filter(
    interactions: DataFrame, min_interactions: int = S.MIN_INTERACTIONS
) -> DataFrame:
    """Rows whose user and item both have enough rows, judged once on the input.

    Semi joins, not counting windows: the counts combine before the shuffle and a heavy
    user or item is split by skew-join handling.
    """
    users = warm_ids(interactions, "user_id", min_interactions)
    items = warm_ids(interactions, "product_id", min_interactions)
    return interactions.join(users, "user_id", "left_semi").join(
        items, "product_id", "left_semi"
    )


def cold_start_report(
    interactions: DataFrame, min_interactions: int = S.MIN_INTERACTIONS
) -> DataFrame:
    """Warm and cold counts and shares for products and users."""

    def side(entity: str, id_col: str) -> DataFrame:
        return (
            classify_warm_cold(interactions, id_col, min_interactions)
            .agg(
                F.count_if(~F.col("is_cold")).alias("n_warm"),
                F.count_if("is_cold").alias("n_cold"),
            )
            .select(
                F.lit(entity).alias("entity"),
                "n_warm",
                "n_cold",
                _pct("n_warm").alias("pct_warm"),
                _pct("n_cold").alias("pct_cold"),
            )
        )

    return side("products", "product_id").unionByName(side("users", "user_id"))


def _pct(col: str):
    return F.try_divide(F.col(col) * 100.0, F.col("n_warm") + F.col("n_cold"))


def popular_global(
    interactions: DataFrame, products: DataFrame, k: int = POPULAR_GLOBAL
) -> DataFrame:
    """Most frequent products that exist in the catalogue, ranked; ties by id."""
    counts = interaction_counts(interactions, "product_id")
    top = (
        counts.join(products.select("product_id", "category"), "product_id")
        .orderBy(F.col("nb_interactions").desc(), "product_id")
        .limit(k)
    )
    # At most k rows from here on.
    w = Window.orderBy(F.col("nb_interactions").desc(), "product_id")
    return top.withColumn("rank", F.row_number().over(w))


def popularity_by_category(interactions: DataFrame, k: int = 10) -> DataFrame:
    """Top-k products of each category; the rank filter limits rows before the shuffle."""
    counts = (
        interactions.filter(F.col("product_id").isNotNull() & F.col("category").isNotNull())
        .groupBy("category", "product_id")
        .agg(F.count(F.lit(1)).alias("nb_interactions"))
    )
    w = Window.partitionBy("category").orderBy(F.col("nb_interactions").desc(), "product_id")
    return counts.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def recommend_cold(
    requests: DataFrame, by_category: DataFrame, popular: DataFrame, n: int = 10
) -> DataFrame:
    """Popular products of the requested category when it is known, else global ones.

    Both lists are at most k rows per category plus k global rows, keyed by scope; the
    requests meet them through one equality join on that scope.
    """
    known = by_category.select(F.col("category").alias("scope")).distinct()
    scoped = by_category.select(F.col("category").alias("scope"), "product_id", "rank").unionByName(
        popular.select(F.lit("*").alias("scope"), "product_id", "rank")
    )
    placed = requests.join(
        known.withColumn("known", F.lit(True)), requests["category"] == known["scope"], "left"
    ).select(
        *[requests[c] for c in requests.columns],
        F.when(F.col("known"), requests["category"]).otherwise("*").alias("scope"),
    )
    return (
        placed.join(scoped.filter(F.col("rank") <= n), "scope")
        .drop("scope")
    )


def seen_items(interactions: DataFrame) -> DataFrame:
    """The products of each user, one row per pair: a set that may be any size."""
    return interactions.filter(
        F.col("user_id").isNotNull() & F.col("product_id").isNotNull()
    ).select("user_id", "product_id").distinct()


def pair_counts(interactions: DataFrame) -> DataFrame:
    """Rows per (user, product): the implicit signal."""
    return (
        interactions.filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())
        .groupBy("user_id", "product_id")
        .agg(F.count(F.lit(1)).alias("count"))
    )


def exclude_seen(candidates: DataFrame, seen: DataFrame) -> DataFrame:
    """Candidates the user has not interacted with."""
    pairs = seen.select("user_id", "product_id")
    return candidates.join(pairs, ["user_id", "product_id"], "left_anti")

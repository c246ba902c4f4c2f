"""Silver layer: cleaned, deduplicated interactions with recency and frequency."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Window, functions as F

from recolens.functions import scalars as S
from recolens.operators.skew import hot_key_rows, hot_keys, numbered, numbered_by_pieces

DEDUP_KEY = ("user_id", "product_id", "timestamp")


def recency_order():
    """Newest first; the product id settles ties, so the order is total after dedup."""
    return [F.col("timestamp").desc_nulls_last(), F.col("product_id").asc()]


def drop_null_keys(interactions: DataFrame) -> DataFrame:
    return interactions.filter(F.col("user_id").isNotNull() & F.col("product_id").isNotNull())


def clamp_ratings(interactions: DataFrame) -> DataFrame:
    return interactions.withColumn("rating", S.clamp_rating(F.col("rating")))


def _winner():
    """Which of several rows with one dedup key is kept; equal rows cannot be told apart."""
    return [
        F.col("rating").desc_nulls_last(),
        F.col("converted").desc_nulls_last(),
        F.col("helpful_vote").desc_nulls_last(),
        F.col("category").asc_nulls_last(),
        F.col("interaction_type").asc_nulls_last(),
    ]


def dedup_interactions(interactions: DataFrame) -> DataFrame:
    """One row per (user, product, timestamp), the same one on every run.

    As the filter keeps one row per key, Spark applies it before the shuffle too: any
    number of copies of one key leaves at most one row per map task.
    """
    w = Window.partitionBy(*DEDUP_KEY).orderBy(*_winner())
    return (
        interactions.withColumn("__rn", F.row_number().over(w))
        .filter("__rn = 1")
        .drop("__rn")
    )


def _dedup_in_order(interactions: DataFrame) -> DataFrame:
    """The same rows as :func:`dedup_interactions`, by comparing neighbours.

    Sorted by recency with the winner first, copies of a key follow each other. The ranks
    computed next need this very order, so one exchange and one sort serve everything.
    """
    w = Window.partitionBy("user_id").orderBy(*recency_order(), *_winner())
    copy = F.lag("product_id").over(w).eqNullSafe(F.col("product_id")) & F.lag(
        "timestamp"
    ).over(w).eqNullSafe(F.col("timestamp"))
    return interactions.withColumn("__copy", copy).filter(~F.col("__copy")).drop("__copy")


def _score(ranked: DataFrame) -> DataFrame:
    return ranked.withColumn(
        "rf_score",
        F.col("user_interaction_count").cast("double") / F.col("recency_rank").cast("double"),
    )


def heavy_users(users: DataFrame) -> DataFrame | None:
    """Users with more interactions than one task should take, from the users table."""
    limit = hot_key_rows(users.sparkSession)
    heavy = users.filter(F.col("total_interactions") > limit).select("user_id")
    return None if heavy.isEmpty() else heavy


def silver_interactions(interactions: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Null keys out, ratings clamped, duplicates removed, recency and frequency added.

    Ordinary users: one exchange on user_id and one sort serve the dedup and both windows.
    Users with more rows than a task should take are deduplicated on the fine key and
    ranked by range pieces instead. They are looked up in the ``users`` table of the same
    interactions when it is given, and counted otherwise.
    """
    clean = clamp_ratings(drop_null_keys(interactions))
    hot = hot_keys(clean, ["user_id"]) if users is None else heavy_users(users)
    names = ("recency_rank", "user_interaction_count")
    if hot is None:
        return _score(numbered(_dedup_in_order(clean), ["user_id"], recency_order(), *names))
    usual = clean.join(F.broadcast(hot), "user_id", "left_anti")
    large = clean.join(F.broadcast(hot), "user_id", "left_semi")
    ranked = numbered(_dedup_in_order(usual), ["user_id"], recency_order(), *names)
    spread = numbered_by_pieces(
        dedup_interactions(large), ["user_id"], recency_order(), *names
    )
    return _score(ranked.unionByName(spread))


def with_layer_counts(
    before: DataFrame, build, name: str = "layer"
) -> tuple[DataFrame, Observation, Observation]:
    """Count rows going in and out of ``build`` while it runs, instead of in extra jobs."""
    seen_in, seen_out = Observation(f"{name}_in"), Observation(f"{name}_out")
    after = build(before.observe(seen_in, F.count(F.lit(1)).alias("rows")))
    return after.observe(seen_out, F.count(F.lit(1)).alias("rows")), seen_in, seen_out


def layer_counts(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before, after and removed, in one row."""
    n_before = before.agg(F.count(F.lit(1)).alias("n_before"))
    n_after = after.agg(F.count(F.lit(1)).alias("n_after"))
    return n_after.select(n_before.scalar().alias("n_before"), "n_after").withColumn(
        "n_removed", F.col("n_before") - F.col("n_after")
    )

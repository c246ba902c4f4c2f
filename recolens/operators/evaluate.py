"""Offline ranking evaluation: temporal split, NDCG, baselines, grid search."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import product as combinations

from pyspark.sql import DataFrame, Window, functions as F

from recolens.functions.scalars import lift_pct
from recolens.operators.als import IndexedPairs, als_factors, als_fit, index_ids
from recolens.operators.cold_start import interaction_counts, pair_counts
from recolens.operators.scoring import top_items
from recolens.operators.skew import BROADCAST_ROWS, cut, hot_keys, numbered
from recolens.sources.writers import RUNS

SAMPLE_USERS, MIN_EVAL_INTERACTIONS, TEST_RATIO, K = 1000, 10, 0.2, 10
GRID_RANKS, GRID_REGS, GRID_ITERATIONS = (8, 16, 32), (0.01, 0.1, 0.5), (10, 20)


def eligible_users(interactions: DataFrame, minimum: int = MIN_EVAL_INTERACTIONS) -> DataFrame:
    """Users with enough rows to be split."""
    counts = interaction_counts(interactions, "user_id")
    return counts.filter(F.col("nb_interactions") >= minimum).select("user_id")


def eval_sample(
    interactions: DataFrame, n: int = SAMPLE_USERS, minimum: int = MIN_EVAL_INTERACTIONS,
    seed: int = 42,
) -> DataFrame:
    """``n`` users with enough rows, drawn in the order of a seeded hash (repeatable)."""
    eligible = eligible_users(interactions, minimum)
    key = F.md5(F.concat(F.lit(f"{seed}:"), "user_id"))
    return eligible.orderBy(key, "user_id").limit(n).select("user_id")


def split_train_test(interactions: DataFrame, ratio: float = TEST_RATIO) -> DataFrame:
    """Column ``split``: per user the first int(n * (1 - ratio)) rows by time are train.

    Ties are settled by the remaining columns, so equal rows alone can change places.
    """
    rows = interactions.filter(F.col("user_id").isNotNull())
    order = [
        F.col("timestamp").asc_nulls_last(),
        F.col("product_id").asc_nulls_last(),
        F.col("rating").desc_nulls_last(),
        F.col("converted").desc_nulls_last(),
        F.col("helpful_vote").desc_nulls_last(),
        F.col("category").asc_nulls_last(),
    ]
    hot = hot_keys(rows, ["user_id"])
    ranked = numbered(rows, ["user_id"], order, "__rn", "__n", hot=hot)
    train_rows = F.floor(F.col("__n") * F.lit(1 - ratio))
    return ranked.withColumn(
        "split", F.when(F.col("__rn") <= train_rows, "train").otherwise("test")
    ).drop("__rn", "__n")


def train_rows(split: DataFrame) -> DataFrame:
    return split.filter("split = 'train'").drop("split")


def test_rows(split: DataFrame) -> DataFrame:
    return split.filter("split = 'test'").drop("split")


def relevant_sets(test: DataFrame) -> DataFrame:
    """The distinct test items of each user, one row per pair."""
    return test.filter(F.col("product_id").isNotNull()).select("user_id", "product_id").distinct()


def _ideal(n, k: int):
    """Gain of a perfect list with n relevant items in the first k places."""
    places = F.sequence(F.lit(1), F.least(n, F.lit(k)).cast("int"))
    return F.aggregate(places, F.lit(0.0), lambda s, i: s + 1.0 / F.log2(i + 1.0))


def ndcg_at_k(predicted: DataFrame, relevant: DataFrame, k: int = K) -> DataFrame:
    """(user_id, ndcg) for every user with relevant items.

    ``predicted``: user_id, product_id, rank. ``relevant``: distinct (user_id, product_id).
    """
    gains = relevant.join(
        predicted.filter(F.col("rank") <= k).select("user_id", "product_id", "rank"),
        ["user_id", "product_id"],
        "left",
    )
    return _ndcg(gains, k)


def _ndcg(gains: DataFrame, k: int) -> DataFrame:
    return gains.groupBy("user_id").agg(
        F.coalesce(F.sum(1.0 / F.log2(F.col("rank") + 1.0)), F.lit(0.0)).alias("dcg"),
        F.count(F.lit(1)).alias("n_relevant"),
    ).select("user_id", (F.col("dcg") / _ideal(F.col("n_relevant"), k)).alias("ndcg"))


def top_products(train: DataFrame, k: int = K) -> DataFrame:
    """The k most frequent products, ranked; ties by id."""
    top = (
        interaction_counts(train, "product_id")
        .orderBy(F.col("nb_interactions").desc(), "product_id")
        .limit(k)
    )
    w = Window.orderBy(F.col("nb_interactions").desc(), "product_id")  # k rows
    return top.withColumn("rank", F.row_number().over(w))


def popularity_ndcg(
    split: DataFrame, k: int = K, exclude_seen_in_baseline: bool = False
) -> DataFrame:
    """(user_id, ndcg) of recommending the same k train products to everybody.

    Only a user's relevant items are matched against the k products, by equality; with
    ``exclude_seen_in_baseline`` the products in a user's train rows count as misses.
    """
    relevant = relevant_sets(test_rows(split))
    top = top_products(train_rows(split), k).select("product_id", "rank")
    gains = relevant.join(F.broadcast(top), "product_id", "left")
    if exclude_seen_in_baseline:
        seen = (
            train_rows(split)
            .join(F.broadcast(top), "product_id", "left_semi")
            .select("user_id", "product_id")
            .distinct()
            .withColumn("seen", F.lit(True))
        )
        gains = gains.join(seen, ["user_id", "product_id"], "left").withColumn(
            "rank", F.when(F.col("seen").isNull(), F.col("rank"))
        )
    return _ndcg(gains, k)


def mean_ndcg(ndcg: DataFrame) -> DataFrame:
    return ndcg.agg(
        F.coalesce(F.avg("ndcg"), F.lit(0.0)).alias("ndcg"),
        F.count(F.lit(1)).alias("n_users"),
    )


def sampled_split(
    interactions: DataFrame, sample_users: int | None = None, seed: int = 42,
    ratio: float = TEST_RATIO,
) -> DataFrame:
    """The split rows of all users with enough rows, or of a sample of them, written once: train and
    test rows, baselines and fits all read them without going back to the interactions."""
    if sample_users is None:
        users = eligible_users(interactions)
    else:
        users = eval_sample(interactions, sample_users, seed=seed)
        if sample_users <= BROADCAST_ROWS:
            users = F.broadcast(users)
    return cut(split_train_test(interactions.join(users, "user_id", "left_semi"), ratio))


def evaluate_popularity(
    interactions: DataFrame, sample_users: int | None = None, k: int = K, seed: int = 42,
    exclude_seen_in_baseline: bool = False,
) -> DataFrame:
    split = sampled_split(interactions, sample_users, seed)
    return mean_ndcg(popularity_ndcg(split, k, exclude_seen_in_baseline))


def indexed_pairs(train: DataFrame) -> tuple[DataFrame, IndexedPairs]:
    """Written pair counts of the train rows and their dense ids; what several fits can share."""
    pairs = cut(pair_counts(train))
    ids = index_ids(pairs)
    return pairs, IndexedPairs(cut(ids.pairs), ids.users, ids.products)


def als_recommendations(
    train: DataFrame, k: int = K, rank: int = 16, iterations: int = 15, reg: float = 0.1,
    seed: int = 42, shared: tuple[DataFrame, IndexedPairs] | None = None,
) -> DataFrame:
    """Fit on the train rows and recommend each of its users k products not in them."""
    pairs, ids = shared or indexed_pairs(train)
    model = als_fit(ids.pairs, rank=rank, iterations=iterations, reg=reg, seed=seed)
    users, items = als_factors(model, ids)
    recs = top_items(
        users.select(F.col("user_id").alias("query_id"), F.col("u").alias("vec")),
        items.select("product_id", F.col("p").alias("vec")),
        k,
        masked=pairs.select(F.col("user_id").alias("query_id"), "product_id"),
    )
    return recs.select(F.col("query_id").alias("user_id"), "product_id", "score", "rank")


def evaluate_als(
    interactions: DataFrame, sample_users: int | None = None, k: int = K, rank: int = 16,
    iterations: int = 15, reg: float = 0.1, seed: int = 42,
) -> DataFrame:
    """Mean NDCG of factors fitted on the train rows of the evaluated users."""
    split = sampled_split(interactions, sample_users, seed)
    recs = als_recommendations(train_rows(split), k, rank, iterations, reg, seed)
    return mean_ndcg(ndcg_at_k(recs, relevant_sets(test_rows(split)), k))


def lift(scores: DataFrame, value: str, base: str) -> DataFrame:
    return scores.withColumn("lift_pct", lift_pct(F.col(value), F.col(base)))


def ndcg_by_segment(ndcg: DataFrame, users: DataFrame) -> DataFrame:
    return (
        ndcg.join(users.select("user_id", "segment"), "user_id")
        .groupBy("segment")
        .agg(F.avg("ndcg").alias("ndcg"), F.count(F.lit(1)).alias("n_users"))
    )


def grid_search(
    interactions: DataFrame,
    ranks: Sequence[int] = GRID_RANKS,
    regs: Sequence[float] = GRID_REGS,
    iterations: Sequence[int] = GRID_ITERATIONS,
    sample_users: int | None = None,
    k: int = K,
    seed: int = 42,
    parallelism: int = 2,
) -> DataFrame:
    """One fit per parameter set on the same split; runs as (run_id, kind, key, value) rows.

    Only one score per fit comes back to the driver.
    """
    spark = interactions.sparkSession
    split = sampled_split(interactions, sample_users, seed)
    train, relevant = train_rows(split), cut(relevant_sets(test_rows(split)))
    shared = indexed_pairs(train)
    baseline = mean_ndcg(popularity_ndcg(split, k)).first().ndcg

    def run(task):
        number, (rank, reg, iters) = task
        recs = als_recommendations(train, k, rank, iters, reg, seed, shared)
        score = mean_ndcg(ndcg_at_k(recs, relevant, k)).first().ndcg
        gain = (
            (score - baseline) / baseline * 100
            if baseline
            else (float("inf") if score > 0 else 0.0)
        )
        run_id = f"run-{number:03d}"
        return [
            (run_id, "param", "rank", str(rank)),
            (run_id, "param", "regularization", str(reg)),
            (run_id, "param", "iterations", str(iters)),
            (run_id, "param", "sample_users", "all" if sample_users is None else str(sample_users)),
            (run_id, "metric", f"ndcg_at_{k}", repr(score)),
            (run_id, "metric", "ndcg_popularity_baseline", repr(baseline)),
            (run_id, "metric", "lift_vs_popularity", repr(gain)),
        ]

    tasks = list(enumerate(combinations(ranks, regs, iterations), 1))
    with ThreadPoolExecutor(parallelism) as pool:
        rows = [row for rows in pool.map(run, tasks) for row in rows]
    return spark.createDataFrame(rows, RUNS)


def best_run(runs: DataFrame, metric: str = "ndcg_at_10") -> DataFrame:
    """The run with the highest metric, the earliest of equals, tagged Production."""
    scores = runs.filter((F.col("kind") == "metric") & (F.col("key") == metric)).select(
        "run_id", F.col("value").cast("double").alias("score")
    )
    return (
        scores.orderBy(F.col("score").desc(), "run_id")
        .limit(1)
        .withColumn("model_stage", F.lit("Production"))
    )

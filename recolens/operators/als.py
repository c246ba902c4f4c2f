"""Implicit matrix factorisation on interaction counts with Spark's own ALS."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame, functions as F

from recolens.functions.vectors import dot
from recolens.operators.skew import dense_index, ensure_checkpoint_dir

RANK, ITERATIONS, REGULARISATION, ALPHA = 16, 15, 0.1, 1.0
CHECKPOINT_EVERY = 1
BLOCKS = 10
#: Pairs of a block at most, about. A task holds one block's pairs and the factors of the other side they meet.
BLOCK_PAIRS = 8_000_000
MAX_INT_ID = 2**31 - 1


@dataclass
class IndexedPairs:
    """Pair counts under dense integer ids, with both id maps."""

    pairs: DataFrame  # user_id_int, product_id_int, count
    users: DataFrame  # user_id_int, user_id
    products: DataFrame  # product_id_int, product_id


def index_ids(pairs: DataFrame) -> IndexedPairs:
    """Map string ids to dense ints by id order; the maps are tables, not driver state."""
    users = dense_index(pairs, "user_id", "user_id_int")
    products = dense_index(pairs, "product_id", "product_id_int")
    if max(users.count(), products.count()) > MAX_INT_ID:
        raise ValueError("the factorisation takes at most 2^31 - 1 ids per side")
    indexed = (
        pairs.join(users, "user_id")
        .join(products, "product_id")
        .select("user_id_int", "product_id_int", "count")
    )
    return IndexedPairs(indexed, users, products)


def als_fit(
    indexed: DataFrame,
    rank: int = RANK,
    iterations: int = ITERATIONS,
    reg: float = REGULARISATION,
    alpha: float = ALPHA,
    seed: int = 42,
    blocks: int | None = None,
) -> ALSModel:
    """Fit on (user_id_int, product_id_int, count); every fit is seeded.

    The initial factors are drawn per block, so ``blocks`` belongs to the seed: it does not depend on the
    cluster, and on the table only where ``BLOCKS`` blocks would hold more than ``BLOCK_PAIRS`` pairs each, more
    than a task has memory for. The iterative lineage is cut by the estimator's own checkpoints, with which
    it also drops the factors it has sent.
    """
    spark = indexed.sparkSession
    ensure_checkpoint_dir(spark)
    # The estimator plans its input once to log it and once to read it; held, the joins before run once.
    ratings = indexed.select(
        F.col("user_id_int").cast("int"),
        F.col("product_id_int").cast("int"),
        F.col("count").cast("float"),
    ).persist(StorageLevel.DISK_ONLY)
    try:
        needed = math.ceil(ratings.count() / BLOCK_PAIRS)
        blocks = blocks or max(BLOCKS, needed)
        estimator = ALS(
            rank=rank,
            maxIter=iterations,
            regParam=reg,
            alpha=alpha,
            implicitPrefs=True,
            userCol="user_id_int",
            itemCol="product_id_int",
            ratingCol="count",
            numUserBlocks=blocks,
            numItemBlocks=blocks,
            checkpointInterval=CHECKPOINT_EVERY,
            # Blocks that are held in memory leave a large fit's tasks no room for theirs.
            intermediateStorageLevel="MEMORY_AND_DISK" if needed <= BLOCKS else "DISK_ONLY",
            seed=seed,
        )
        return estimator.fit(ratings)
    finally:
        ratings.unpersist()


def als_factors(model: ALSModel, ids: IndexedPairs) -> tuple[DataFrame, DataFrame]:
    """(user_id, u) and (product_id, p) with the string ids back."""
    users = model.userFactors.withColumnRenamed("id", "user_id_int").join(
        ids.users.withColumn("user_id_int", F.col("user_id_int").cast("int")), "user_id_int"
    )
    items = model.itemFactors.withColumnRenamed("id", "product_id_int").join(
        ids.products.withColumn("product_id_int", F.col("product_id_int").cast("int")),
        "product_id_int",
    )
    return (
        users.select("user_id", F.col("features").alias("u")),
        items.select("product_id", F.col("features").alias("p")),
    )


def implicit_loss(
    model: ALSModel, ids: IndexedPairs, reg: float = REGULARISATION, alpha: float = ALPHA
) -> float:
    """Weighted squared error over the observed pairs (confidence 1 + alpha * count)."""
    users = model.userFactors.select(F.col("id").alias("user_id_int"), F.col("features").alias("u"))
    items = model.itemFactors.select(
        F.col("id").alias("product_id_int"), F.col("features").alias("p")
    )
    error = F.lit(1.0) - dot(F.col("u"), F.col("p"))
    return (
        ids.pairs.join(users, "user_id_int")
        .join(items, "product_id_int")
        .agg(F.sum((1 + alpha * F.col("count")) * error * error))
        .first()[0]
    )

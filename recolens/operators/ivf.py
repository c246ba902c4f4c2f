"""Approximate nearest products through an inverted file: coarse centroids, one list of products each.

Every product is in the list of its nearest centroid, and lists are the partitions of the index table.
A query is compared with the products of the lists of its nearest centroids only; a join on the list
brings both together. The exact :func:`serve.similar_items` stays the default; :func:`recall` measures
an index against it.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, functions as F

from recolens.functions import scalars as S
from recolens.functions.vectors import l2_normalize
from recolens.operators import scoring
from recolens.operators.scoring import _merge, _OUT, _scorer

#: Products the centroids are fitted on, at most. All products are indexed.
SAMPLE_ROWS = 200_000
#: Most lists; their centroids travel with the tasks.
MOST_LISTS = 4096
PROBES = 8
LIST_ITEMS = 100_000  # products of a list that one task compares


@dataclass(frozen=True)
class Index:
    """``products``: (product_id, category, vec, list), unit vectors; ``centroids``: a row per list."""

    products: DataFrame
    centroids: np.ndarray


def _nearest(centroids: np.ndarray, probes: int):
    """Adds ``lists``, the numbers of the ``probes`` nearest centroids, to batches whose last column is vec."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column(batch.num_columns - 1)
            x = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float32).reshape(len(vec), -1)
            near = np.argsort(-(x @ centroids.T), axis=1, kind="stable")[:, :probes].astype(np.int32)
            ends = np.arange(0, near.size + 1, near.shape[1] if len(near) else 1, dtype=np.int32)[: len(vec) + 1]
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], [*batch.schema.names, "lists"])

    return run


def with_lists(df: DataFrame, centroids: np.ndarray, probes: int) -> DataFrame:
    """``df`` (with a column vec) and the lists to look into, nearest first."""
    rest = [c for c in df.columns if c != "vec"]
    df = df.select(*rest, F.col("vec").cast("array<float>").alias("vec")).where(F.col("vec").isNotNull())
    kinds = ", ".join(f"`{c}` {t}" for c, t in df.dtypes)
    return df.mapInArrow(_nearest(centroids, min(probes, len(centroids))), f"{kinds}, lists array<int>")


def build_index(products: DataFrame, n_lists: int | None = None, sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> Index:
    """An index of (product_id, p) and category where there is one. Products without vector are left out.

    The centroids are a k-means fit on about ``sample_rows`` products chosen by their ids. The number of
    lists is about the square root of the number of products by default.
    """
    has = products.columns
    unit = products.where(F.col("p").isNotNull()).select(
        "product_id",
        (F.col("category") if "category" in has else F.lit(None)).cast("string").alias("category"),
        l2_normalize(F.col("p")).cast("array<float>").alias("vec"),
    )
    total = unit.count()
    if not total:
        empty = unit.withColumn("list", F.lit(0))
        return Index(empty, np.zeros((1, 1), np.float32))
    n_lists = n_lists or max(1, min(MOST_LISTS, round(math.sqrt(total))))
    some = F.pmod(F.xxhash64("product_id"), F.lit(max(total, sample_rows))) < sample_rows
    sample = unit.where(some).select(array_to_vector("vec").alias("features")).repartition(8).cache()
    try:
        fitted = KMeans(k=min(n_lists, max(1, sample.count())), seed=seed, maxIter=15).fit(sample)
    finally:
        sample.unpersist()
    centroids = np.array(fitted.clusterCenters(), np.float32)
    centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
    listed = with_lists(unit, centroids, 1)
    return Index(listed.withColumn("list", F.col("lists")[0]).drop("lists"), centroids)


def write_index(index: Index, path: str) -> Index:
    """Write the lists as partitions, the centroids beside them; the index that reads them."""
    spark = index.products.sparkSession
    index.products.repartition("list").write.mode("overwrite").partitionBy("list").parquet(f"{path}/lists")
    rows = [(i, c.tolist()) for i, c in enumerate(index.centroids)]
    spark.createDataFrame(rows, "list int, vec array<float>").coalesce(1).write.mode("overwrite").parquet(f"{path}/centroids")
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> Index:
    rows = spark.read.parquet(f"{path}/centroids").orderBy("list").collect()  # at most MOST_LISTS
    return Index(spark.read.parquet(f"{path}/lists"), np.array([r.vec for r in rows], np.float32))


def similar_in_index(index: Index, wanted: DataFrame, n: int = 5, probes: int = PROBES, list_items: int = LIST_ITEMS) -> DataFrame:
    """About the cosine nearest products of the ``wanted`` (product_id, p), none of them itself.

    The columns are those of :func:`serve.similar_items`. Scores are exact, only products outside the
    probed lists are missed.
    """
    asked = wanted.where(F.col("p").isNotNull()).select(
        F.col("product_id").alias("query_id"), l2_normalize(F.col("p")).cast("array<float>").alias("vec")
    )
    probed = with_lists(asked, index.centroids, probes).select("query_id", "vec", F.explode("lists").alias("list"))
    size = {r.list: r["count"] for r in index.products.groupBy("list").count().collect()}
    load = {r.list: r["count"] for r in probed.groupBy("list").count().collect()}  # both at most MOST_LISTS
    most = max(1, scoring.OUT_ROWS // n)
    if not load or not size:
        return _similar(index.products.sparkSession.createDataFrame([], _OUT))
    parts = F.create_map(*[F.lit(x) for i, q in size.items() for x in (i, math.ceil(q / list_items))])
    blocks = F.create_map(*[F.lit(x) for i, q in load.items() for x in (i, math.ceil(q / most))])

    def every(count):
        return F.explode(F.sequence(F.lit(0), count - 1))

    def dealt(column, count):
        return F.pmod(F.xxhash64(column), count).cast("int")

    none = F.lit(None)
    left = probed.where(parts[F.col("list")].isNotNull()).select(
        "list", dealt("query_id", blocks[F.col("list")]).alias("block"), every(parts[F.col("list")]).alias("part"), "query_id",
        none.cast("string").alias("product_id"), none.cast("string").alias("category"), F.lit(n).cast("int").alias("n"), "vec",
    )
    right = index.products.where(blocks[F.col("list")].isNotNull()).select(
        "list", every(blocks[F.col("list")]).alias("block"), dealt("product_id", parts[F.col("list")]).alias("part"),
        "product_id", "category", none.cast("boolean").alias("is_cold"), "vec",
    )
    key = ["list", "block", "part"]
    return _similar(left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_scorer(True, False, None), _OUT))


def probes_for(index: Index, n: int = 5, target: float = 0.95, queries: int = 500) -> int:
    """The fewest lists to probe that hold a ``target`` share of the exact neighbours of about ``queries``
    products, chosen by their ids. How many that are depends on how far the vectors form clusters."""
    if not len(index.centroids):
        return 1
    total = index.products.count()
    some = index.products.where(F.pmod(F.xxhash64(F.lit(1), "product_id"), F.lit(max(total, queries))) < queries)
    some = some.select(F.col("product_id").alias("query_id"), "vec")
    items = index.products.select("product_id", "vec")
    exact = scoring.top_items(some, items, n, exclude_self=True).select("query_id", "product_id")
    order = with_lists(some, index.centroids, len(index.centroids)).select("query_id", "lists")
    place = (
        exact.join(index.products.select("product_id", "list"), "product_id").join(order, "query_id")
        .groupBy(F.array_position("lists", F.col("list")).alias("probes")).agg(F.count(F.lit(1)).alias("m"))
    )
    found, reached = sorted((r.probes, r.m) for r in place.collect()), 0  # at most a row a list
    for probes, m in found:
        reached += m
        if reached >= target * sum(x for _, x in found):
            return int(probes)
    return 1


def _similar(scored: DataFrame) -> DataFrame:
    return _merge(scored, False, None).select(
        F.col("query_id").alias("product_id"), F.col("product_id").alias("similar_id"), S.clip01(F.col("score")).alias("score"),
        "rank", "category",
    )


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row: queries, their exact neighbours, and the share of them that was found."""
    keys = ["product_id", "similar_id"]
    hits = found.select(*keys, F.lit(1).alias("hit"))
    return exact.select(*keys).join(hits, keys, "left").agg(
        F.countDistinct("product_id").alias("n_queries"), F.count(F.lit(1)).alias("n_neighbours"),
        F.avg(F.coalesce("hit", F.lit(0))).alias("recall"),
    )

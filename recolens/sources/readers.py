"""Sources: raw reviews and metadata per category, and the pipeline tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from recolens.schema import METADATA, REVIEWS, conform


def _read(spark: SparkSession, path: str, schema: T.StructType, fmt: str) -> DataFrame:
    if fmt == "parquet":
        # Parquet carries its own types; conform() casts and null-fills, and only the
        # columns it names are read.
        return spark.read.parquet(path)
    return spark.read.schema(schema).format(fmt).load(path)


def read_reviews(
    spark: SparkSession, path: str, category: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Raw reviews of one category (``path`` holds it) or of all (``path/category=...``).

    A source without the verified flag counts as unverified; an unknown flag in a source
    that has the column stays unknown.
    """
    raw = _read(spark, path, REVIEWS, fmt)
    if "verified_purchase" not in raw.columns:
        raw = raw.withColumn("verified_purchase", F.lit(False))
    if category is not None:
        raw = raw.withColumn("category", F.lit(category))
    with_category = T.StructType([*REVIEWS.fields, T.StructField("category", T.StringType())])
    return conform(raw, with_category, ("user_id", "asin", "category"))


def read_metadata(
    spark: SparkSession, path: str, category: str | None = None, fmt: str = "parquet"
) -> DataFrame:
    """Raw product metadata; the id is ``parent_asin`` when the source has it, else ``asin``."""
    raw = _read(spark, path, METADATA, fmt)
    ids = [F.col(c) for c in ("parent_asin", "asin") if c in raw.columns]
    if not ids:
        raise ValueError("metadata needs parent_asin or asin")
    raw = raw.withColumn("product_id", F.coalesce(*ids))
    if category is not None:
        raw = raw.withColumn("category", F.lit(category))
    fields = [f for f in METADATA.fields if f.name not in ("parent_asin", "asin")]
    target = T.StructType(
        [
            T.StructField("product_id", T.StringType()),
            T.StructField("category", T.StringType()),
            *fields,
        ]
    )
    return conform(raw, target, ("product_id", "category"))


def common_categories(
    reviews: DataFrame, metadata: DataFrame, limit: int | None = None
) -> DataFrame:
    """Categories present on both sides, in order, the first ``limit`` of them."""
    both = reviews.select("category").intersect(metadata.select("category")).orderBy("category")
    return both if limit is None else both.limit(limit)


def skip_done(todo: DataFrame, done: DataFrame, key: str = "category") -> DataFrame:
    """Rows of ``todo`` whose partition value is not already in ``done``."""
    return todo.join(done.select(key).distinct(), key, "left_anti")


def scan_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def scan_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Column-projected scan: only ``columns`` reach the Parquet reader."""
    return spark.read.parquet(path).select(*columns)


def category_filter(df: DataFrame, categories: Sequence[str] | None) -> DataFrame:
    """Optional IN-list on the partition column."""
    return df if categories is None else df.filter(F.col("category").isin(list(categories)))

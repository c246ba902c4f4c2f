"""Sinks. All are plain Parquet directories written by the tasks themselves."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from recolens.schema import FEEDBACK, IMPRESSIONS, conform

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("key", T.StringType(), False),
        T.StructField("value", T.StringType()),
    ]
)


def write_partitioned(
    df: DataFrame, path: str, by: str = "category", dynamic: bool = False
) -> None:
    """Hive-partitioned overwrite.

    ``dynamic`` replaces only the partitions present in ``df`` (incremental ingest). The
    rebalance sizes files through adaptive execution: a small partition gets one file and
    a partition holding most of the data is split over many tasks.
    """
    (
        df.hint("rebalance", F.col(by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
        .partitionBy(by)
        .parquet(path)
    )


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_id_maps(user_map: DataFrame, product_map: DataFrame, path: str) -> None:
    write_table(user_map.select("user_id_int", "user_id"), f"{path}/user_id_map")
    write_table(product_map.select("product_id_int", "product_id"), f"{path}/product_id_map")


def write_factors(user_factors: DataFrame, item_factors: DataFrame, path: str) -> None:
    write_table(user_factors.select("user_id", "u"), f"{path}/als_user_factors")
    write_table(item_factors.select("product_id", "p"), f"{path}/als_item_factors")


def write_embeddings(embeddings: DataFrame, path: str) -> None:
    write_table(
        embeddings.select("product_id", F.col("embedding").cast("array<float>")), path
    )


def append_feedback(feedback: DataFrame, path: str) -> None:
    conform(feedback, FEEDBACK, tuple(FEEDBACK.names[:-1])).write.mode("append").parquet(path)


def append_impressions(impressions: DataFrame, path: str) -> None:
    conform(impressions, IMPRESSIONS, ("user_id", "ab_variant")).write.mode("append").parquet(
        path
    )


def run_rows(
    spark: SparkSession, run_id: str, params: Mapping, metrics: Mapping, tags: Mapping = {}
) -> DataFrame:
    """One experiment run as (run_id, kind, key, value) rows."""
    rows = [
        (run_id, kind, str(k), str(v))
        for kind, values in (("param", params), ("metric", metrics), ("tag", tags))
        for k, v in values.items()
    ]
    return spark.createDataFrame(rows, RUNS)


def append_run(
    spark: SparkSession, path: str, run_id: str, params: Mapping, metrics: Mapping,
    tags: Mapping = {},
) -> None:
    run_rows(spark, run_id, params, metrics, tags).coalesce(1).write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUNS).parquet(path)

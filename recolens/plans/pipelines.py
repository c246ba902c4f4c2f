"""The pipelines end to end over a folder of tables. Each step reads and writes tables, so
a lost executor costs at most the running step and later steps never recompute earlier ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from recolens.operators import (
    als, bridge as br, bronze, cold_start, content, drift, eda, evaluate, features, fuse, gold,
    quality, serve, silver, skew,
)
from recolens.sources import readers, writers


def _at(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def run_bronze(
    spark: SparkSession, reviews: str, metadata: str, base: str, limit: int | None = None
) -> None:
    """Ingest the categories both sources have and the tables do not; rebuild users."""
    raw, meta = readers.read_reviews(spark, reviews), readers.read_metadata(spark, metadata)
    todo = readers.common_categories(raw, meta, limit)

    def ingest(source: DataFrame, table: str, build) -> None:
        path = _at(base, table)
        wanted = todo
        if _exists(spark, path):
            wanted = readers.skip_done(todo, spark.read.parquet(path))
        # Category names are a closed list of partition values.
        names = [r.category for r in wanted.collect()]
        if names:
            rows = readers.category_filter(source, names)
            writers.write_partitioned(build(rows), path, "category", dynamic=True)

    ingest(raw, "interactions", bronze.bronze_interactions)
    ingest(meta, "products", bronze.bronze_products)
    interactions = readers.scan_table(spark, _at(base, "interactions"))
    writers.write_table(bronze.user_profile(interactions), _at(base, "users"))


def run_silver(spark: SparkSession, base: str) -> DataFrame:
    """Silver table in one pass; returns the one-row layer counts."""
    source = readers.scan_table(spark, _at(base, "interactions"))
    users = readers.scan_columns(spark, _at(base, "users"), ["user_id", "total_interactions"])
    result, seen_in, seen_out = silver.with_layer_counts(
        source, lambda rows: silver.silver_interactions(rows, users)
    )
    writers.write_partitioned(result, _at(base, "silver", "interactions"))
    n_in, n_out = seen_in.get["rows"], seen_out.get["rows"]
    return spark.createDataFrame(
        [(n_in, n_out, n_in - n_out)], "n_before long, n_after long, n_removed long"
    )


def run_gold(spark: SparkSession, base: str) -> None:
    rows = readers.scan_table(spark, _at(base, "silver", "interactions"))
    products = readers.scan_table(spark, _at(base, "products"))
    path = _at(base, "gold", "products")
    writers.write_table(gold.gold_products(rows, products), path)
    stats = gold.popularity_score(gold.product_stats(rows))
    stats_path = _at(base, "gold", "product_stats")
    writers.write_table(stats, stats_path)
    features = readers.scan_table(spark, stats_path)
    writers.write_partitioned(
        gold.gold_interactions(rows, features), _at(base, "gold", "interactions")
    )


def run_quality(spark: SparkSession, base: str, mode: str = "report") -> DataFrame:
    return quality.dq_summary(
        quality.dq_interactions(readers.scan_table(spark, _at(base, "interactions"))),
        quality.dq_gold_products(readers.scan_table(spark, _at(base, "gold", "products"))),
        mode=mode,
    )


def run_drift(spark: SparkSession, base: str) -> DataFrame:
    rows = readers.scan_columns(spark, _at(base, "interactions"), ["year_month", "converted"])
    path = _at(base, "drift_report")
    writers.write_table(drift.drift_ks(rows), path)
    return spark.read.parquet(path)


def run_train(
    spark: SparkSession, base: str, categories: Sequence[str] | None = None,
    rank: int = als.RANK, iterations: int = als.ITERATIONS, reg: float = als.REGULARISATION,
    run_id: str = "als_default", weighted: bool = False,
) -> None:
    """Support filter, id maps, implicit fit, factors, and the run's record.

    The signal is the number of rows per pair, or with ``weighted`` their sum weighted by
    helpful votes and purchases.
    """
    rows = readers.category_filter(readers.scan_table(spark, _at(base, "interactions")), categories)
    pairs_path = _at(base, "als_pairs")
    kept = cold_start.min_support_filter(rows)
    if weighted:
        pairs = features.weighted_pair_counts(kept).withColumnRenamed("weight", "count")
    else:
        pairs = cold_start.pair_counts(kept)
    writers.write_table(pairs, pairs_path)
    ids = als.index_ids(spark.read.parquet(pairs_path))
    maps = _at(base, "id_mappings")
    writers.write_id_maps(ids.users, ids.products, maps)
    model = als.als_fit(ids.pairs, rank, iterations, reg)
    users, items = als.als_factors(model, ids)
    writers.write_factors(users, items, base)
    writers.append_run(
        spark,
        _at(base, "runs", "als_training"),
        run_id,
        {"rank": rank, "iterations": iterations, "regularization": reg,
         "min_interactions": cold_start.S.MIN_INTERACTIONS, "weighted": weighted},
        {"n_users": ids.users.count(), "n_items": ids.products.count(),
         "nnz": spark.read.parquet(pairs_path).count()},
        {"model_stage": "Production"},
    )


def run_embeddings(spark: SparkSession, base: str, encoder=None) -> None:
    products = readers.scan_table(spark, _at(base, "products"))
    vectors = content.content_embed(content.build_corpus(products), encoder=encoder)
    writers.write_embeddings(vectors, _at(base, "content_embeddings"))


def run_bridge(
    spark: SparkSession, base: str, skip_train: bool = False, fit=br.mlp_fit
) -> DataFrame:
    """Train or reload the bridge, fuse products and users, return the summary.

    The fused tables have folders of their own, so a rerun never reads its own output.
    """
    interactions = readers.scan_table(spark, _at(base, "interactions"))
    als_items = readers.scan_table(spark, _at(base, "als_item_factors"))
    als_users = readers.scan_table(spark, _at(base, "als_user_factors"))
    embeddings = readers.scan_table(spark, _at(base, "content_embeddings"))
    model_path = _at(base, "bridge_model")
    if skip_train and _exists(spark, model_path):
        model = br.load_bridge(spark, model_path)
    else:
        warm = cold_start.warm_ids(interactions, "product_id")
        model = fit(br.bridge_training_set(als_items, embeddings, warm))
        br.save_bridge(spark, model, model_path)
    products = readers.scan_table(spark, _at(base, "products"))
    uncovered = embeddings.join(skew.by_shuffle(als_items.select("product_id")), "product_id", "left_anti")
    fused_path = _at(base, "fused", "products")
    writers.write_table(
        fuse.fuse_products(products, als_items, br.bridge_predict(uncovered, model), interactions),
        fused_path,
    )
    fused = spark.read.parquet(fused_path)
    users_path = _at(base, "fused", "users")
    users = readers.scan_table(spark, _at(base, "users"))
    writers.write_table(fuse.fuse_users(users, als_users, interactions, fused), users_path)
    return fuse.fusion_summary(fused, spark.read.parquet(users_path))


def run_batch_recs(spark: SparkSession, base: str, k: int = 10) -> DataFrame:
    users = readers.scan_table(spark, _at(base, "fused", "users"))
    products = readers.scan_table(spark, _at(base, "fused", "products"))
    path = _at(base, "gold", "recommendations")
    writers.write_table(serve.batch_recommend(users, products, k), path)
    return serve.recs_summary(spark.read.parquet(path))


def run_grid(spark: SparkSession, base: str, **grid) -> DataFrame:
    """Grid search; the runs are appended to the log and the best one returned."""
    rows = readers.scan_table(spark, _at(base, "interactions"))
    runs = evaluate.grid_search(rows, **grid)
    runs.coalesce(1).write.mode("append").parquet(_at(base, "runs", "als_grid_search"))
    return evaluate.best_run(runs)


def run_cold_start(spark: SparkSession, base: str, k: int = 10) -> tuple[DataFrame, DataFrame]:
    rows = readers.scan_columns(
        spark, _at(base, "interactions"), ["user_id", "product_id", "category"]
    )
    return cold_start.cold_start_report(rows), cold_start.popularity_by_category(rows, k)


def run_eda(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    rows = readers.scan_table(spark, _at(base, "interactions"))
    products = readers.scan_table(spark, _at(base, "products"))
    users = eda.active_users(readers.scan_table(spark, _at(base, "users")), rows)
    return {
        "sparsity": eda.sparsity(rows, users, products),
        "interaction_types": eda.interaction_type_share(rows),
        "helpful": eda.helpful_stats(rows),
        "ratings": eda.rating_distribution(rows),
        "rating_stats": eda.rating_stats(rows),
        "categories": eda.category_share(rows),
        "top_categories": eda.category_share(rows, eda.TOP_CATEGORIES),
        "long_tail_products": eda.long_tail(rows, "product_id", products),
        "long_tail_users": eda.long_tail(rows, "user_id", users),
        "segments": eda.segment_stats(users),
        "purchases_by_segment": eda.purchases_by_segment(rows, users),
        "months": eda.monthly_volume(rows),
        "embedding_means": eda.embedding_means(products),
        "recap": eda.eda_recap(rows, users, products),
    }

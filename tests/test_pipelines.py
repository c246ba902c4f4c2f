"""All pipelines in order over one folder of tables, and reruns."""

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from recolens.operators import bridge as br
from recolens.plans import pipelines as pl
from recolens.sources import writers


@pytest.fixture(scope="module")
def base(spark, lake, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("lake"))
    writers.write_partitioned(lake.reviews(), f"{root}/raw/reviews")
    # New products that nobody has rated yet, so that cold paths run.
    new = lake.metadata().filter("product_id in ('P1', 'P2', 'P3', 'P4', 'P5', 'P6', 'P7')").withColumn(
        "product_id", F.concat(F.lit("NEW"), "product_id")
    )
    catalogue = lake.metadata().unionByName(new)
    writers.write_partitioned(
        catalogue.withColumnRenamed("product_id", "parent_asin"), f"{root}/raw/meta"
    )
    pl.run_bronze(spark, f"{root}/raw/reviews", f"{root}/raw/meta", f"{root}/t", limit=5)
    return f"{root}/t"


def test_bronze_rerun_skips_what_is_there(spark, lake, base):
    rows = spark.read.parquet(f"{base}/interactions")
    assert rows.select("category").distinct().count() == 5
    before = rows_of(rows)
    raw = base[: -len("/t")] + "/raw"
    pl.run_bronze(spark, f"{raw}/reviews", f"{raw}/meta", base, limit=5)
    assert rows_of(spark.read.parquet(f"{base}/interactions")) == before
    pl.run_bronze(spark, f"{raw}/reviews", f"{raw}/meta", base)
    assert rows_of(spark.read.parquet(f"{base}/interactions")) == rows_of(lake.interactions())
    assert rows_of(spark.read.parquet(f"{base}/users")) == rows_of(lake.users())


@pytest.mark.parametrize("hot_rows", [2_000_000, 8])
def test_silver_finds_heavy_users_in_the_users_table(spark, lake, base, conf, hot_rows):
    expected = rows_of(lake.silver())
    conf("spark.recolens.hotKeyRows", hot_rows)
    counts = pl.run_silver(spark, base).first()
    assert rows_of(spark.read.parquet(f"{base}/silver/interactions")) == expected
    assert counts.n_before == lake.interactions().count()
    assert counts.n_after == len(expected)


def test_silver_gold_quality_drift(spark, lake, base):
    counts = pl.run_silver(spark, base).first()
    assert counts.n_before - counts.n_after == counts.n_removed > 0
    pl.run_gold(spark, base)
    gold = spark.read.parquet(f"{base}/gold/products")
    assert rows_of(gold.filter("product_id not like 'NEW%'")) == rows_of(lake.gold_products())
    assert {r.is_cold for r in gold.filter("product_id like 'NEW%'").collect()} == {True}
    assert spark.read.parquet(f"{base}/gold/interactions").count() == counts.n_after
    summary = {r.table_name: (r.passed, r.total) for r in pl.run_quality(spark, base).collect()}
    assert summary["gold_products"] == (3, 3)
    assert pl.run_drift(spark, base).count() >= 0


def test_train_bridge_recommend(spark, base):
    pl.run_train(spark, base, iterations=1, run_id="weighted", weighted=True)
    weights = spark.read.parquet(f"{base}/als_pairs")
    assert dict(weights.dtypes)["count"] == "double" and weights.filter("count < 1").isEmpty()
    pl.run_train(spark, base, iterations=3)
    log = {(r.kind, r.key): r.value for r in writers.read_runs(spark, f"{base}/runs/als_training").filter("run_id = 'als_default'").collect()}
    assert log[("param", "rank")] == "16" and int(log[("metric", "nnz")]) > 0
    pl.run_embeddings(spark, base)
    first = rows_of(pl.run_bridge(spark, base, fit=br.ridge_fit))
    assert rows_of(pl.run_bridge(spark, base, skip_train=True)) == first
    fused = spark.read.parquet(f"{base}/fused/products")
    factors = spark.read.parquet(f"{base}/als_item_factors").withColumnRenamed("p", "q")
    assert fused.join(factors, "product_id").filter(F.col("p") != F.col("q")).isEmpty()
    assert {r.vector_source for r in fused.select("vector_source").distinct().collect()} == {"als", "bridge"}
    done = pl.run_batch_recs(spark, base, 5).first()
    assert done.n_recommendations == 5 * spark.read.parquet(f"{base}/fused/users").count()


def test_cold_start_and_eda(spark, base):
    report, popular = pl.run_cold_start(spark, base)
    assert {r.entity for r in report.collect()} == {"products", "users"}
    assert popular.filter("rank = 1").count() == 6
    for name, result in pl.run_eda(spark, base).items():
        assert not result.isEmpty(), name


def test_grid_logs_its_runs(spark, base):
    best = pl.run_grid(spark, base, ranks=(4,), regs=(0.1, 0.5), iterations=(2,), sample_users=40)
    assert best.first().model_stage == "Production"
    runs = writers.read_runs(spark, f"{base}/runs/als_grid_search")
    assert runs.select("run_id").distinct().count() == 2

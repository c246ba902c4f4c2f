"""Bronze, silver, gold, readers, writers and statistics on small tables and the test lake."""

import pytest
from pyspark.sql import functions as F

from helpers import plan_of, rows_of
from recolens.functions import scalars as S
from recolens.operators import bronze, eda, features, gold, silver
from recolens.schema import INTERACTIONS, conform
from recolens.sources import readers, writers


def test_year_month_is_null_outside_the_range(spark):
    df = spark.createDataFrame(
        [(1_588_687_728_923,), (None,), (10**18,), (-(10**18),), (0,)], "t long"
    )
    months = [r.m for r in df.select(S.year_month(F.col("t")).alias("m")).collect()]
    assert months == ["2020-05", None, None, None, "1970-01"]


def test_unknown_flag_gives_unknown_type_and_no_conversion(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "v boolean")
    kind = S.interaction_type(F.col("v"))
    got = [tuple(r) for r in df.select(kind, S.converted(kind)).collect()]
    assert got == [("purchase", 1), ("review", 0), (None, 0)]


def test_clamp_keeps_null(spark):
    df = spark.createDataFrame([(-1.0,), (6.0,), (3.5,), (None,)], "r double")
    assert [r[0] for r in df.select(S.clamp_rating(F.col("r"))).collect()] == [0.0, 5.0, 3.5, None]


def test_corpus_text(spark):
    df = spark.createDataFrame(
        [("a", ["x", "y"]), (None, ["x"]), ("a", []), ("a", None), (None, None)],
        "t string, d array<string>",
    )
    got = [r[0] for r in df.select(S.corpus_text(F.col("t"), F.col("d"))).collect()]
    assert got == ["a x", "x", "a", "a", ""]


def test_conform_fills_optional_and_refuses_missing_required(spark):
    df = spark.createDataFrame([("u", "p", "c", 1)], "user_id string, product_id string, category string, extra int")
    out = conform(df, INTERACTIONS, ("user_id",))
    assert out.columns == INTERACTIONS.names and out.first().rating is None
    with pytest.raises(ValueError, match="asin"):
        conform(df, INTERACTIONS, ("asin",))


def test_readers_default_the_flag_and_choose_the_id(spark, tmp_path):
    raw = spark.createDataFrame([("u", "a1", 4.0, 1)], "user_id string, asin string, rating double, timestamp long")
    raw.write.parquet(f"{tmp_path}/r")
    rows = readers.read_reviews(spark, f"{tmp_path}/r", "Toys")
    assert rows.first().verified_purchase is False and rows.first().category == "Toys"
    spark.createDataFrame([("a1", None, "t"), ("a2", "p2", "t")], "asin string, parent_asin string, title string").write.json(f"{tmp_path}/m")
    meta = readers.read_metadata(spark, f"{tmp_path}/m", "Toys", fmt="json")
    assert {r.product_id for r in meta.collect()} == {"a1", "p2"}


def test_incremental_ingest_keeps_other_partitions(spark, lake, tmp_path):
    path = f"{tmp_path}/t"
    rows = lake.interactions()
    writers.write_partitioned(readers.category_filter(rows, ["SMALL"]), path)
    todo = readers.skip_done(rows, spark.read.parquet(path))
    assert todo.filter("category = 'SMALL'").isEmpty()
    writers.write_partitioned(todo, path, dynamic=True)
    assert rows_of(spark.read.parquet(path)) == rows_of(rows)


def test_segments_use_interpolated_cuts_and_include_ties(spark):
    users = spark.createDataFrame([(f"u{i}", n) for i, n in enumerate([1, 2, 3, 4, 10])], "user_id string, total_purchases long")
    cuts = bronze.purchase_quantiles(users).first()
    assert cuts.p50 == 3.0 and abs(cuts.p90 - 7.6) < 1e-9
    got = {r.user_id: r.segment for r in bronze.with_segment(users).collect()}
    assert got == {"u0": "casual_user", "u1": "casual_user", "u2": "regular_user", "u3": "regular_user", "u4": "power_user"}


def test_average_of_category_averages(spark):
    rows = spark.createDataFrame(
        [("u", "p", 5.0, 1, "A"), ("u", "p", 5.0, 1, "A"), ("u", "p", 2.0, 0, "B")],
        "user_id string, product_id string, rating double, converted int, category string",
    )
    u = bronze.user_profile(rows).first()
    assert (u.avg_rating, u.avg_rating_weighted, u.total_interactions, u.total_purchases) == (3.5, 4.0, 3, 2)


def test_silver_uses_one_exchange_for_dedup_and_ranks(lake):
    path = lake.scratch("interactions")
    writers.write_table(lake.interactions(), path)
    plan = plan_of(silver.silver_interactions(readers.scan_table(lake.spark, path)))
    tree = plan.split("\n\n")[0]
    assert tree.count("Exchange") == 1 and tree.count("Sort (") == 1, tree


def test_dedup_limits_rows_before_the_shuffle(lake):
    plan = plan_of(silver.dedup_interactions(silver.drop_null_keys(lake.interactions())))
    assert plan.count("WindowGroupLimit") >= 2


def test_popularity_reuses_the_statistics_exchange(spark, lake, tmp_path):
    writers.write_table(lake.silver(), f"{tmp_path}/s")
    scored = gold.popularity_score(gold.product_stats(readers.scan_table(spark, f"{tmp_path}/s")))
    scored.collect()
    assert "ReusedExchange" in plan_of(scored)


def test_pushdown_pruning_and_partition_filters(spark, lake, tmp_path):
    path = f"{tmp_path}/i"
    writers.write_partitioned(lake.interactions(), path)
    scan = plan_of(readers.scan_columns(spark, path, ["year_month", "converted"]).filter("year_month = '1998-03'"))
    assert "ReadSchema: struct<converted:int,year_month:string>" in scan
    assert "EqualTo(year_month,1998-03)" in scan
    pruned = plan_of(readers.category_filter(spark.read.parquet(path), ["SMALL"]))
    assert "PartitionFilters: [isnotnull(category" in pruned


def test_join_strategies(lake, conf):
    rows = lake.interactions().select("product_id", "rating")
    products = lake.products().select("product_id", "title")
    assert "SortMergeJoin" in plan_of(gold.join_sortmerge(rows, products))
    assert "BroadcastHashJoin" in plan_of(gold.join_broadcast(rows, products))
    conf("spark.recolens.broadcastRows", 10)
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    assert "BroadcastHashJoin" not in plan_of(gold.join_broadcast(rows, products))


def test_orphans(spark):
    rows = spark.createDataFrame([("p1",), ("p1",), ("x",), (None,)], "product_id string")
    got = gold.orphan_rate(rows, spark.createDataFrame([("p1",), ("p2",)], "product_id string")).first()
    assert tuple(got) == (2, 4, 0.5)


def test_empty_tables_do_not_fail(spark, lake):
    empty = lake.interactions().limit(0)
    assert eda.sparsity(empty, lake.users().limit(0), lake.products().limit(0)).first().sparsity_pct is None
    assert silver.silver_interactions(empty).count() == 0
    assert eda.eda_recap(lake.interactions(), lake.users(), lake.products()).count() == 1


def test_median_month_takes_the_later_middle(spark):
    def months(*m):
        return spark.createDataFrame([(x,) for x in m], "year_month string")

    assert eda.median_month(months("2020-01", "2020-02", "2020-03", "NaT")).first()[0] == "2020-02"
    assert eda.median_month(months("2020-01", "2020-02")).first()[0] == "2020-02"


def test_entropy_and_main_category(spark):
    rows = spark.createDataFrame(
        [("u", "B"), ("u", "A"), ("v", "A"), ("v", "A")], "user_id string, category string"
    )
    got = {r.user_id: (r.nb_categories, r.main_category, r.diversity_index) for r in features.user_diversity(rows).collect()}
    assert got == {"u": (2, "A", 1.0), "v": (1, "A", 0.0)}


def test_cadence_counts_same_day_purchases_as_zero_gaps(spark):
    day = 86_400_000
    rows = spark.createDataFrame(
        [("u", 0, "purchase"), ("u", 5, "purchase"), ("u", 10 * day, "purchase"), ("u", 3 * day, "review"), ("v", 0, "purchase")],
        "user_id string, timestamp long, interaction_type string",
    )
    got = {r.user_id: r for r in features.user_cadence(rows, "1970-01-21").collect()}
    assert got["u"].avg_days_between == 5.0 and got["u"].last_purchase_days_ago == 10
    assert abs(got["u"].regularity_score - 2**0.5) < 1e-9  # gaps 0 and 10
    assert got["v"].avg_days_between is None and got["v"].regularity_score is None


@pytest.mark.parametrize("hot_rows", [2_000_000, 60])
def test_layer_counts_come_from_the_run_itself(lake, tmp_path, conf, hot_rows):
    conf("spark.recolens.hotKeyRows", hot_rows)
    rows = lake.interactions()
    result, seen_in, seen_out = silver.with_layer_counts(rows, silver.silver_interactions)
    writers.write_table(result, f"{tmp_path}/silver")
    assert (seen_in.get["rows"], seen_out.get["rows"]) == (6116, 5897)

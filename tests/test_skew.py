"""The paths for groups larger than a task give exactly what one window gives."""

import random

from pyspark.sql import Window, functions as F

from helpers import plan_of, rows_of
from recolens.operators import drift, evaluate, scoring, service, silver, skew


def hot_interactions(spark):
    """One user with half of the rows (many at one instant), one exact copy repeated often."""
    rnd = random.Random(7)
    rows = [
        ("U_hot", f"P{rnd.randrange(400)}", float(rnd.randrange(-1, 7)), 1_000_000_000_000
         + 86_400_000 * (rnd.randrange(4) if i % 2 else 2), "purchase", 1, "2001-09",
         rnd.randrange(5), "A")
        for i in range(1500)
    ]
    rows += [("U_copy", "P1", 3.0, 1_000_000_000_000, "review", 0, "2001-09", 1, "B")] * 700
    rows += [
        (f"U{rnd.randrange(40)}", f"P{rnd.randrange(50)}", 4.0,
         1_000_000_000_000 + rnd.randrange(10) * 86_400_000, "purchase", 1, "2001-09", 0, "A")
        for _ in range(800)
    ]
    rows += [(None, "P1", 1.0, 1, "review", 0, "1970-01", 0, "A"), ("U1", None, 1.0, 1, "review", 0, "1970-01", 0, "A")]
    rnd.shuffle(rows)
    return spark.createDataFrame(
        rows,
        "user_id string, product_id string, rating double, timestamp long, interaction_type string,"
        " converted int, year_month string, helpful_vote long, category string",
    ).repartition(6)


def test_silver_same_with_and_without_hot_users(spark, conf):
    rows = hot_interactions(spark)
    plain = silver.silver_interactions(rows)
    assert "rangepartitioning" not in plan_of(plain)
    expected = rows_of(plain)
    conf("spark.recolens.hotKeyRows", 100)
    spread = silver.silver_interactions(rows)
    assert rows_of(spread) == expected
    copies = [r for r in spread.filter("user_id = 'U_copy'").collect()]
    assert len(copies) == 1 and copies[0].recency_rank == 1


def test_hot_user_is_cut_into_several_pieces(spark, conf):
    conf("spark.sql.adaptive.enabled", "false")
    rows = silver.dedup_interactions(silver.drop_null_keys(hot_interactions(spark)))
    order = [F.col("user_id"), *silver.recency_order()]
    placed = skew._pieces(rows.filter("user_id = 'U_hot'"), order)
    sizes = [r["count"] for r in placed.groupBy("__piece").count().collect()]
    assert len(sizes) > 1 and max(sizes) < sum(sizes) * 0.6


def test_split_same_with_and_without_hot_users(spark, conf):
    rows = hot_interactions(spark)
    expected = rows_of(evaluate.split_train_test(rows))
    conf("spark.recolens.hotKeyRows", 100)
    assert rows_of(evaluate.split_train_test(rows)) == expected


def test_running_sums_same_when_spread(spark, conf):
    rnd = random.Random(3)
    points = spark.createDataFrame(
        [("big", float(i), rnd.randrange(9)) for i in range(900)]
        + [(f"k{i % 5}", float(i), rnd.randrange(9)) for i in range(50)],
        "g string, x double, n long",
    )
    w = Window.partitionBy("g").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    expected = rows_of(points.withColumn("upto", F.sum("n").over(w)))
    assert rows_of(skew.running_sums(points, ["g"], "x", {"upto": "n"})) == expected
    conf("spark.recolens.hotKeyRows", 60)
    assert rows_of(skew.running_sums(points, ["g"], "x", {"upto": "n"})) == expected


def test_drift_and_latency_same_when_spread(spark, conf, lake):
    rows = lake.interactions()
    requests = lake.requests()
    numeric = rows_of(drift.drift_ks_numeric(rows, "rating"))
    # one day in one window: a hot window with many distinct latencies
    daily = rows_of(service.latency_p95(requests, "30 days"))
    conf("spark.recolens.hotKeyRows", 5)
    assert rows_of(drift.drift_ks_numeric(rows, "rating")) == numeric
    assert rows_of(service.latency_p95(requests, "30 days")) == daily


def test_dense_index_is_the_sorted_position(spark):
    ids = [f"id{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(i,) for i in ids + ids[:100]] + [(None,)], "k string").repartition(7)
    got = {r.k: r.n for r in skew.dense_index(df, "k", "n").collect()}
    assert got == {k: i for i, k in enumerate(ids)}


def test_broadcast_only_within_the_bound(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", -1)
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", -1)
    big = spark.range(1000).withColumnRenamed("id", "k")
    small = spark.range(50).withColumnRenamed("id", "k")
    assert "BroadcastHashJoin" in plan_of(big.join(skew.broadcast_if_small(small, 50), "k"))
    assert "SortMergeJoin" in plan_of(big.join(skew.broadcast_if_small(small, 49), "k"))


def test_hot_keys_none_when_all_are_ordinary(spark):
    assert skew.hot_keys(spark.range(100).withColumnRenamed("id", "k"), ["k"]) is None


def _brute(queries, items, k, masked, limits=None):
    out = set()
    for q, v in queries:
        s = [
            (-round(sum(a * b for a, b in zip(v, w)), 6), p)
            for p, w in items
            if (q, p) not in masked
        ]
        n = k if limits is None else limits[q]
        out |= {(q, p, i + 1) for i, (_, p) in enumerate(sorted(s)[:n])}
    return out


def test_top_items_equals_brute_force_over_any_blocking(spark):
    rnd = random.Random(5)

    def vec():
        return [float(rnd.randrange(-2, 3)) for _ in range(4)]  # many ties

    items = [(f"p{i:04d}", vec()) for i in range(1100)]  # enough for column groups
    queries = [(f"q{i:02d}", vec()) for i in range(25)]
    masked = {(f"q{rnd.randrange(25):02d}", f"p{rnd.randrange(1100):04d}") for _ in range(4000)}
    masked |= {("q00", p) for p, _ in items[:1097]}  # fewer candidates than k
    masked |= {("q01", p) for p, _ in items}  # none
    q = spark.createDataFrame(queries, "query_id string, vec array<float>")
    i = spark.createDataFrame(items, "product_id string, vec array<float>")
    m = spark.createDataFrame(list(masked) * 2, "query_id string, product_id string")
    expected = _brute(queries, items, 7, masked)
    for blocks in ({}, {"query_block": 4}, {"item_block": 90}, {"query_block": 6, "item_block": 600}):
        got = scoring.top_items(q, i, 7, masked=m, with_range=True, **blocks).collect()
        assert {(r.query_id, r.product_id, r.rank) for r in got} == expected, blocks
        one = {r.query_id: (r.low, r.high, r.candidates) for r in got}
        free = sum(("q00", p) not in masked for p, _ in items)
        assert "q01" not in one and one["q00"][2] == free < 7
        for query, v in queries[2:4]:
            scores = [
                round(sum(a * b for a, b in zip(v, w)), 6) for p, w in items if (query, p) not in masked
            ]
            assert one[query] == (min(scores), max(scores), len(scores))


def test_top_items_limits_and_categories_per_query(spark):
    q = spark.createDataFrame(
        [("a", [1.0], 1, "x"), ("b", [1.0], 5, "y"), ("c", [-1.0], 2, None), ("d", [1.0], 3, "none")],
        "query_id string, vec array<float>, n int, category string",
    )
    i = spark.createDataFrame(
        [("p1", [3.0], "x"), ("p2", [2.0], "x"), ("p3", [9.0], "y"), ("p4", [1.0], None)],
        "product_id string, vec array<float>, category string",
    )
    for blocks in ({}, {"item_block": 1}):
        got = {(r.query_id, r.product_id, r.rank) for r in scoring.top_items(q, i, **blocks).collect()}
        assert got == {("a", "p1", 1), ("b", "p3", 1), ("c", "p4", 1), ("c", "p2", 2)}


def test_top_items_very_large_scores_stay_exact(spark):
    q = spark.createDataFrame([("a", [1e12])], "query_id string, vec array<float>")
    i = spark.createDataFrame(
        [("p1", [3e6]), ("p2", [3e6]), ("p0", [-1.0]), ("p3", [4e6])],
        "product_id string, vec array<float>",
    )
    got = [r.product_id for r in scoring.top_items(q, i, 3).orderBy("rank").collect()]
    assert got == ["p3", "p1", "p2"]

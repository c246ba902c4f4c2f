"""Recommendation, similarity and fallback behaviour on the small stall of conftest."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recolens.functions import vectors
from recolens.operators import cold_start, quality, scoring, serve


def run(shop, *requests):
    return serve.recommend(
        shop.requests(*requests), shop.users, shop.products, shop.popular, shop.seen
    )


def raw_scores(shop, user):
    """{product_id: inner product} of one user."""
    return dict(zip(shop.ids, (shop.p.astype(float) @ shop.u[shop.names.index(user)]).tolist()))


def best(scores, n=None):
    """Ids by falling score, ties to the smaller id."""
    return sorted(scores, key=lambda i: (-round(scores[i], 6), i))[:n]


@pytest.mark.parametrize("user", ["ann", "bob", "cyd"])
def test_known_users_get_their_best_products_scaled(shop, user):
    rows = run(shop, (user, 6, None, False)).orderBy("rank").collect()
    scores = raw_scores(shop, user)
    assert [r["rank"] for r in rows] == list(range(1, 7))
    assert [r.product_id for r in rows] == best(scores, 6)
    low, high = min(scores.values()), max(scores.values())
    assert np.allclose([r.score for r in rows], [(scores[r.product_id] - low) / (high - low + 1e-8) for r in rows], atol=1e-6)
    assert all(r.source == ("bridge" if r.product_id in shop.late else "als") and not r.is_cold_user for r in rows)
    assert all(r.category == (shop.kinds[r.product_id] or "") for r in rows)


def test_twins_tie_and_the_smaller_id_wins(shop):
    rows = {r.product_id: r for r in run(shop, ("bob", 8, None, False)).collect()}
    assert rows["m1"].score == rows["m2"].score and rows["m2"]["rank"] == rows["m1"]["rank"] + 1


def test_response_carries_segment_and_ranked_items(shop):
    recs = run(shop, ("cyd", 2, None, False), ("stranger", 3, None, True))
    rows = {r.user_id: r for r in serve.recommend_response(recs, shop.users).collect()}
    assert (rows["cyd"].segment, rows["stranger"].segment) == ("regular_user", "casual_user")
    assert [i["rank"] for i in rows["cyd"].recommendations] == [1, 2]
    assert [i["product_id"] for i in rows["stranger"].recommendations] == ["m2", "c1", "m1"]


def test_strangers_get_the_popular_list_of_their_scope(shop):
    rows = run(shop, ("s1", 2, None, False), ("s2", 9, "cups", False), ("s3", 9, "rugs", False)).collect()
    got = {}
    for r in sorted(rows, key=lambda r: r["rank"]):
        got.setdefault(r.user_id, []).append((r.product_id, r.score))
    assert got == {"s1": [("m2", 1.0), ("c1", 0.5)], "s2": [("c1", 1.0), ("c3", 0.5)]}
    assert all(r.source == "popular" and r.is_cold_user for r in rows)


def test_seen_products_and_categories_filter_before_ranking(shop):
    rows = run(shop, ("ann", 9, None, True), ("ann", 9, "mats", True), ("ann", 9, None, False), ("ann", 9, "rugs", False)).collect()
    ids = {k: {r.product_id for r in rows if r.request_id == k} for k in ("R0", "R1", "R2", "R3")}
    assert ids == {"R0": set(shop.ids) - {"m1", "c2"}, "R1": {"m2", "m3"}, "R2": set(shop.ids), "R3": set()}


@pytest.mark.parametrize("n", [-1, 0, 101, None])
def test_refused_requests_come_back_with_a_reason(shop, n):
    asked = shop.requests(("bob", n, None, False), ("bob", 1, None, False))
    assert serve.recommend(asked, shop.users, shop.products, shop.popular, shop.seen).count() == 1
    refused = serve.rejected_requests(asked, serve.RECOMMEND_LIMITS).collect()
    assert [(r.request_id, r.reason) for r in refused] == [("R0", "n outside 1..100")]


def test_similar_products_leave_out_the_product_itself(shop):
    rows = serve.similar_items(shop.products, 4).collect()
    assert len(rows) == 4 * len(shop.ids) and all(r.product_id != r.similar_id for r in rows)
    length = np.linalg.norm(shop.p, axis=1, keepdims=True)
    unit = np.divide(shop.p, length, out=np.zeros_like(shop.p), where=length > 0).astype(float)
    for i, own in enumerate(shop.ids):
        cos = {o: c for o, c in zip(shop.ids, (unit @ unit[i]).tolist()) if o != own}
        mine = sorted((r for r in rows if r.product_id == own), key=lambda r: r["rank"])
        assert [r.similar_id for r in mine] == best(cos, 4)
        assert all(0.0 <= r.score <= 1.0 for r in mine)
    assert next(r for r in rows if r.product_id == "m1" and r["rank"] == 1).similar_id == "m2"
    assert all(r.score == 0.0 for r in rows if r.product_id == "c4")  # no direction, no likeness


def test_unknown_ids_are_an_outcome(spark, shop):
    wanted = spark.createDataFrame([("c3",), ("gone",), ("gone",), (None,)], "product_id string")
    rows = serve.similar_items(shop.products, 2, wanted).collect()
    assert {r.product_id for r in rows} == {"c3"} and len(rows) == 2
    assert [r.product_id for r in serve.unknown_products(wanted, shop.products).collect()] == ["gone"]


@pytest.mark.parametrize("n", [0, 51])
def test_similar_bounds(shop, n):
    with pytest.raises(ValueError):
        serve.similar_items(shop.products, n)


def test_batch_lists_cover_every_user_and_product(shop):
    recs = serve.batch_recommend(shop.users, shop.products, 20, "2031-05-06 07:08:09")
    raw = shop.u.astype(float) @ shop.p.astype(float).T
    summary = serve.recs_summary(recs).first()
    assert summary.n_recommendations == raw.size and abs(summary.avg_score - raw.mean()) < 1e-5
    assert {str(r.generated_at) for r in recs.collect()} == {"2031-05-06 07:08:09"}


def test_asking_for_more_than_the_list_length_fails_loudly(shop):
    asked = shop.users.select(F.col("user_id").alias("query_id"), F.col("u").alias("vec"), F.lit(9).alias("n"))
    items = shop.products.select("product_id", F.col("p").alias("vec"))
    with pytest.raises(Exception, match="more than k"):
        scoring.top_items(asked, items, 8).collect()
    assert scoring.top_items(asked, items, 9).count() == len(shop.names) * len(shop.ids)


def test_scores_pass_their_own_quality_check(shop):
    recs = run(shop, ("ann", 9, None, True), ("stranger", 3, None, False))
    assert all(r.success for r in quality.dq_scores(recs).collect())


@pytest.mark.parametrize("blocks", [{}, {"item_block": 3}])
@pytest.mark.parametrize("cap,n", [(1, 10), (2, 4), (3, 2)])
def test_diversify_is_exact(shop, blocks, cap, n):
    got = {}
    for r in serve.diversify(shop.users, shop.products, cap, n, **blocks).orderBy("rank").collect():
        got.setdefault(r.user_id, []).append(r.product_id)
    for user in shop.names:
        want, held = [], {}
        for i in best(raw_scores(shop, user)):
            held[shop.kinds[i]] = held.get(shop.kinds[i], 0) + 1
            if held[shop.kinds[i]] <= cap and len(want) < n:
                want.append(i)
        assert got[user] == want


def test_hybrid_uses_what_exists(spark, shop):
    a = shop.products.filter("category = 'cups'").select("product_id", "p")
    b = shop.products.filter("product_id in ('c3', 'm3')").select(
        "product_id", F.transform("p", lambda x: x + 1).alias("p")
    )
    mixed = {r.product_id: np.array(r.p) for r in serve.hybrid_products(a, b, 0.75).collect()}
    at = dict(zip(shop.ids, shop.p))
    assert set(mixed) == {"c1", "c2", "c3", "c4", "m3"}
    assert np.allclose(mixed["c1"], at["c1"]) and np.allclose(mixed["m3"], at["m3"] + 1)
    assert np.allclose(mixed["c3"], at["c3"] + 0.25, atol=1e-6)


def test_cold_user_falls_back_to_global_list(spark):
    rows = spark.createDataFrame(
        [("u", "p1", "A"), ("u", "p1", "A"), ("u", "p2", "A"), ("v", "p3", "B")],
        "user_id string, product_id string, category string",
    )
    products = rows.select("product_id", "category").distinct()
    asks = spark.createDataFrame([("x", "B"), ("y", None), ("z", "C")], "user_id string, category string")
    got = cold_start.recommend_cold(
        asks, cold_start.popularity_by_category(rows), cold_start.popular_global(rows, products), 2
    )
    lists = {}
    for r in got.orderBy("rank").collect():
        lists.setdefault(r.user_id, []).append(r.product_id)
    assert lists == {"x": ["p3"], "y": ["p1", "p2"], "z": ["p1", "p2"]}


def test_a_vector_is_measured_once_to_be_normalised(spark):
    rows = spark.createDataFrame([("a", [3.0, 4.0]), ("b", [0.0, 0.0]), ("c", None)], "id string, p array<float>")
    unit = rows.select("id", vectors.l2_normalize(F.col("p")).alias("p"))
    assert {r.id: r.p for r in unit.collect()} == {"a": [0.6, 0.8], "b": [0.0, 0.0], "c": None}
    plan = unit._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("aggregate(") == 1 and "array_repeat(aggregate(" in plan  # not once or more for every element

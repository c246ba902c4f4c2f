"""Registered queries against their oracles (a selection; checks.compare runs them all)."""

import pytest

from checks.catalog import ORACLES, QUERIES
from checks.compare import difference, oracle
from helpers import SF, plan_of

SELECTED = (
    "bronze_products", "user_profile", "silver_interactions", "gold_products_sparse",
    "gold_interactions", "orphan_rate", "index_ids", "cold_start_report", "long_tail_products",
    "eda_recap", "split_train_test", "score_matrix", "topn_per_user", "recommend",
    "recommend_response", "recommend_cold", "similar_items", "fuse_products", "fuse_users",
    "ndcg_at_k", "evaluate_popularity_unseen", "drift_ks", "drift_ks_numeric", "ab_results",
    "latency_p95", "ctr_rate", "category_stats", "product_lifespan", "user_diversity",
    "user_cadence", "hybrid_score", "diversify", "declining_penalty",
)


@pytest.fixture(scope="module")
def con():
    return oracle(SF)


@pytest.mark.parametrize("name", SELECTED)
def test_query_equals_oracle(spark, con, name):
    actual = QUERIES[name](spark, SF).toPandas()
    assert difference(actual, con.execute(ORACLES[name]).df()) is None


@pytest.mark.parametrize(
    "name", ["recommend", "recommend_cold", "score_matrix", "similar_items", "popularity_score",
             "user_profile", "eda_recap", "ndcg_at_k", "drift_ks_numeric", "exclude_seen"],
)
def test_plans_have_no_cross_product(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_every_oracle_belongs_to_a_query_and_parses(con):
    assert set(ORACLES) <= set(QUERIES)
    for sql in ORACLES.values():
        con.execute("EXPLAIN " + sql)

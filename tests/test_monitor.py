"""Quality, drift, experiment statistics and service metrics."""

import datetime as dt
import hashlib
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from recolens.functions.stats import ks_exact_p, ks_p_value, two_sided_normal_p
from recolens.operators import abtest, drift, quality, service


def test_quality_counts_failures(spark):
    rows = spark.createDataFrame(
        [(5.5, "u", "p"), (None, None, "p"), (0.0, "u", None)], "rating double, user_id string, product_id string"
    )
    got = {r.check_name: (r.failed, r.total, r.success) for r in quality.dq_interactions(rows).collect()}
    assert got == {
        "rating_between": (1, 3, False), "user_id_not_null": (1, 3, False),
        "product_id_not_null": (1, 3, False), "row_count": (0, 3, True),
    }
    with pytest.raises(quality.QualityError, match="interactions.rating_between"):
        quality.dq_summary(quality.dq_interactions(rows), mode="fail")
    summary = quality.dq_summary(quality.dq_interactions(rows)).first()
    assert (summary.passed, summary.total) == (1, 4)


def test_empty_table_fails_only_its_row_count(spark):
    empty = spark.createDataFrame([], "product_id string, conversion_rate double")
    got = {r.check_name: r.success for r in quality.dq_gold_products(empty).collect()}
    assert got == {"product_id_not_null": True, "conversion_rate_between": True, "row_count": False}
    assert quality.dq_global_conversion(empty).first().success is False


def months(spark, rates, n=5000):
    rng = np.random.default_rng(42)
    rows = [
        (f"2023-{m:02d}", int(v)) for m, rate in enumerate(rates, 1) for v in rng.binomial(1, rate, n)
    ]
    return spark.createDataFrame(rows, "year_month string, converted int")


def test_drift_is_found_between_different_rates_only(spark):
    rows = drift.drift_ks(months(spark, [0.2, 0.4])).collect()
    assert len(rows) == 1 and rows[0].drift_detected and rows[0].ks_statistic > 0.1
    assert not drift.drift_ks(months(spark, [0.2, 0.2])).first().drift_detected


def test_short_months_drop_their_pairs_without_repairing(spark):
    few = spark.createDataFrame([("2023-02", 1)] * 9 + [("NaT", 1)] * 50, "year_month string, converted int")
    rows = months(spark, [0.2], 50).union(few).union(
        spark.createDataFrame([("2023-03", 0)] * 50, "year_month string, converted int")
    )
    assert drift.drift_ks(rows).count() == 0
    assert drift.drift_ks_numeric(rows, "converted").count() == 0


def test_numeric_test_agrees_with_the_binary_form(spark):
    rows = months(spark, [0.2, 0.3, 0.25], 400)
    binary = {r.month_a: (r.ks_statistic, r.p_value) for r in drift.drift_ks(rows).collect()}
    numeric = {r.month_a: (r.ks_statistic, r.p_value) for r in drift.drift_ks_numeric(rows, "converted").collect()}
    assert binary.keys() == numeric.keys()
    for k in binary:
        assert binary[k] == pytest.approx(numeric[k])


def test_numeric_statistic_by_hand(spark):
    a, b = list(range(20)), [x + 5 for x in range(20)]
    rows = spark.createDataFrame(
        [("2023-01", float(x)) for x in a] + [("2023-02", float(x)) for x in b], "year_month string, v double"
    )
    assert drift.drift_ks_numeric(rows, "v").first().ks_statistic == pytest.approx(0.25)


def test_known_probabilities(spark):
    one = spark.range(1)
    p = one.select(*[two_sided_normal_p(F.lit(z)).alias(str(i)) for i, z in enumerate([0.0, 1.0, -1.96, 4.0])]).first()
    expected = [math.erfc(abs(z) / math.sqrt(2)) for z in [0.0, 1.0, -1.96, 4.0]]
    assert list(p) == pytest.approx(expected, abs=3e-7)
    # lambda = D * sqrt(n/2): 1.36 is the classical 5 % point
    d = 1.36 / math.sqrt(5000 / 2)
    assert one.select(ks_p_value(F.lit(d), F.lit(5000), F.lit(5000))).first()[0] == pytest.approx(0.0495, abs=2e-4)


@pytest.mark.parametrize("n_a, n_b", [(3, 4), (5, 5), (2, 7), (6, 4)])
def test_exact_law_equals_enumeration(n_a, n_b):
    orders = list(itertools.combinations(range(n_a + n_b), n_a))
    gaps = []
    for chosen in orders:
        x = y = worst = 0
        for i in range(n_a + n_b):
            x, y = (x + 1, y) if i in chosen else (x, y + 1)
            worst = max(worst, abs(x / n_a - y / n_b))
        gaps.append(worst)
    for d in set(gaps):
        expected = sum(g >= d - 1e-12 for g in gaps) / len(orders)
        assert ks_exact_p(d, n_a, n_b) == pytest.approx(expected)


def test_exact_law_approaches_the_series(spark):
    assert ks_exact_p(0.0, 50, 60) == 1.0
    lam = 0.03 * math.sqrt(5000 / 2)
    series = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 50))
    assert ks_exact_p(0.03, 5000, 5000) == pytest.approx(series, abs=2e-3)
    rows = months(spark, [0.2, 0.23], 300)
    auto, series = drift.drift_ks(rows, method="auto").first(), drift.drift_ks(rows).first()
    assert auto.p_value == pytest.approx(ks_exact_p(auto.ks_statistic, 300, 300))
    assert auto.p_value != series.p_value == pytest.approx(auto.p_value, abs=0.1)


def test_variant_matches_the_integer_hash_and_is_balanced(spark):
    ids = [f"user_{i}" for i in range(1000)]
    got = {
        r.user_id: r.ab_variant
        for r in abtest.ab_variant(spark.createDataFrame([(i,) for i in ids], "user_id string")).collect()
    }
    assert got == {
        i: "control" if int(hashlib.md5(i.encode()).hexdigest(), 16) % 2 == 0 else "treatment" for i in ids
    }
    assert 400 < sum(v == "control" for v in got.values()) < 600


def test_feedback_validation(spark):
    t = dt.datetime(2026, 1, 1)
    rows = spark.createDataFrame(
        [
            ("u", "p", "click", "control", t), ("u", "p", "skip", "treatment", None),
            ("u", "p", "like", "control", t), ("u", "p", "click", "other", t),
            (None, "p", "click", "control", t), ("u", None, "click", "control", t),
            ("u", "p", None, "control", t), ("u", "p", "click", None, t),
        ],
        "user_id string, product_id string, interaction_type string, ab_variant string, ts timestamp",
    )
    good, bad = abtest.validate_feedback(rows, F.lit("2026-02-02").cast("timestamp"))
    assert [str(r.ts)[:10] for r in good.orderBy("ts").collect()] == ["2026-01-01", "2026-02-02"]
    assert {r.reason for r in bad.collect()} == {
        "invalid interaction_type", "invalid ab_variant", "missing user_id", "missing product_id",
        "missing interaction_type", "missing ab_variant",
    }


def counts(spark, *rows):
    return spark.createDataFrame(rows, "ab_variant string, n_users long, n_impressions long, n_clicks long")


def test_z_test_by_hand(spark):
    r = abtest.ab_results(counts(spark, ("control", 1000, 2000, 100), ("treatment", 1000, 1500, 150)), "2026-04-14", "2026-04-20").first()
    pool, diff = 0.125, 0.05
    z = diff / math.sqrt(pool * (1 - pool) * 2 / 1000)
    assert (r.control_ctr, r.treatment_ctr, r.lift_pct, r.n_days) == (0.1, 0.15, 50.0, 7)
    assert r.p_value == pytest.approx(math.erfc(z / math.sqrt(2)), abs=1e-4) and r.significant
    assert (r.control_ctr_per_impression, r.treatment_ctr_per_impression) == (0.05, 0.1)


def test_z_test_degenerate_cases(spark):
    over = abtest.ab_results(counts(spark, ("control", 10, 10, 20), ("treatment", 10, 10, 30)), "2026-04-14", "2026-04-01").first()
    assert (over.p_value, over.significant, over.n_days) == (1.0, False, 1)
    none = abtest.ab_results(counts(spark, ("control", 10, 10, 0)), "2026-04-14", "2026-04-14").first()
    assert (none.control_ctr, none.treatment_ctr, none.lift_pct, none.p_value) == (0.0, 0.0, 0.0, 1.0)


def test_ab_flow_counts_and_segments(spark):
    users = [f"ab_user_{i}" for i in range(10)]
    variant = ["control", "treatment"]
    t = dt.datetime(2026, 1, 1)
    shown = spark.createDataFrame([(u, variant[i % 2], t) for i, u in enumerate(users)] * 2, "user_id string, ab_variant string, ts timestamp")
    acted = spark.createDataFrame([(u, "click", variant[i % 2]) for i, u in enumerate(users)] + [("x", "skip", "control")], "user_id string, interaction_type string, ab_variant string")
    got = {r.ab_variant: (r.n_users, r.n_impressions, r.n_clicks) for r in abtest.ab_counts(shown, acted).collect()}
    assert got == {"control": (5, 10, 5), "treatment": (5, 10, 5)}
    segments = spark.createDataFrame([(u, "power_user") for u in users[:4]], "user_id string, segment string")
    per = {(r.segment, r.ab_variant): r.n_users for r in abtest.ab_counts_by_segment(shown, acted, segments).collect()}
    assert per == {("power_user", "control"): 2, ("power_user", "treatment"): 2, ("casual_user", "control"): 3, ("casual_user", "treatment"): 3}


def test_latency_quantile_equals_numpy(spark):
    rng = np.random.default_rng(3)
    rows = [(dt.datetime(2026, 1, 1, 0, int(m)), float(v)) for m, v in zip(rng.integers(0, 20, 500), rng.exponential(50, 500).round(1))]
    got = {r.window_start.minute: (r.n_requests, r.latency_p95) for r in service.latency_p95(spark.createDataFrame(rows, "ts timestamp, latency_ms double")).collect()}
    for start in (0, 5, 10, 15):
        v = [x for t, x in rows if start <= t.minute < start + 5]
        assert got[start][0] == len(v) and got[start][1] == pytest.approx(np.percentile(v, 95))

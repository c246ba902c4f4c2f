"""Split, NDCG, lift, sampling, factors, bridge and fusion."""

import glob
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from recolens.operators import als, bridge as br, cold_start, content, evaluate, fuse, skew


def timeline(spark, sizes):
    rows = [
        (f"u{n}", f"p{i:02d}", i, 1.0, 1, 0, "A") for n in sizes for i in range(n)
    ]
    return spark.createDataFrame(
        rows,
        "user_id string, product_id string, timestamp long, rating double, converted int,"
        " helpful_vote long, category string",
    )


def test_split_boundaries(spark):
    split = evaluate.split_train_test(timeline(spark, range(1, 12)))
    got = {
        r.user_id: r.n
        for r in split.filter("split = 'train'").groupBy("user_id").agg(F.count("*").alias("n")).collect()
    }
    for n in range(1, 12):
        assert got.get(f"u{n}", 0) == int(n * 0.8)
    last = split.filter("user_id = 'u10' AND split = 'test'").collect()
    assert {r.product_id for r in last} == {"p08", "p09"}


def test_ndcg_by_hand(spark):
    predicted = spark.createDataFrame(
        [("a", "x", 1), ("a", "y", 2), ("a", "z", 3), ("b", "x", 1), ("d", "x", 1)],
        "user_id string, product_id string, rank int",
    )
    relevant = spark.createDataFrame(
        [("a", "x"), ("a", "z"), ("b", "q"), ("c", "x"), ("d", "x")], "user_id string, product_id string"
    )
    got = {r.user_id: r.ndcg for r in evaluate.ndcg_at_k(predicted, relevant).collect()}
    ideal = 1 + 1 / math.log2(3)
    assert got["a"] == pytest.approx((1 + 1 / math.log2(4)) / ideal)
    assert (got["b"], got["c"], got["d"]) == (0.0, 0.0, 1.0)


def test_ndcg_ideal_stops_at_k(spark):
    predicted = spark.createDataFrame([("a", f"p{i}", i + 1) for i in range(20)], "user_id string, product_id string, rank int")
    relevant = spark.createDataFrame([("a", f"p{i}") for i in range(15)], "user_id string, product_id string")
    assert evaluate.ndcg_at_k(predicted, relevant, 10).first().ndcg == pytest.approx(1.0)


def test_lift_cases(spark):
    df = spark.createDataFrame([(0.2, 0.1), (0.0, 0.0), (0.1, 0.0), (0.05, 0.1)], "a double, b double")
    got = [r.lift_pct for r in evaluate.lift(df, "a", "b").collect()]
    assert got == [pytest.approx(100.0), 0.0, math.inf, pytest.approx(-50.0)]


def test_sample_is_repeatable_and_only_eligible(spark):
    rows = timeline(spark, range(5, 30))
    one = [r.user_id for r in evaluate.eval_sample(rows, 8).collect()]
    two = [r.user_id for r in evaluate.eval_sample(rows.repartition(5), 8).collect()]
    assert one == two and len(one) == 8 and all(int(u[1:]) >= 10 for u in one)


def test_best_run_takes_the_first_of_equals(spark):
    runs = spark.createDataFrame(
        [(f"run-{i:03d}", "metric", "ndcg_at_10", str(v)) for i, v in enumerate([0.1, 0.3, 0.3, 0.2])],
        "run_id string, kind string, key string, value string",
    )
    best = evaluate.best_run(runs).first()
    assert (best.run_id, best.model_stage) == ("run-001", "Production")


@pytest.fixture(scope="module")
def trained(lake):
    pairs = skew.cut(cold_start.pair_counts(lake.supported))
    ids = als.index_ids(pairs)
    model = als.als_fit(ids.pairs, iterations=10)
    return pairs, ids, model


def test_factors_have_the_rank_and_are_finite(trained):
    pairs, ids, model = trained
    users, items = als.als_factors(model, ids)
    u = np.array([r.u for r in users.collect()])
    p = np.array([r.p for r in items.collect()])
    assert u.shape == (pairs.select("user_id").distinct().count(), 16)
    assert p.shape == (pairs.select("product_id").distinct().count(), 16)
    assert np.isfinite(u).all() and np.isfinite(p).all()


def test_more_iterations_fit_at_least_as_well(trained):
    _, ids, model = trained
    start = als.als_fit(ids.pairs, iterations=1)
    assert als.implicit_loss(model, ids) <= als.implicit_loss(start, ids) * 1.02


def test_same_seed_same_factors(trained):
    _, ids, _ = trained
    fixed = skew.cut(ids.pairs.repartition(2, "user_id_int").sortWithinPartitions("user_id_int", "product_id_int"))
    a = {r.id: r.features for r in als.als_fit(fixed, iterations=3).itemFactors.collect()}
    b = {r.id: r.features for r in als.als_fit(fixed, iterations=3).itemFactors.collect()}
    assert a.keys() == b.keys()
    assert max(abs(x - y) for k in a for x, y in zip(a[k], b[k])) < 1e-4


def test_a_fit_evaluates_its_input_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    kind = "user_id_int long, product_id_int long, count long"
    rows = spark.createDataFrame([(u, p, 1 + u * p % 3) for u in range(20) for p in range(0, 30, 1 + u % 4)], kind)
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    model = als.als_fit(rows.mapInArrow(counted, kind).repartition(3, "user_id_int"), iterations=2)
    assert seen.value == rows.count()
    assert model.userFactors.count() == 20 and model.itemFactors.count() == 30
    assert spark.sparkContext._jsc.getPersistentRDDs().size() <= held + 2  # the factors alone


def test_als_recommendations_leave_out_train_items(lake):
    split = evaluate.sampled_split(lake.interactions(), 50)
    train = evaluate.train_rows(split)
    recs = evaluate.als_recommendations(train, 10, iterations=3)
    assert recs.join(train.select("user_id", "product_id"), ["user_id", "product_id"]).isEmpty()
    score = evaluate.mean_ndcg(evaluate.ndcg_at_k(recs, evaluate.relevant_sets(evaluate.test_rows(split)))).first()
    assert 0.0 <= score.ndcg <= 1.0 and score.n_users == 50


def test_content_vectors(spark):
    texts = spark.createDataFrame(
        [("a", "red steel bolt"), ("b", "red steel bolt"), ("c", "blue ring"), ("d", "")],
        "product_id string, text string",
    )
    got = {r.product_id: r.embedding for r in content.content_embed(texts).collect()}
    assert got["a"] == got["b"] != got["c"]
    norms = {k: np.linalg.norm(v) for k, v in got.items()}
    assert norms["d"] == 0 and all(abs(norms[k] - 1) < 1e-5 for k in "abc")


def test_content_terms_are_words_of_any_script(spark):
    texts = spark.createDataFrame(
        [("a", "größe"), ("b", "gr e"), ("c", "größe, GRÖSSE"), ("d", "красный")],
        "product_id string, text string",
    )
    got = {r.product_id: r.embedding for r in content.content_embed(texts).collect()}
    assert sum(x > 0 for x in got["a"]) == 1 and sum(x > 0 for x in got["d"]) == 1
    assert got["a"] != got["b"] and sum(x > 0 for x in got["c"]) == 2


def test_pluggable_encoder_is_normalised(spark):
    texts = spark.createDataFrame([(f"p{i}", "x" * i) for i in range(300)], "product_id string, text string")

    def factory():
        return lambda batch: np.array([[len(t), 0.0, 1.0 if t else 0.0] for t in batch])

    got = content.content_embed(texts, encoder=factory).collect()
    assert len(got) == 300
    assert all(abs(np.linalg.norm(r.embedding) - (r.product_id != "p0")) < 1e-5 for r in got)


@pytest.fixture(scope="module")
def projection(spark):
    """Targets that are a known affine map of the content, plus a kink for the MLP."""
    rng = np.random.default_rng(1)
    x = rng.standard_normal((400, 12))
    y = x @ rng.standard_normal((12, 3)) + 2.0
    rows = [(f"p{i}", x[i].tolist(), y[i].tolist()) for i in range(400)]
    return spark.createDataFrame(rows, "product_id string, x array<float>, y array<float>").repartition(5), y


def test_ridge_recovers_an_affine_map(projection):
    train, _ = projection
    assert br.bridge_rmse(train, br.ridge_fit(train, 1e-3)).first().rmse < 1e-3


def test_mlp_beats_the_mean_predictor(projection):
    train, y = projection
    model = br.mlp_fit(train, hidden=(32, 16), epochs=60, learning_rate=0.02)
    assert br.bridge_rmse(train, model).first().rmse < 0.7 * y.std(axis=0).mean()


def test_bridge_round_trip(spark, projection, tmp_path):
    train, _ = projection
    model = br.ridge_fit(train)
    br.save_bridge(spark, model, f"{tmp_path}/m")
    again = br.load_bridge(spark, f"{tmp_path}/m")
    x = np.ones((2, 12))
    assert np.allclose(model(x), again(x))


def test_fused_vectors_by_source(spark):

    def vec(x):
        return [float(x)] * 16

    products = spark.createDataFrame([("p1", "A"), ("p2", "A"), ("p3", "A")], "product_id string, category string")
    als_items = spark.createDataFrame([("p1", vec(1))], "product_id string, p array<float>")
    bridged = spark.createDataFrame([("p1", vec(9)), ("p2", vec(2))], "product_id string, p array<float>")
    rows = spark.createDataFrame(
        [("u1", "p1")] * 5 + [("u2", "p1"), ("u2", "p1"), ("u2", "p2"), ("u3", "zz")],
        "user_id string, product_id string",
    )
    fused = fuse.fuse_products(products, als_items, bridged, rows)
    got = {r.product_id: (r.p[0], r.vector_source, r.is_cold) for r in fused.collect()}
    assert got == {"p1": (1.0, "als", False), "p2": (2.0, "bridge", True), "p3": (0.0, "zero", True)}
    users = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "user_id string")
    als_users = spark.createDataFrame([("u1", vec(7))], "user_id string, u array<float>")
    got = {
        r.user_id: (round(r.u[0], 5), r.vector_source, r.is_cold)
        for r in fuse.fuse_users(users, als_users, rows, fused).collect()
    }
    assert got == {
        "u1": (7.0, "als", False),
        "u2": (round(4 / 3, 5), "mean", True),  # p1 twice, p2 once
        "u3": (0.0, "zero", True),
    }


def test_a_fit_has_blocks_enough_for_its_pairs(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = [(int(a), int(b), 1 + int(c)) for a, b, c in rng.integers(0, [60, 40, 3], size=(900, 3))]
    pairs = spark.createDataFrame(rows, "user_id_int long, product_id_int long, count long").dropDuplicates(["user_id_int", "product_id_int"])

    def blocks(**given):
        model = als.als_fit(pairs, rank=2, iterations=2, **given)
        assert model.userFactors.count() == 60 and model.itemFactors.count() == 40
        return model.userFactors.rdd.getNumPartitions()

    assert blocks() == als.BLOCKS and blocks(blocks=3) == 3
    monkeypatch.setattr(als, "BLOCK_PAIRS", 50)
    assert blocks() == math.ceil(pairs.count() / 50) > als.BLOCKS


def test_a_fit_drops_the_factors_it_has_sent(spark):
    rows = [(u, p, 1) for u in range(60) for p in range(40) if (u + p) % 3]
    pairs = skew.cut(spark.createDataFrame(rows, "user_id_int long, product_id_int long, count long"))
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}

    before = files()
    als.als_fit(pairs, rank=2, iterations=8)
    # Ten files for each of the 16 times that factors are sent; those sent to items go with the checkpoints.
    assert len(files() - before) < 8 * 2 * als.BLOCKS

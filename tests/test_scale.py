"""Plans and sizes of steps that must not grow with the tables."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from helpers import SF, plan_of
from recolens.operators import bridge as br, fuse, scoring, skew


def wide(spark, name, n=40, dim=16):
    """Written vectors: the planner takes each array for one element."""
    rows = [(f"p{i}", [float(i + d) for d in range(dim)]) for i in range(n)]
    return skew.cut(spark.createDataFrame(rows, f"product_id string, {name} array<float>"))


def test_vectors_are_never_broadcast(spark):
    items, bridged, embeddings = wide(spark, "p"), wide(spark, "p"), wide(spark, "embedding", dim=300)
    train = br.bridge_training_set(items, embeddings, items.select("product_id").limit(30))
    assert "SortMergeJoin" in plan_of(train) and train.count() == 30
    rows = spark.range(60).select(F.concat(F.lit("p"), F.col("id") % 50).alias("product_id"), F.lit("u").alias("user_id"))
    fused = fuse.fuse_products(rows.select("product_id").distinct(), items, bridged, rows)
    assert plan_of(fused).count("SortMergeJoin") >= 2 and fused.count() == 50
    means = fuse.mean_vectors(rows, items)
    assert "BroadcastHashJoin" not in plan_of(means) and means.count() == 1


def test_small_item_blocks_do_not_multiply_the_queries(spark):
    items = spark.range(400).select(F.format_string("p%03d", "id").alias("product_id"), F.array(F.col("id").cast("float")).alias("vec"))
    queries = spark.createDataFrame([("a", [1.0]), ("b", [-1.0])], "query_id string, vec array<float>")
    best = scoring.top_items(queries, items, 3, item_block=2)
    dealt = {int(n) for n in re.findall(r"hashpartitioning\(qb#\d+, ib#\d+, (\d+)\)", plan_of(best))}
    assert dealt == {2 * scoring.MOST_BLOCKS}  # once 200 blocks, and a copy of the queries in each
    assert [r.product_id for r in best.orderBy("query_id", "rank").collect()] == ["p399", "p398", "p397", "p000", "p001", "p002"]


@pytest.mark.parametrize("integers", [True, False])
def test_scan_over_many_tiles_equals_brute_force(integers):
    r = np.random.default_rng(8)
    u, p = r.normal(size=(30, 5)), r.normal(size=(3 * scoring.TILE + scoring.FIRST_TILE + 5, 5))
    if integers:
        u, p = np.rint(u), np.rint(p)  # ties, and queries without a direction
    u, p = u.astype(np.float32), p.astype(np.float32)
    u[3] = 0
    limit = r.integers(1, 40, size=30)
    row, col = np.divmod(np.unique(r.integers(0, u.shape[0] * p.shape[0], size=9000)), p.shape[0])
    order = np.argsort(col, kind="stable")
    steps = np.rint(np.einsum("ik,jk->ij", u.astype(float), p.astype(float)) * 1e6)
    steps[row, col] = -np.inf
    want = [(i, c, steps[i, c]) for i in range(30) for c in np.argsort(-steps[i], kind="stable")[: limit[i]]]
    for ends in (None, scoring._Ends(30)):
        got = scoring._scan(u, p, limit, (row[order], col[order]), ends)
        assert list(zip(*(g.tolist() for g in got))) == want
    # What is known already leaves out less than the bar, and no tie with it.
    known = np.where(np.arange(30) % 4 == 0, -np.inf, np.sort(steps, axis=1)[:, -6])
    got = scoring._scan(u, p, limit, (row[order], col[order]), None, known)
    assert list(zip(*(g.tolist() for g in got))) == [w for w in want if w[2] >= known[w[0]]]
    free = np.isfinite(steps)
    assert ends.count.tolist() == free.sum(axis=1).tolist()
    assert np.array_equal(ends.low, np.where(free, steps, np.inf).min(axis=1)) and np.array_equal(ends.high, steps.max(axis=1))
    assert np.array_equal(ends.total, np.where(free, steps, 0).sum(axis=1))


def test_a_batch_of_a_stream_may_take_several_files(spark, monkeypatch):
    from recolens.sources import bind

    monkeypatch.setattr(bind, "STREAM_ROWS", 10)
    lake = bind.Lake(spark, SF)
    rows = spark.range(70).select("id", F.when(F.col("id") < 55, 0).when(F.col("id") < 57, 2).otherwise(3).alias("b"))
    seen, path = [], lake.scratch("log")

    def take(batch, number):
        seen.append({r.id for r in batch.collect()})

    stream = lake.arrivals(rows, F.col("b"), 4)
    running = stream.writeStream.foreachBatch(take).option("checkpointLocation", path).trigger(availableNow=True).start()
    running.awaitTermination()
    assert running.exception() is None
    assert [s for s in seen if s] == [set(range(55)), {55, 56}, set(range(57, 70))]
    largest = max(r["count"] for r in _rows_per_file(spark, stream))
    assert largest < 55  # the first batch came in one file, written by one task


def test_streamed_tables_are_not_written_by_six_tasks(spark, monkeypatch):
    from recolens.sources import bind

    monkeypatch.setattr(bind, "STREAM_ROWS", 300)
    lake = bind.Lake(spark, SF)
    stream, rows = lake.stream("lineitem"), lake.table("lineitem")
    sizes = [r["count"] for r in _rows_per_file(spark, stream)]
    assert sum(sizes) == rows.count() and max(sizes) < rows.count() / 6 / 2
    batches = []
    lake_path = lake.scratch("log")
    running = stream.writeStream.foreachBatch(lambda b, i: batches.append(b.count())).option("checkpointLocation", lake_path).trigger(availableNow=True).start()
    running.awaitTermination()
    assert len(batches) == 6 and sum(batches) == rows.count()


def _rows_per_file(spark, stream):
    folder = re.search(r"(file:[^\s,\]]+)", stream._jdf.queryExecution().logical().toString() + plan_of(stream))[1]
    return spark.read.parquet(folder).groupBy(F.input_file_name()).count().collect()


def test_scorer_gets_packed_rows(spark, monkeypatch):
    """A block's items and masks reach it as a few values, however many blocks take a copy."""
    def counted(*_):
        schema = pa.schema([(f.name, {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}.get(
            f.dataType.simpleString(), pa.int64())) for f in scoring._OUT])

        def score(key, left, right):
            rows = {"query_id": str(left.num_rows), "product_id": str(right.num_rows), "n": 1}
            return pa.Table.from_pylist([rows], schema=schema)

        return score

    rng = np.random.default_rng(3)
    u, p = rng.normal(size=(40, 8)).astype("f4"), rng.normal(size=(300, 8)).astype("f4")
    queries = spark.createDataFrame([(f"u{i:02}", v.tolist()) for i, v in enumerate(u)], "query_id string, vec array<float>").coalesce(1)
    items = spark.createDataFrame([(f"p{i:03}", v.tolist()) for i, v in enumerate(p)], "product_id string, vec array<float>").coalesce(1)
    hidden = [(f"u{i:02}", f"p{j:03}") for i in range(40) for j in range(i, 300, 7)]
    masked = spark.createDataFrame(hidden + hidden, "query_id string, product_id string")
    blocks = {"query_block": 10, "item_block": 100}
    scores = np.round(u.astype(float) @ p.astype(float).T, 6)
    for a, b in hidden:
        scores[int(a[1:]), int(b[1:])] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, :5]
    found = {(r.query_id, r["rank"]): r.product_id for r in scoring.top_items(queries, items, 5, masked, **blocks).collect()}
    assert found == {(f"u{i:02}", k + 1): f"p{j:03}" for i, row in enumerate(best) for k, j in enumerate(row)}

    monkeypatch.setattr(scoring, "_packed_scorer", counted)
    monkeypatch.setattr(scoring, "_merge", lambda rows, *_: rows)
    met = scoring.top_items(queries, items, 5, masked, **blocks).collect()
    assert len(met) == 12
    assert max(int(r.product_id) for r in met) <= 2 and max(int(r.query_id) for r in met) <= 8

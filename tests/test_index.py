"""Scoring that leaves blocks out, and the inverted file, against the plain scorer."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from recolens.operators import bounded, ivf, serve
from recolens.operators.scoring import top_items


def vectors(spark, name, rows, kind="string"):
    return spark.createDataFrame([(i, v.tolist()) for i, v in rows], f"{name} {kind}, vec array<float>")


@pytest.fixture(scope="module")
def spread(spark):
    """Items whose norms fall off fast, with ties and a zero vector; whole numbers, so scores are exact."""
    r = np.random.default_rng(3)
    items = [(f"p{i:03}", np.rint(r.normal(size=6) * (3 + 400 / (1 + i)))) for i in range(300)]
    items += [("q0", np.zeros(6)), ("q1", items[0][1]), ("q2", items[7][1])]
    queries = [(f"u{i:02}", np.rint(r.normal(size=6) * 4)) for i in range(60)] + [("zero", np.zeros(6))]
    return vectors(spark, "query_id", queries), vectors(spark, "product_id", items)


@pytest.mark.parametrize("class_items, query_block", [(10, 7), (40, 400_000), (1000, 5)])
def test_bounded_rows_equal_all_rows(spark, spread, class_items, query_block):
    queries, items = spread
    out = bounded.top_items_bounded(queries, items, 5, class_items=class_items, query_block=query_block)
    columns = ["query_id", "product_id", "score", "rank"]
    assert rows_of(out.rows.select(*columns)) == rows_of(top_items(queries, items, 5).select(*columns))
    work = bounded.left_out(out.work).first()
    assert work.n_pairs == 61 * 303
    # the zero query ties with everything, so it alone meets all classes
    assert work.left_out > 0.5 if class_items == 10 else work.left_out >= 0
    if class_items == 1000:
        assert work.n_scored == work.n_pairs


def test_bounded_with_limits_masks_and_categories(spark, spread):
    queries, items = spread
    items = items.withColumn("category", F.when(F.col("product_id") < "p1", "first").when(F.col("product_id") < "p2", "mid"))
    queries = queries.withColumn("n", F.when(F.col("query_id") < "u3", 2)).withColumn("category", F.when(F.col("query_id") > "u2", "mid"))
    best = top_items(queries.drop("n", "category"), items, 3).select("query_id", "product_id")
    masked = best.unionByName(best).unionByName(spark.createDataFrame([("u01", "q1"), ("nobody", "p001")], best.schema))
    columns = ["query_id", "product_id", "score", "rank", "category"]
    plain = top_items(queries, items, 6, masked).select(*columns)
    out = bounded.top_items_bounded(queries, items, 6, masked, class_items=12, query_block=9).rows
    assert rows_of(out.select(*columns)) == rows_of(plain)
    assert bounded.top_items_bounded(queries, items.limit(0), 3).rows.collect() == []
    assert bounded.top_items_bounded(queries.limit(0), items, 3, class_items=12).rows.collect() == []


def test_index_finds_clustered_neighbours(spark, tmp_path):
    r = np.random.default_rng(5)
    centres = r.normal(size=(12, 8)) * 5
    rows = [(f"p{i}", str(i % 3), (centres[i % 12] + r.normal(size=8)).tolist()) for i in range(600)] + [("zero", None, [0.0] * 8)]
    products = spark.createDataFrame(rows + [("none", "x", None)], "product_id string, category string, p array<float>")
    index = ivf.write_index(ivf.build_index(products, 12), f"{tmp_path}/index")
    assert index.products.count() == 601  # all but the one without a vector, the sample notwithstanding
    assert ivf.build_index(products, 5, sample_rows=50).products.count() == 601
    exact = serve.similar_items(products.where("p is not null"), 5)
    wanted = products.where("product_id <> 'none'")
    probes = ivf.probes_for(index, 5, 0.95)
    assert 1 <= probes <= 6
    found = ivf.similar_in_index(index, wanted, 5, probes, list_items=20)
    assert ivf.recall(found, exact).first().recall >= 0.9
    # with every list probed nothing is missed
    assert rows_of(ivf.similar_in_index(index, wanted, 5, 12)) == rows_of(exact)
    assert ivf.similar_in_index(index, wanted.limit(0), 5).collect() == []

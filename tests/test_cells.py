"""Scoring by cells: what is left out never counts."""

import random

import numpy as np
import pytest

from helpers import SF, rows_of
from recolens.operators import bounded, cells, scoring

COLUMNS = ["query_id", "product_id", "score", "rank", "category", "is_cold"]


@pytest.fixture
def by_cells(monkeypatch):
    """Tables of any size are scored by cells, of a few items each."""

    def start(pairs=1):
        monkeypatch.setattr(scoring, "CELL_PAIRS", pairs)
        for name, value in {"CELL_ITEMS": 8, "PIECE": 16, "FIRST": 2, "TOGETHER": 3, "WAITING": 50, "AT_ONCE": 64, "MASKS_AT_ONCE": 700, "PACK_BYTES": 2000, "OUT_BATCH": 40}.items():
            monkeypatch.setattr(cells, name, value)

    return start


def tables(spark, vec, n=700, m=40):
    rnd = random.Random(4)
    items = [(f"p{i:04}", vec(rnd), rnd.choice("xyz") if i % 9 else None, i % 2 == 0) for i in range(n)]
    queries = [(f"q{i:02}", vec(rnd), rnd.choice([1, 3, 9, None]), rnd.choice(["x", "y", "w", None, None])) for i in range(m)]
    masked = [(f"q{rnd.randrange(m):02}", f"p{rnd.randrange(n + 5):04}") for _ in range(9000)] + [("q03", p[0]) for p in items]
    return (
        spark.createDataFrame(queries, "query_id string, vec array<float>, n int, category string").repartition(3),
        spark.createDataFrame(items, "product_id string, vec array<float>, category string, is_cold boolean").repartition(3),
        spark.createDataFrame(masked * 2, "query_id string, product_id string"),
    )


def ties(rnd):
    return [float(rnd.randrange(-1, 2)) for _ in range(4)]


def noise(rnd):
    return [rnd.gauss(0, 1) for _ in range(4)]


@pytest.mark.parametrize("vec", [ties, noise])
def test_cells_give_the_rows_of_all_pairs(spark, by_cells, vec):
    queries, items, masked = tables(spark, vec)
    plain = queries.drop("n", "category")
    asks = [
        (queries, {"k": 9, "masked": masked, "with_range": "ends"}),
        (plain, {"k": 7, "per_category": 2}),
        (queries, {"k": 9, "per_category": 1, "masked": masked}),
        (items.selectExpr("product_id query_id", "vec").limit(90), {"k": 5, "exclude_self": True}),
    ]

    def rows(q, ask):
        found = scoring.top_items(q, items, **ask)
        columns = COLUMNS + (["low", "high", "candidates"] if ask.get("with_range") else [])
        assert found.columns == COLUMNS + ["low", "high", "total", "candidates"]
        return sorted(map(repr, found.select(columns).collect()))

    want = [rows(*ask) for ask in asks]
    by_cells()
    assert [rows(*ask) for ask in asks] == want and all(want)


def test_cells_leave_out_what_cannot_count(tmp_path, monkeypatch):
    r = np.random.default_rng(2)
    p = (r.normal(size=(4000, 6)) * r.lognormal(size=(4000, 1))).astype(np.float32)
    u = r.normal(size=(300, 6)).astype(np.float32)
    cell = cells._nearest(p, p[:200])
    order = np.lexsort((np.arange(4000), cell))
    met, tile = [0], cells._tile

    def counted(u, p, first, rows, *rest):
        met[0] += len(rows) * len(p)
        tile(u, p, first, rows, *rest)

    monkeypatch.setattr(cells, "_tile", counted)
    with open(tmp_path / "kept", "w+b") as file:
        kept = cells._Kept(file)
        for part in np.array_split(order, 7):
            columns = [[f"p{i}" for i in part], [None] * len(part), [None] * len(part), part, cell[part], list(p[part])]
            kept.add(cells.pa.RecordBatch.from_arrays([cells.pa.array(c, f.type) for c, f in zip(columns, cells._ITEM)], schema=cells._ITEM).serialize().to_pybytes())
        kept.close()
        lists = cells._Lists(np.full(300, 5, np.int32), kept, None)
        cells._search(kept, u, lists, np.full(300, scoring.ANY), (np.empty(0, np.int64),) * 2)
    steps = np.rint(u.astype(float) @ p.T.astype(float) * 1e6)
    best = np.argsort(-steps, axis=1, kind="stable")[:, :5]
    assert np.array_equal(kept.places[lists.item], best) and np.array_equal(lists.steps, np.take_along_axis(steps, best, 1))
    assert met[0] < 0.5 * steps.size


def test_odd_vectors_leave_nothing_out(spark, by_cells):
    """Scores beyond single precision, and vectors that are no numbers."""
    vec = lambda rnd: [rnd.gauss(0, 1) * 1e18, float(rnd.randrange(3))]
    queries, items, _ = tables(spark, vec, 300, 10)
    odd = spark.createDataFrame([("p9998", [float("nan"), 1.0], "x", True)], items.schema)
    want = sorted(map(repr, scoring.top_items(queries, items, 9).select(COLUMNS).collect()))
    by_cells()
    for offered in (items, items.unionByName(odd)):
        assert sorted(map(repr, scoring.top_items(queries, offered, 9).select(COLUMNS).collect())) == want


def test_no_row_of_a_query_waits_for_a_merge(spark, by_cells, monkeypatch):
    """Lists leave a task once: neither queries nor lists are copied for every block of items."""
    queries, items, masked = tables(spark, noise)
    by_cells()

    def never(*_):
        raise AssertionError("lists of blocks are merged")

    monkeypatch.setattr(scoring, "_merge", never)
    found = scoring.top_items(queries.drop("n", "category"), items, 4, masked, item_block=100)
    assert found.count() == 39 * 4  # one query has seen all


@pytest.mark.parametrize("name", ["declining_penalty", "diversify", "hybrid_score", "recs_summary", "topn_per_user"])
def test_queries_give_the_same_rows_by_cells(spark, lake, by_cells, name):
    from checks.catalog import QUERIES

    want = rows_of(QUERIES[name](spark, SF))
    by_cells()
    assert rows_of(QUERIES[name](spark, SF)) == want and want


@pytest.mark.parametrize("known", [False, True])
def test_norm_classes_are_met_by_cells(spark, by_cells, known):
    vec = (lambda rnd: [rnd.gauss(0, 1) * rnd.choice([1, 2, 5]) for _ in range(4)]) if known else ties
    queries, items, masked = tables(spark, vec, 500, 30)
    out = bounded.top_items_bounded(queries, items, 9, masked, class_items=60)
    want, work = rows_of(out.rows.select(COLUMNS)), rows_of(out.work)
    by_cells()
    out = bounded.top_items_bounded(queries, items, 9, masked, class_items=60)
    assert rows_of(out.rows.select(COLUMNS)) == want and rows_of(out.work) == work and len(work) > 2


def test_lists_are_as_long_as_asked_for(spark, by_cells, monkeypatch):
    """Items are copied for as many tasks as the lists need that are asked for, not the longest possible ones."""
    queries, items, _ = tables(spark, noise)
    by_cells()
    monkeypatch.setattr(cells, "LIST_ROWS", 180)
    found = scoring.top_items(queries.where("n is not null"), items, scoring.MAX_K)
    assert found.rdd.getNumPartitions() <= 2  # 40 lists of up to 9, 20 a task

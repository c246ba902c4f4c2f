import random

import brute
from recolens.llm.graph import components
from recolens.llm.minhash import drop_near_duplicates, near_duplicates, overlaps
import numpy as np


def test_matches_brute_force_on_groups_of_edited_copies(spark):
    r = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    rows, d = [], 0
    for _ in range(12):
        base = [r.choice(vocabulary) for _ in range(r.choice([3, 30, 120]))]
        for k in range(r.choice([1, 2, 9, 40])):
            own = list(base)
            for _ in range(r.randrange(0, 1 + len(own) // 12)):
                own[r.randrange(len(own))] = r.choice(vocabulary)
            rows.append((d, " ".join(own).upper() if k % 3 else " ".join(own)))
            d += 1
    rows += [(d + 1, None), (d + 2, ""), (d + 3, " \n ")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for size in (4, 5):
        got = {x.doc_id: (x.n_shingles, x.component_id) for x in near_duplicates(df, size).collect()}
        assert got == brute.near_duplicates(rows, size, 80)


def test_odd_rows(spark, odd, none):
    out = near_duplicates(odd, 4).collect()
    assert len(out) == odd.count()
    by = {}
    for x in out:
        by.setdefault(x.doc_id, []).append(x)
    assert [x.kept for x in by[None]] == [True] and by[None][0].component_id is None
    assert by[0][0].n_shingles == 0 and by[0][0].component_id == 0 and by[0][0].kept
    assert by[90][0].component_id == 7 and not by[90][0].kept
    assert len(by[3]) == 2 and {x.component_id for x in by[3]} == {3}
    assert near_duplicates(none).collect() == []
    kept = drop_near_duplicates(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 90").count() == 0


def test_components_of_paths_stars_and_loops(spark):
    path = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 60)]
    edges = spark.createDataFrame(path + star + [(7, 7), (300, 299)], "a long, b long")
    got = dict(components(edges).collect())
    assert {got[i] for i in range(41)} == {0} and {got[i] for i in range(100, 160)} == {100} and got[300] == 299
    assert components(edges.limit(0)).collect() == []


def test_overlaps():
    r = np.random.default_rng(0)
    sets = [np.unique(r.integers(0, 3000, n).astype(np.uint64)) for n in (1, 50, 900, 2000, 3, 70, 80)]
    want = [[len(np.intersect1d(x, y)) for y in sets] for x in sets]
    assert overlaps(sets, sets).tolist() == want

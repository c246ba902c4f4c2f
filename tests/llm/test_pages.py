"""Page extraction held against repeats found as plain substrings."""

import random

import brute
import numpy as np
import pytest
from recolens.llm import pages


def made_pages(seed, n=60):
    """Pages of two hosts: own paragraphs, notices that many pages repeat, quotations, copies, odd rows."""
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(400)}"
    notices = [" ".join(word() for _ in range(r.randrange(6, 30))) for _ in range(2)]
    quote = " ".join(word() for _ in range(20))
    rows = []
    for i in range(n):
        host = "a.example.org" if i % 3 else "b.example.org"
        own = [" ".join(word() for _ in range(r.randrange(3, 60))) for _ in range(r.randrange(1, 4))]
        if r.random() < 0.8:
            own.insert(r.randrange(len(own) + 1), r.choice(notices))
        if r.random() < 0.05:
            own.append(quote)
        body = "".join(f"<p>{p}</p>" for p in own)
        page = f"<nav>home news</nav><article>{body}</article>" if r.random() < 0.7 else f"<div>{body}</div>"
        rows.append((i, f"https://{host}/{i}", page))
    rows += [(n + j, f"https://a.example.org/copy{j}", rows[1][2]) for j in range(12)]
    return rows + [(900, None, None), (901, "https://b.example.org/e", ""), rows[2], rows[2]]


def expected(rows):
    found = [pages.blocks_of(h or "") for _, _, h in rows]
    texts = [" ".join(t.lower() for _, t, _ in b) for b in found]
    places = brute.boilerplate_places([(pages.host_of(u), t) for (_, u, _), t in zip(rows, texts)], pages.RUN, pages.LEAST, pages.SHARE)
    return sorted(
        (i, pages.main_text(b, sorted(p), [x for x, n in p.items() if n < pages.SURE])) for (i, _, _), b, p in zip(rows, found, places)
    )


@pytest.mark.parametrize("seed, slice_bytes", [(1, 1 << 24), (2, 3000), (3, 900)])
def test_pages_equal_plain_substrings(spark, seed, slice_bytes):
    rows = made_pages(seed)
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    got = sorted((x.page_id, x.text) for x in pages.extract_pages(df, slice_bytes=slice_bytes).collect())
    want = expected(rows)
    assert got == want
    plain = [(i, pages.main_text(pages.blocks_of(h or ""), [])) for i, _, h in rows]
    assert sum(a != b for a, b in zip(want, sorted(plain))) > 20  # the runs matter


def test_runs_come_from_the_suffix_order(monkeypatch):
    r = np.random.default_rng(5)
    shared = r.integers(0, 1 << 60, 30).astype(np.uint64)
    streams = [np.concatenate([r.integers(0, 1 << 60, 40).astype(np.uint64), shared, shared[:10]]) for _ in range(12)]
    prefix, n = pages.repeated_runs(streams, 3)
    # 33 places in 40 shared tokens; the last three repeat the first three.
    assert len(prefix) == 30 and set(n) == {12}
    sort = pages.sorted_prefixes

    def shuffled(tokens, depth):
        order, rank = sort(tokens, depth)
        return r.permutation(order), rank

    monkeypatch.setattr(pages, "sorted_prefixes", shuffled)
    prefix, n = pages.repeated_runs(streams, 3)
    assert len(prefix) < 30


def test_pages_are_not_shuffled_again(spark):
    df = spark.createDataFrame(made_pages(4), "page_id long, url string, html string")
    plan = pages.extract_pages(df)._jdf.queryExecution().executedPlan().toString()
    left = plan[: plan.index("pages_boilerplate")] if "pages_boilerplate" in plan else plan
    assert "FlatMapCoGroupsInArrow" in plan and plan.count("Exchange hashpartitioning") == 1, left


def test_pages_of_no_rows(spark):
    df = spark.createDataFrame([], "page_id long, url string, html string, host string, slice int")
    assert pages.extract_pages(df).collect() == []

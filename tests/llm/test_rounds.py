"""Exchanges in the rounds of connected components."""

import random

from recolens.llm import graph



def test_components_by_shuffle_and_by_broadcast(spark, monkeypatch):
    r = random.Random(5)
    edges = spark.createDataFrame([(r.randrange(300), r.randrange(300)) for _ in range(220)], "a long, b long")
    sent = sorted(graph.components(edges).collect())
    hinted, inner = [], graph.F.broadcast
    monkeypatch.setattr(graph.F, "broadcast", lambda df: (hinted.append(1), inner(df))[1])
    assert sorted(graph.components(edges).collect()) == sent and hinted
    hinted.clear()
    monkeypatch.setattr(graph, "SMALL", 0)
    assert sorted(graph.components(edges).collect()) == sent and not hinted

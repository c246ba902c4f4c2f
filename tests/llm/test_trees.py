"""Prefix trie of conversations, Merkle manifest, grouped prefix join."""

import random

import brute
import pytest
from pyspark.sql import functions as F
from recolens.llm import merkle, setjoin, trie
from recolens.llm.minhash import near_duplicates


def nodes(df):
    names = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
    return {tuple(x[c] for c in names) for x in df.collect()}


def talk(seed, n):
    """Conversations with shared starts, exact copies, one that goes on for long and one without turns."""
    r = random.Random(seed)
    say = lambda: (r.choice(["user", "assistant", ""]), r.choice(["", "a", "bb", "ccc 漢", "a"]))
    out = {c: [say() for _ in range(r.randrange(0, 5))] for c in range(n)}
    out[n] = [say() for _ in range(40)]
    out[n + 1] = out[n][:9]
    out[n + 2] = out[n][:9] + [say()]
    out |= {n + 10 + i: out[n][:12] + [("user", "copy")] * 3 for i in range(6)}
    return out | {9000 + i: [("user", "said by many")] for i in range(30)} | {-5: []}


@pytest.mark.parametrize("seed, cell", [(1, 4096), (2, 4)])
def test_trie_equals_brute_force(spark, monkeypatch, seed, cell):
    monkeypatch.setattr(trie, "CELL", cell)
    conversations = talk(seed, 40)
    rows = [(c, i, role, text, "x") for c, turns in conversations.items() for i, (role, text) in enumerate(turns)]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, pos string")
    ids = spark.createDataFrame([(c,) for c in conversations], "conv_id long")
    assert nodes(trie.prefix_trie(trie.turn_rows(df), ids)) == brute.trie(conversations)


def test_trie_of_a_conversation_that_is_spread(spark, conf):
    """Keys above the limit are numbered and summed by range pieces."""
    conf("spark.recolens.hotKeyRows", 5)
    conversations = talk(3, 10)
    rows = [(c, i, role, text) for c, turns in conversations.items() for i, (role, text) in enumerate(turns)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    ids = spark.createDataFrame([(c,) for c in conversations], "conv_id long")
    assert nodes(trie.prefix_trie(trie.turn_rows(df), ids)) == brute.trie(conversations)


def test_trie_of_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "user", "a"), (1, 0, "assistant", "b"), (2, None, "", ""), (None, 1, "user", "lost")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    numbered = trie.turn_rows(df)
    assert nodes(trie.prefix_trie(numbered, numbered.select("conv_id"))) == brute.trie(
        {1: [("", ""), ("assistant", "b"), ("user", "a")], 2: [("", "")]}
    )
    none = trie.turn_rows(df.limit(0))
    assert trie.prefix_trie(none, none.select("conv_id")).collect() == []
    alone = trie.prefix_trie(none, spark.createDataFrame([(7,)], "conv_id long"))
    assert nodes(alone) == brute.trie({7: []})


def test_respliced(spark):
    rows = [(100, i, "u", f"base {i}") for i in range(3)] + [(103, i, "u", f"own {i}") for i in range(6)]
    rows += [(207, i, "u", f"no base {i}") for i in range(6)] + [(101, 0, "u", "short")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    conv = F.col("conv_id")
    got = trie.respliced(trie.turn_rows(df), conv - conv % 100, F.lit(4), 5)
    texts = {t[3]: brute.digest(t[3]) for t in rows}
    of = {v: k for k, v in texts.items()}
    out = {}
    for x in got.orderBy("conv_id", "pos").collect():
        out.setdefault(x.conv_id, []).append((x.pos, of[x.digest]))
    base = [(i + 1, f"base {i}") for i in range(3)]
    assert out == {
        100: base, 101: base, 103: [*base, (4, "own 4"), (5, "own 5")], 207: [(1, "no base 4"), (2, "no base 5")],
    }


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 8, "b": 9}, {None: 1, "a": 700, "b": 4200, "z": 64, "é": 65}])
def test_manifest_and_proofs_equal_brute_force(spark, sizes):
    rows = [(g, i, brute.digest(f"{g} {i}"), "t") for g, n in sizes.items() for i in range(n)]
    want, subroots, proofs = brute.merkle({g: [brute.digest(f"{g} {i}") for i in range(n)] for g, n in sizes.items()})
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "lang string, i long, leaf string, block string")
    m = merkle.manifest(df, "lang", ["i"])
    assert m.root == want
    some = m.leaves.where("i % 7 in (0, 3)" if len(sizes) > 2 else "true")
    got = merkle.prove(m, some).select("*", merkle.fold("leaf").alias("folded")).collect()
    assert len(got) == some.count()
    for x in got:
        assert [tuple(s) for s in x.proof] == proofs[x.lang, x.i]
        assert (x.root, x.subroot, x.folded) == (want, subroots[x.lang], want)


def test_multiproof_fetches_the_minimal_union(spark):
    """Leaves of one run need its other members only; a whole block nothing below its own top."""
    import numpy as np

    lacking = {lv: missing.tolist() for lv, _, _, _, missing in merkle.runs_of(np.array([9, 10, 64]), 4096)}
    assert lacking[0] == [8, 11, 12, 13, 14, 15, 65, 66, 67, 68, 69, 70, 71]
    assert lacking[1] == [0, 2, 3, 4, 5, 6, 7, 9, 10, 11, 12, 13, 14, 15] and lacking[2] == [2, 3, 4, 5, 6, 7]
    whole = [len(m) for *_, m in merkle.runs_of(np.arange(4096), 4096 * 3)]
    assert whole == [0, 0, 0, 0, 2]


def test_manifest_of_odd_rows(spark, odd, none):
    leaf = merkle.leaf_of("doc_id", "text")
    rows = odd.withColumn("leaf", leaf).withColumn("tree", F.lit("x")).withColumn("at", F.lit(None).cast("int"))
    m = merkle.manifest(rows, "component", ["doc_id"])
    got = merkle.prove(m).select("doc_id", "text", merkle.fold("leaf").alias("folded")).collect()
    assert len(got) == odd.count() and {x.folded for x in got} == {m.root}
    texts = [(x.doc_id, x.text) for x in odd.collect()]
    part = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaves = sorted(((d is not None, d or 0, brute.digest(part(d) + part(t))) for d, t in texts))
    assert m.root == brute.merkle({0: [h for *_, h in leaves]})[0]
    empty = merkle.manifest(none.withColumn("leaf", leaf), "component", ["doc_id"])
    assert empty.root is None and merkle.prove(empty).collect() == []


def documents(seed):
    r = random.Random(seed)
    word = lambda: r.choice("abcdefghijklmnopqrstuvwxyz") * r.randrange(1, 4) + str(r.randrange(400))
    shared = [word() for _ in range(60)]
    out = []
    for _ in range(25):
        base = [word() for _ in range(r.choice([2, 3, 20, 120, 300]))]
        if r.random() < 0.5:
            base += shared
        for _ in range(r.choice([1, 2, 6])):
            w = list(base)
            for _ in range(r.choice([0, 0, 1, 2, 4, 9])):
                w[r.randrange(len(w))] = word()
            out.append(" ".join(w[: len(w) - r.choice([0, 0, 1, 15])]))
    hub = [word() for _ in range(200)]
    for i in range(60):  # a large group: a chain that drifts away, so that no member meets all others
        hub[i * 3 % 200] = word()
        out.append(" ".join(hub))
    return list(enumerate([*out, "", None, " \t", "one", "one two", "one two", "One TWO", "one two three"]))


@pytest.mark.parametrize("seed, percent", [(1, 90), (2, 80), (3, 90), (4, 100)])
def test_jaccard_components_equal_brute_force(spark, monkeypatch, seed, percent):
    # Small blocks, so that every way through them is taken.
    monkeypatch.setattr(setjoin, "LIST_BLOCK", 4)
    monkeypatch.setattr(setjoin, "BLOCK_SETS", 5)
    rows = documents(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("gid", F.lit(1)).withColumn("token", F.lit("x"))
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in setjoin.jaccard_components(df, 3, percent).collect()}
    assert got == brute.near_duplicates(rows, 3, percent)


def test_jaccard_odd_rows(spark, odd, none):
    out = setjoin.jaccard_components(odd).collect()
    assert len(out) == odd.count()
    same = {x.doc_id: (x.n_shingles, x.component_id) for x in near_duplicates(odd, 3, 90).collect()}
    assert {x.doc_id: (x.n_shingles, x.component_id) for x in out} == same
    assert {x.component_id for x in out if x.doc_id is None} == {None}
    assert setjoin.jaccard_components(none).collect() == []

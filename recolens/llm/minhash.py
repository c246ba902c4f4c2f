"""Near-duplicate documents by an inverted join over MinHash signature coordinates.

Every document is posted under its (coordinate, value) pairs. Two documents whose sets have the
similarity 0.8 agree on about 0.8 of the coordinates, and on at least `matches` of them but for a
chance below 1e-6 (64 coordinates, 34 matches). Merging works on short lists only:

* values that one set alone has can't collide and are left out; a set with fewer than `matches`
  shared values has no partner (length filter);
* each set keeps a prefix, its rarest shared values, long enough that two sets with `matches`
  collisions have a prefix value in common; the frequent rest of the lists is skipped while merging
  and probed through the signatures;
* a list is never expanded into pairs. Its members meet the list's smallest and largest member; where
  that leaves a list in several parts, its members' signatures are compared in bounded blocks that
  return joining edges only.

That gives candidate groups; inside each group all sets meet in bounded blocks and are compared on
the full sets (rebuilt from the whole texts), again returning joining edges only. Equal sets are one
node from the start.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recolens.llm.graph import components
from recolens.llm.store import unused, written
from recolens.llm.tokens import Words, mix, pieces, shingle_set, signed

COORDINATES = 64
MATCHES = 34
BLOCK_SETS = 256
BLOCK_SHINGLES = 120_000
LIST_BLOCK = 512

_SEEDS = np.random.default_rng(20240)
_MULTIPLY = _SEEDS.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _SEEDS.integers(0, 2**63, 256, dtype=np.uint64)


def signature(shingles: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    """The upper 32 bits of the minimum of each of the hash functions."""
    best = np.full(coordinates, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096]
        values = _MULTIPLY[:coordinates, None] * part[None, :]
        values += _ADD[:coordinates, None]
        np.minimum(best, values.min(axis=1), out=best)
    return (best >> np.uint64(32)).astype(np.uint32)


def set_columns(docs: DataFrame, size: int, coordinates: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_a, set_b, sig) for every row of (doc_id, text, text_key):
    the set's size, a 128-bit hash of the set and its signature (null for an empty set)."""

    def run(batches):
        for batch in batches:
            for part in pieces(batch, 1):
                words = Words(part.column(1))
                count, left, right, sigs = [], [], [], []
                for i in range(part.num_rows):
                    s = shingle_set(words.hash[words.first[i] : words.first[i + 1]], size)
                    count.append(len(s))
                    left.append(mix(s).sum(dtype=np.uint64))
                    right.append(mix(~s).sum(dtype=np.uint64))
                    sigs.append(signature(s, coordinates).tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(2), pa.array(count, pa.int64()),
                        pa.array(signed(np.array(left, np.uint64))), pa.array(signed(np.array(right, np.uint64))),
                        pa.array(sigs, pa.binary()),
                    ],
                    ["doc_id", "text_key", "n_shingles", "set_a", "set_b", "sig"],
                )

    return docs.select("doc_id", "text", "text_key").mapInArrow(
        run, "doc_id long, text_key long, n_shingles long, set_a long, set_b long, sig binary"
    )


def postings(sets: DataFrame, coordinates: int) -> DataFrame:
    """(rep, token): a 64-bit token for every coordinate and its value."""

    def run(batches):
        salt = np.arange(coordinates, dtype=np.uint64) << np.uint64(32)
        for batch in batches:
            reps = batch.column(0).to_numpy()
            sigs = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint32).reshape(len(reps), -1)
            tokens = signed(mix(sigs.astype(np.uint64) | salt).ravel())
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(reps, coordinates)), pa.array(tokens)], ["rep", "token"]
            )

    return sets.select("rep", "sig").mapInArrow(run, "rep long, token long")


class Joined:
    """Disjoint sets over 0 .. n-1; keeps the edges that joined two of them."""

    def __init__(self, n: int):
        self.up, self.edges = list(range(n)), []

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.up[max(a, b)] = min(a, b)
            self.edges.append((x, y))


def joining_edges(n: int, rows: np.ndarray, cols: np.ndarray) -> list[tuple[int, int]]:
    sets = Joined(n)
    for x, y in zip(rows.tolist(), cols.tolist()):
        sets.join(x, y)
    return sets.edges


def in_blocks(df: DataFrame, blocks: Column, member: str) -> DataFrame:
    """Copies of each row for all block pairs (x <= y) it belongs to; `side` tells on which side.

    `blocks` is a column with the number of blocks of the row's group. A group of one block is one
    pair; otherwise each row is copied once per block, never once per partner.
    """
    df = df.withColumn("_n", blocks.cast("int")).withColumn(
        "_b", F.pmod(F.xxhash64(member), F.col("_n")).cast("int")
    )
    df = df.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_n") - 1)))
    return df.select(
        "*", F.least("_b", "_o").alias("x"), F.greatest("_b", "_o").alias("y")
    ).withColumn("side", (F.col("_b") == F.col("y")).cast("int")).drop("_b", "_o", "_n")


def candidate_edges(sets: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """Edges (a, b) that connect all pairs of sets with at least `matches` collisions."""
    posted = postings(sets, coordinates)
    lists = posted.groupBy("token").agg(F.count("*").alias("f")).where("f > 1")
    prefix = (
        posted.join(lists, "token")
        .groupBy("rep")
        .agg(F.sort_array(F.collect_list(F.struct("f", "token"))).alias("t"))
        .where(F.size("t") >= matches)
        .select("rep", F.explode(F.expr(f"slice(t, 1, size(t) - {matches - 1})")).alias("t"))
        .select("rep", F.col("t.token").alias("token"))
    )
    prefix = written(prefix, "prefix")
    ends = prefix.groupBy("token").agg(
        F.min("rep").alias("lo"), F.max("rep").alias("hi"), F.count("*").alias("n")
    ).where("lo <> hi")
    ends = written(ends, "lists")
    met = (
        prefix.join(ends, "token")
        .select("rep", F.explode(F.array("lo", "hi")).alias("end"))
        .where("rep <> end").distinct()
    )
    sig = sets.select("rep", "sig")

    def collide(batches):
        for batch in batches:
            n = batch.num_rows
            left, right = (
                np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint32).reshape(n, -1) for k in (2, 3)
            )
            yield batch.select([0, 1]).filter(pa.array((left == right).sum(axis=1) >= matches))

    near = (
        met.join(sig, "rep")
        .join(sig.select(F.col("rep").alias("end"), F.col("sig").alias("other")), "end")
        .select(F.col("rep").alias("a"), F.col("end").alias("b"), "sig", "other")
        .mapInArrow(collide, "a long, b long")
    )
    near = written(near, "near")
    part = components(near)
    member = prefix.join(ends.select("token", "n"), "token").join(
        part.withColumnRenamed("node", "rep"), "rep", "left"
    ).withColumn("component", F.coalesce("component", "rep"))
    several = (
        member.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo <> hi").select("token")
    )
    rest = in_blocks(
        member.join(several, "token").join(sig, "rep"), F.ceil(F.col("n") / LIST_BLOCK), "rep"
    )

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("rep")
        reps, own = pdf["rep"].to_numpy(), pdf["component"].to_numpy()
        sigs = np.frombuffer(b"".join(pdf["sig"]), np.uint32).reshape(len(pdf), -1)
        rows, cols = [], []
        for i in range(len(reps) - 1):
            hit = np.flatnonzero((own[i + 1 :] != own[i]) & ((sigs[i + 1 :] == sigs[i]).sum(axis=1) >= matches))
            rows.append(np.full(len(hit), i))
            cols.append(hit + i + 1)
        found = joining_edges(len(reps), np.concatenate(rows), np.concatenate(cols)) if rows else []
        a, b = (np.array([reps[e[k]] for e in found], np.int64) for k in (0, 1))
        return pd.DataFrame({"a": a, "b": b})

    more = rest.groupBy("token", "x", "y").applyInPandas(compare, "a long, b long")
    return near.unionAll(more)


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    if len(left) * len(right) <= 32:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in right] for x in left])
    values, codes = np.unique(np.concatenate(left), return_inverse=True)
    rows = np.repeat(np.arange(len(left)), [len(x) for x in left])
    other = np.concatenate(right)
    cols = np.repeat(np.arange(len(right)), [len(x) for x in right])
    at = np.minimum(np.searchsorted(values, other), len(values) - 1)
    known = values[at] == other
    at, cols = at[known], cols[known]
    used = np.zeros(len(values), bool)
    used[at] = True
    number = np.cumsum(used) - 1
    keep = used[codes]
    codes, rows, at, n = number[codes[keep]], rows[keep], number[at], int(used.sum())
    out = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, n, 8192):
        x = np.zeros((len(left), min(8192, n - lo)), np.float32)
        y = np.zeros((len(right), min(8192, n - lo)), np.float32)
        k = (codes >= lo) & (codes < lo + 8192)
        x[rows[k], codes[k] - lo] = 1
        k = (at >= lo) & (at < lo + 8192)
        y[cols[k], at[k] - lo] = 1
        out += x @ y.T
    return out.astype(np.int64)


def confirmed_edges(groups: DataFrame, sets: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """Joining edges (a, b) of all pairs inside a candidate group that are similar on full sets."""
    members = groups.join(sets.select("rep", "n_shingles", "doc_id", "text_key"), "rep")
    sizes = members.groupBy("component").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("w"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK_SETS), F.ceil(F.col("w") / BLOCK_SHINGLES))
    texts = (
        members.join(sizes, "component")
        .select("component", "rep", "doc_id", "text_key", F.least(blocks, F.col("n")).alias("blocks"))
        .join(docs, ["doc_id", "text_key"])
    )
    dealt = in_blocks(texts.select("component", "rep", "text", "blocks"), F.col("blocks"), "rep")

    def compare(key, table):
        full, reps, side = {}, table.column("rep").to_numpy(), table.column("side").to_numpy()
        for batch in table.to_batches():
            for part in pieces(batch.select(["text", "rep"]), 0):
                words = Words(part.column(0))
                for i, rep in enumerate(part.column(1).to_pylist()):
                    full[rep] = shingle_set(words.hash[words.first[i] : words.first[i + 1]], size)
        sides = dict(zip(reps.tolist(), side.tolist()))  # repeated rows count once
        reps = np.array(list(sides), np.int64)
        side = np.array(list(sides.values()))
        whole = key[1].as_py() == key[2].as_py()
        one = np.arange(len(reps)) if whole else np.flatnonzero(side == 0)
        two = one if whole else np.flatnonzero(side == 1)
        found = []
        if len(one) and len(two):
            both = overlaps([full[x] for x in reps[one].tolist()], [full[x] for x in reps[two].tolist()])
            length = np.array([len(full[x]) for x in reps.tolist()])
            union = length[one][:, None] + length[two][None, :] - both
            rows, cols = np.nonzero(100 * both >= percent * union)
            found = joining_edges(len(reps), one[rows], two[cols])
        return pa.table({k: pa.array([int(reps[e[i]]) for e in found], pa.int64()) for i, k in enumerate("ab")})

    return dealt.select("component", "x", "y", "rep", "text", "side").groupBy("component", "x", "y").applyInArrow(
        compare, "a long, b long"
    )


def near_duplicates(
    docs: DataFrame,
    size: int = 5,
    percent: int = 80,
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
    doc: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of `docs`.

    Documents are linked when 100 * |intersection| >= percent * |union| of their shingle sets;
    component_id is the smallest doc_id reachable over links, kept tells whether it is the row's own.
    Null and empty texts, and texts without words, have the empty set and no link. Repeated rows with
    one doc_id are one node. A row without doc_id can't be named: it is linked with nothing, its
    component_id is null and it is kept. An empty table gives an empty result. Other columns of `docs`
    are ignored, whatever their names.
    """
    docs = docs.select(
        F.col(doc).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    ).withColumn("text_key", F.xxhash64("text"))
    rows = written(set_columns(docs, size, coordinates), "signatures")
    named = rows.where("doc_id is not null and n_shingles > 0")
    sets = named.groupBy("set_a", "set_b", "n_shingles").agg(
        F.min(F.struct("doc_id", "text_key", "sig")).alias("first")
    ).select("set_a", "set_b", "n_shingles", "first.*")
    # An id that stands for several sets (rows that share a doc_id) gets a node for each of them.
    several = sets.groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1")
    node = F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(
        F.lit(-(2**62)) - F.pmod(F.xxhash64("doc_id", "set_a", "set_b"), F.lit(2**61))
    )
    sets = written(sets.join(several, "doc_id", "left").withColumn("rep", node).drop("k"), "sets")

    near = written(candidate_edges(sets, coordinates, matches), "candidates")
    groups = components(near).withColumnRenamed("node", "rep")
    links = confirmed_edges(groups, sets, docs, size, percent)
    of_row = named.select("doc_id", "set_a", "set_b", "n_shingles").distinct().join(
        sets.select("set_a", "set_b", "n_shingles", "rep"), ["set_a", "set_b", "n_shingles"]
    ).select("doc_id", "rep")
    by_id = of_row.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    part = components(links.unionAll(by_id))
    names = part.groupBy("component").agg(F.min(F.when(F.col("node") > -(2**62), F.col("node"))).alias("component_id"))
    part = part.join(names, "component").select(F.col("node").alias("doc_id"), "component_id")
    return rows.select("doc_id", "n_shingles").join(part, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce(F.col("component_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` whose document is the first of its group, all columns kept. Of rows that
    repeat a kept doc_id every one stays."""
    (name,) = unused(docs, "_gone")
    gone = near_duplicates(docs, size, percent).where("not kept").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, docs["doc_id"] == gone[name], "left_anti")

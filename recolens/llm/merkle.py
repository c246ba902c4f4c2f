"""Merkle manifest of a dataset: a tree per group, a tree over the groups' roots, and proofs of rows.

A row's leaf is the SHA-256 of its columns. In each group the leaves, in a stated order, are level 0 of
a tree of arity 8: while a level has several nodes, every 8 consecutive ones (the last run fewer, even
one) become the SHA-256 of their hex digests in the next. The groups' roots, in group order, are the
leaves of the top tree in the same way. All digests are lowercase hex text.

* Positions come from one range exchange on (group, order) and per-piece offsets, so that a group with
  most of the rows is spread like any other.
* `grow` turns aligned blocks of 8 ** 4 nodes into the four levels above them in one grouped step, so a
  tree of n leaves takes log(n) / log(4096) steps, and a task holds one block.
* `prove` is an octopus multiproof: for the asked leaves of a block, level by level, the nodes known
  (asked or derived) are taken in runs, and the members of those runs that are neither are missing.
  This minimal union of missing coordinates is fetched once per block by a join with the node table,
  the shared interiors up to the root are derived from it once, and each leaf's own proof is expanded
  from what the block holds.
"""

from __future__ import annotations

from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from recolens.llm.store import written

ARITY_BITS = 3
ARITY = 1 << ARITY_BITS
BLOCK_LEVELS = 4
BLOCK_BITS = ARITY_BITS * BLOCK_LEVELS
HEX = 64
#: Group key of the tree over the groups' roots; group keys themselves are '' or begin with '='.
TOP = "^"
#: Columns of `prove` and its steps, besides names that begin with an underscore.
OWN = ("tree", "at", "n", "hash", "place", "groups", "block", "leaf", "subroot", "root", "proof")

_PIECE_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def leaf_of(*columns: str | Column) -> Column:
    """SHA-256 of the columns: `-` for null, else UTF-8 byte count, `:`, value (numbers as decimal text)."""
    parts = []
    for c in columns:
        value = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def group_key(column: str) -> Column:
    """A text that is never null and sorts as the column does, null first, bytewise in UTF-8."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def height(n: int) -> int:
    """Levels above the leaves of a tree with n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """`rows` (with a column `tree`) and their `at` in the order within the tree, and the tree's `n`. Written."""
    ordered = (
        rows.repartitionByRange("tree", *order)
        .sortWithinPartitions("tree", *order)
        .withColumn("_row", F.monotonically_increasing_id())
    )
    # Range bounds are sampled, so the row numbers are written before they are used twice.
    tagged = written(ordered.withColumn("_piece", F.shiftright("_row", _PIECE_BITS)), f"{name}-order")
    pieces = tagged.groupBy("tree", "_piece").agg(F.min("_row").alias("_first"), F.count("*").alias("_k"))
    offsets = pieces.selectExpr(
        "tree", "_piece", "_first",
        "coalesce(sum(_k) over (partition by tree order by _piece rows between unbounded preceding and 1 preceding), 0) as _before",
        "sum(_k) over (partition by tree) as n",
    )
    return written(
        tagged.join(offsets, ["tree", "_piece"])
        .withColumn("at", F.col("_row") - F.col("_first") + F.col("_before"))
        .drop("_row", "_piece", "_first", "_before"),
        name,
    )


def grow(leaves: DataFrame, name: str) -> DataFrame:
    """(tree, level, at, n, hash) of all nodes above the leaves (tree, at, n, hash).

    `n` is the number of leaves of the tree.
    """

    def climb(key, table):
        tree, block, level, n = key[0].as_py(), key[1].as_py(), key[2].as_py(), key[3].as_py()
        hashes = table.column("hash").take(pa.array(np.argsort(table.column("at").to_numpy()))).to_pylist()
        width = n
        for _ in range(level):
            width = -(-width // ARITY)
        base, out = block << BLOCK_BITS, ([], [], [])
        for up in range(1, BLOCK_LEVELS + 1):
            if width <= 1:
                break
            hashes = [sha256("".join(hashes[i : i + ARITY]).encode()).hexdigest() for i in range(0, len(hashes), ARITY)]
            base, width = base >> ARITY_BITS, -(-width // ARITY)
            out[0].extend([level + up] * len(hashes))
            out[1].extend(range(base, base + len(hashes)))
            out[2].extend(hashes)
        size = len(out[0])
        return pa.table(
            {
                "tree": pa.array([tree] * size, pa.string()), "level": pa.array(out[0], pa.int32()),
                "at": pa.array(out[1], pa.int64()), "n": pa.array([n] * size, pa.int64()),
                "hash": pa.array(out[2], pa.string()),
            }
        )

    most = leaves.agg(F.max("n")).first()[0] or 0
    level, below, all_levels = 0, leaves.select("tree", F.lit(0).alias("level"), "at", "n", "hash"), []
    for level in range(0, max(height(most), 1), BLOCK_LEVELS):
        blocks = below.where(F.col("level") == level).withColumn("block", F.shiftright("at", BLOCK_BITS))
        below = written(
            blocks.groupBy("tree", "block", "level", "n").applyInArrow(
                climb, "tree string, level int, at long, n long, hash string"
            ),
            name,
        )
        all_levels.append(below)
    nodes = all_levels[0]
    for more in all_levels[1:]:
        nodes = nodes.unionAll(more)
    return nodes


@dataclass(frozen=True)
class Manifest:
    """`leaves`: (tree, at, n, hash, and what was given); `nodes`: every other node (tree, level, at, n,
    hash); `groups`: (tree, n, at, of, hash), each group's leaves, its place among so many groups, its root."""

    leaves: DataFrame
    nodes: DataFrame
    groups: DataFrame
    root: str | None


def manifest(rows: DataFrame, group: str, order: list[str], leaf: str = "leaf") -> Manifest:
    """Build the trees of `rows`: a leaf digest, a group column and order columns (nulls first, ties by
    leaf). Other columns stay on the leaves, but for those in `OWN`, names that the result uses itself.
    Null groups form a group of their own, the first; rows that agree in order and leaf are leaves of
    their own. A null leaf is the digest of an empty text. An empty table has no nodes and the root None.
    """
    by = [F.col(c).alias(f"_by{i}") for i, c in enumerate(order)]
    rest = [F.col(c) for c in rows.columns if c not in OWN and not c.startswith("_") and c != leaf]
    named = rows.select(
        group_key(group).alias("tree"), F.coalesce(F.col(leaf), F.sha2(F.lit(""), 256)).alias("hash"), *by, *rest
    )
    names = [f"_by{i}" for i in range(len(by))]
    leaves = placed(named, [*names, "hash"], "leaves").drop(*names)
    nodes = grow(leaves, "nodes")
    whole = leaves.where("n = 1").select("tree", "n", "hash").unionAll(
        nodes.where(top_level("n") == F.col("level")).where("n > 1").select("tree", "n", "hash")
    )
    tops = placed(
        whole.select(F.lit(TOP).alias("tree"), F.col("tree").alias("group"), F.col("n").alias("size"), "hash"),
        ["group"], "groups",
    )
    above = grow(tops.select("tree", "at", "n", "hash"), "top")
    last = above.where(top_level("n") == F.col("level")).unionByName(
        tops.where("n = 1").select("tree", F.lit(0).alias("level"), "at", "n", "hash")
    )
    root = last.select("hash").first()
    groups = tops.select(F.col("group").alias("tree"), F.col("size").alias("n"), "at", F.col("n").alias("of"), "hash")
    return Manifest(leaves, nodes.unionAll(above), groups, root[0] if root else None)


def top_level(n: str) -> Column:
    """`height` as an expression."""
    return F.expr(f"aggregate(sequence(0, 20), 0, (a, i) -> if({n} > shiftleft(1L, {ARITY_BITS} * i), i + 1, a))")


def runs_of(known: np.ndarray, n: int):
    """Level by level from `known` positions among n leaves: (level, known, runs, members, missing).

    `members` are all positions of the runs that hold known nodes, `missing` those that are not known.
    The runs are what is known one level up.
    """
    level, width = 0, n
    while width > 1:
        runs = np.unique(known >> ARITY_BITS)
        members = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        members = members[members < width]
        yield level, known, runs, members, np.setdiff1d(members, known, assume_unique=True)
        known, width, level = runs, -(-width // ARITY), level + 1


def missing_nodes(asked: DataFrame) -> DataFrame:
    """(tree, block, of_tree, level, at): what the asked leaves of each block lack to derive the root."""

    def run(key, table):
        tree, block = key[0].as_py(), key[1].as_py()
        n, place, groups = (int(table.column(c)[0].as_py()) for c in ("n", "place", "groups"))
        trees, levels, at = [], [], []
        for of_tree, known, width in (
            (tree, np.unique(table.column("at").to_numpy()), n), (TOP, np.array([place]), groups),
        ):
            for level, _, _, _, lacking in runs_of(known, width):
                trees += [of_tree] * len(lacking)
                levels += [level] * len(lacking)
                at += lacking.tolist()
        size = len(at)
        return pa.table(
            {
                "tree": pa.array([tree] * size, pa.string()), "block": pa.array([block] * size, pa.int64()),
                "of_tree": pa.array(trees, pa.string()), "level": pa.array(levels, pa.int32()),
                "at": pa.array(at, pa.int64()),
            }
        )

    return asked.select("tree", "block", "at", "n", "place", "groups").groupBy("tree", "block").applyInArrow(
        run, "tree string, block long, of_tree string, level int, at long"
    )


def steps_of(known: dict[int, str], n: int, lookup) -> tuple[dict[int, list[tuple[str, str]]], str]:
    """From digests of some leaves: their steps (digests to the left and right of the own node, level by
    level) and the root. `lookup(level, at)` gives the digests that are missing."""
    start = sorted(known)
    chain = {p: [] for p in start}
    inside = {p: [p] for p in start}  # known node -> asked leaves below it
    for level, now, runs, members, lacking in runs_of(np.array(start, np.int64), n):
        fetched = {p: lookup(level, p) for p in lacking.tolist()}
        up, below, at = {}, {}, 0
        members = members.tolist()
        for run in runs.tolist():
            own = []
            while at < len(members) and members[at] >> ARITY_BITS == run:
                own.append(members[at])
                at += 1
            joined = "".join(known[p] if p in known else fetched[p] for p in own)
            up[run], below[run] = sha256(joined.encode()).hexdigest(), []
            for k, p in enumerate(own):
                if p in known:
                    step = (joined[: HEX * k], joined[HEX * (k + 1) :])
                    for leaf in inside[p]:
                        chain[leaf].append(step)
                    below[run] += inside[p]
        known, inside = up, below
    return chain, next(iter(known.values()))


def prove(m: Manifest, asked: DataFrame | None = None) -> DataFrame:
    """The asked leaves (rows of `m.leaves`; all of them by default) with `subroot`, `root` and `proof`.

    `proof` is an array of (left, right), one per level through the group's tree and then the top tree:
    the digests of the run's other nodes before and after the own one, concatenated. `subroot` and
    `root` are derived from the asked leaves and the fetched nodes, not read. No asked rows give an
    empty table. Repeated rows have equal proofs.
    """
    asked = m.leaves if asked is None else asked
    kept = [f for f in asked.schema.fields if f.name not in ("tree", "at", "n", "hash")]
    places = m.groups.select("tree", F.col("at").alias("place"), F.col("of").alias("groups"))
    dealt = asked.join(places, "tree").withColumn("block", F.shiftright("at", BLOCK_BITS))
    nodes = m.leaves.select("tree", F.lit(0).alias("level"), "at", "hash").unionAll(
        m.nodes.select("tree", "level", "at", "hash")
    ).unionAll(m.groups.select(F.lit(TOP).alias("tree"), F.lit(0).alias("level"), "at", "hash"))
    wanted = written(missing_nodes(dealt), "missing")
    fetched = wanted.join(
        nodes.withColumnRenamed("tree", "of_tree"), ["of_tree", "level", "at"]
    ).select("tree", "block", F.col("of_tree").alias("_of"), F.col("level").alias("_level"), F.col("at").alias("_at"),
             F.col("hash").alias("_hash"))

    def expand(key, rows, found):
        if not rows.num_rows:
            return rows.select([f.name for f in kept]).append_column("leaf", pa.array([], pa.string())).append_column(
                "subroot", pa.array([], pa.string())
            ).append_column("root", pa.array([], pa.string())).append_column("proof", pa.array([], PROOF))
        tree = key[0].as_py()
        have = {
            (t, lv, p): h
            for t, lv, p, h in zip(*(found.column(c).to_pylist() for c in ("_of", "_level", "_at", "_hash")))
        }
        at, leaves = rows.column("at").to_pylist(), rows.column("hash").to_pylist()
        n, place, groups = (rows.column(c)[0].as_py() for c in ("n", "place", "groups"))
        chain, subroot = steps_of(dict(zip(at, leaves)), n, lambda lv, p: have[tree, lv, p])
        last, root = steps_of({place: subroot}, groups, lambda lv, p: have[TOP, lv, p])
        steps = [chain[p] + last[place] for p in at]
        ends = np.concatenate([[0], np.cumsum([len(s) for s in steps])]).astype(np.int32)
        pairs = pa.StructArray.from_arrays(
            [pa.array([x[i] for s in steps for x in s], pa.string()) for i in (0, 1)], ["left", "right"]
        )
        return (
            rows.select([f.name for f in kept])
            .append_column("leaf", rows.column("hash"))
            .append_column("subroot", pa.array([subroot] * len(at), pa.string()))
            .append_column("root", pa.array([root] * len(at), pa.string()))
            .append_column("proof", pa.ListArray.from_arrays(ends, pairs).cast(PROOF))
        )

    columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept]
    schema = ", ".join([*columns, "leaf string", "subroot string", "root string", "proof array<struct<left:string,right:string>>"])
    return dealt.groupBy("tree", "block").cogroup(fetched.groupBy("tree", "block")).applyInArrow(expand, schema)


PROOF = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def fold(leaf: str, proof: str = "proof") -> Column:
    """The root that a leaf digest and a proof give."""
    return F.expr(f"aggregate({proof}, {leaf}, (a, s) -> sha2(concat(s.left, a, s.right), 256))")


def proof_digest(proof: str = "proof") -> Column:
    """SHA-256 of a proof's digests, level by level, left to right."""
    return F.expr(f"sha2(array_join(transform({proof}, s -> concat(s.left, s.right)), ''), 256)")

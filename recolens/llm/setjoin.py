"""Documents linked by the Jaccard similarity of their word n-grams: a grouped prefix join.

* Each set keeps a prefix, its smallest shingle hashes. With o the least overlap of a set of n shingles
  with any partner, two linked sets have at least `ROOM` (or o, if that is smaller) shingles of their
  prefixes of n - o + ROOM shingles in common.
* Documents with equal sets are one set, and sets with the same size and the same prefix are one
  group; groups, not documents, are posted and compared.
* Inside the prefixes shingles are ordered by the number of groups that have them. What one group alone
  has can't meet; a group that shares fewer prefix shingles than it needs is dropped, and the others are
  posted under the rarest shingles only, as many as the needed overlap leaves.
* Group pairs are filtered by size and by the overlap of their prefixes. A posting list is never
  expanded into pairs: its members meet its two ends, and where that leaves it in several parts, it is
  compared in bounded blocks that return joining edges only. This gives candidate clusters of groups.
* Clusters are expanded to their members, which are verified on full sets: each member in one block
  of its cluster, together with the cluster's first set. Only where a larger cluster is still in several
  parts, members outside its largest part meet all others in bounded blocks.

Everything is exact: no cap drops a pair, and the order of the shingles changes the work only.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recolens.llm.graph import components
from recolens.llm.minhash import in_blocks, joining_edges, overlaps
from recolens.llm.store import drop_written, written
from recolens.llm.tokens import Words, mix, pieces, shingle_set, signed
from recolens.operators.skew import broadcast_if_small

#: Prefix shingles that linked sets have in common at least (fewer only where the sets are smaller).
ROOM = 32
LIST_BLOCK = 512
BLOCK_SETS = 256
BLOCK_SHINGLES = 120_000


def least_overlap(n: np.ndarray | int, percent: int):
    """The smallest overlap of a set of n shingles with any set it is linked to."""
    return (percent * n + 99) // 100


def set_rows(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, text_key, n_shingles, set_a, set_b, prefix_a, prefix_b, prefix): 128-bit hashes of the
    set and of its prefix, and the prefix as sorted hashes (null for an empty set)."""
    names = ["doc_id", "text_key", "n_shingles", "set_a", "set_b", "prefix_a", "prefix_b", "prefix"]

    def run(batches):
        for batch in batches:
            for part in pieces(batch, 1):
                words = Words(part.column(1))
                count, sums, prefix = [], ([], [], [], []), []
                for i in range(part.num_rows):
                    s = shingle_set(words.hash[words.first[i] : words.first[i + 1]], size)
                    least = least_overlap(len(s), percent)
                    p = s[: len(s) - least + min(ROOM, least)]
                    count.append(len(s))
                    for out, x in zip(sums, (s, ~s, p, ~p)):
                        out.append(mix(x).sum(dtype=np.uint64))
                    prefix.append(p.tobytes() if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), part.column(2), pa.array(count, pa.int64()),
                        *[pa.array(signed(np.array(x, np.uint64))) for x in sums], pa.array(prefix, pa.binary()),
                    ],
                    names,
                )

    kinds = ", ".join(f"{c} long" for c in names[:-1])
    return docs.select("doc_id", "text", "text_key").mapInArrow(run, f"{kinds}, prefix binary")


def posted(groups: DataFrame) -> DataFrame:
    """(gid, token) for every prefix shingle of every group."""

    def run(batches):
        for batch in batches:
            prefixes = [np.frombuffer(b, np.int64) for b in batch.column(1).to_pylist()]
            gids = np.repeat(batch.column(0).to_numpy(), [len(p) for p in prefixes])
            tokens = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            for lo in range(0, len(gids), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gids[lo : lo + (1 << 16)]), pa.array(tokens[lo : lo + (1 << 16)])], ["gid", "token"]
                )

    return groups.select("gid", "prefix").mapInArrow(run, "gid long, token long")


def halves(groups: DataFrame) -> DataFrame:
    """(gid, n, half): the distinct lower halves of the prefix hashes, sorted, for comparing prefixes."""

    def run(batches):
        for batch in batches:
            low = [np.unique(np.frombuffer(b, np.uint64).astype(np.uint32)) for b in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([x.tobytes() for x in low], pa.binary())], ["gid", "n", "half"]
            )

    return groups.select("gid", "n", "prefix").mapInArrow(run, "gid long, n long, half binary")


def close(n_a, n_b, common, lost, percent: int):
    """Whether sets of these sizes may be linked with so many half hashes of their prefixes in common.

    `lost` shingles of a prefix have the half hash of another one; they may all be common ones.
    """
    low, high = np.minimum(n_a, n_b), np.maximum(n_a, n_b)
    need = np.minimum(ROOM, least_overlap(high, percent))
    return (100 * low >= percent * high) & (common + lost >= need)


def lost_halves(n, sizes, percent: int):
    """How many prefix shingles of sets of n shingles have no half hash of their own."""
    least = least_overlap(n, percent)
    return n - least + np.minimum(ROOM, least) - sizes


def candidate_clusters(groups: DataFrame, percent: int) -> DataFrame:
    """(gid, cluster) for all groups that are, directly or over others, candidates for a link."""
    posts = posted(groups)
    # A statement of its own: the shuffle of the counts is gone when the posts are shuffled.
    counts = written(posts.groupBy("token").agg(F.count("*").alias("f")).where("f > 1"), "counts")
    needs = F.expr(f"least({ROOM}, ({percent} * n + 99) div 100)")
    sizes = groups.select("gid", "n", needs.alias("need"))
    shared = posts.join(counts, "token").groupBy("gid").agg(F.sort_array(F.collect_list(F.struct("f", "token"))).alias("t"))
    # Shingles of one group alone come first in the order, so they use up the index prefix first.
    index = (
        shared.join(sizes, "gid")
        .where(F.size("t") >= F.col("need"))
        .select("gid", "n", F.explode(F.expr("slice(t, 1, size(t) - need + 1)")).alias("t"))
        .select("gid", "n", F.col("t.token").alias("token"))
    )
    # Two linked sets are in the same or in neighbouring size classes; list (token, c) has classes c - 1 and c.
    width = math.log(100 / percent) * (1 + 1e-9)
    size_class = f"cast(floor(ln(n) / {width!r}) as long)" if width else "n"
    index = written(index.withColumn("c", F.expr(f"explode(array({size_class}, {size_class} + 1))")), "prefix")
    drop_written(counts)
    lists = index.groupBy("token", "c").agg(
        F.min("gid").alias("lo"), F.max("gid").alias("hi"), F.count("*").alias("members"), F.bit_xor(F.xxhash64("gid")).alias("mark")
    ).where("lo <> hi")
    # Lists with the same members are one.
    ends = lists.groupBy("lo", "hi", "members", "mark").agg(F.min(F.struct("token", "c")).alias("e"))
    ends = written(ends.select("lo", "hi", "members", "e.token", "e.c"), "lists")
    kept = written(index.join(ends, ["token", "c"]).select("token", "c", "gid", "n", "lo", "hi", "members"), "kept")
    for done in (index, ends):
        drop_written(done)
    held = written(halves(groups.join(kept.select("gid").distinct(), "gid", "left_semi")), "halves")

    def filtered(batches):
        for batch in batches:
            a, b = (batch.column(c).to_pylist() for c in ("half", "other"))
            common = np.array(
                [len(np.intersect1d(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), True)) for x, y in zip(a, b)],
                np.int64,
            )
            n, m = (batch.column(c).to_numpy() for c in ("n", "m"))
            lost = lost_halves(n, np.array([len(x) // 4 for x in a], np.int64), percent)
            yield batch.select(["a", "b"]).filter(pa.array(close(n, m, common, lost, percent), pa.bool_()))

    def filter_pairs(pairs: DataFrame) -> DataFrame:
        """Those of the pairs (gid, end) that may be linked, as (a, b)."""
        return (
            pairs.join(held, "gid")
            .join(held.select(F.col("gid").alias("end"), F.col("n").alias("m"), F.col("half").alias("other")), "end")
            .where(F.expr(f"100 * least(n, m) >= {percent} * greatest(n, m)"))
            .select(F.col("gid").alias("a"), F.col("end").alias("b"), "n", "m", "half", "other")
            .mapInArrow(filtered, "a long, b long")
        )

    # First the two outermost ends over all lists of a group, then the ends that this leaves in another part.
    outer = kept.groupBy("gid").agg(F.array(F.min("lo"), F.max("hi")).alias("end")).select("gid", F.explode("end").alias("end"))
    near = written(filter_pairs(outer.where("gid <> end").distinct()), "near")
    part = components(near)
    pairs = kept.select("gid", F.explode(F.array("lo", "hi")).alias("end")).where("gid <> end").distinct()
    apart = (
        pairs.join(part.select(F.col("node").alias("gid"), "component"), "gid", "left")
        .join(part.select(F.col("node").alias("end"), F.col("component").alias("other")), "end", "left")
        .where("coalesce(component, gid) <> coalesce(other, end)").select("gid", "end")
    )
    near = written(near.unionAll(filter_pairs(apart)), "near-all")
    part = components(near)
    member = kept.join(part.withColumnRenamed("node", "gid"), "gid", "left").withColumn(
        "component", F.coalesce("component", "gid")
    )
    several = (
        member.groupBy("token", "c").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
        .where("lo <> hi").select("token", "c")
    )
    rest = in_blocks(
        member.join(several, ["token", "c"]).drop("n").join(held, "gid"), F.ceil(F.col("members") / LIST_BLOCK), "gid"
    )

    def compare(key, table):
        gid, n, own = (table.column(c).to_numpy() for c in ("gid", "n", "component"))
        gid, first = np.unique(gid, return_index=True)
        n, own, raw = n[first], own[first], table.column("half").to_pylist()
        prefixes = [np.frombuffer(raw[i], np.uint32) for i in first]
        lost = lost_halves(n, np.array([len(x) for x in prefixes]), percent)
        rows, cols = [], []
        for lo in range(0, len(gid), 128):
            some = slice(lo, lo + 128)
            fits = (own[some][:, None] != own[None, :]) & (100 * np.minimum.outer(n[some], n) >= percent * np.maximum.outer(n[some], n))
            which = np.flatnonzero(fits.any(axis=0))
            if len(which):
                common = overlaps(prefixes[some], [prefixes[i] for i in which])
                near_enough = close(n[some][:, None], n[which][None, :], common, lost[some][:, None], percent)
                r, c = np.nonzero(fits[:, which] & near_enough)
                rows.append(r + lo)
                cols.append(which[c])
        found = joining_edges(len(gid), np.concatenate(rows), np.concatenate(cols)) if rows else []
        return pa.table({k: pa.array([int(gid[e[i]]) for e in found], pa.int64()) for i, k in enumerate("ab")})

    more = rest.select("token", "c", "x", "y", "gid", "n", "component", "half").groupBy("token", "c", "x", "y").applyInArrow(
        compare, "a long, b long"
    )
    clusters = components(near.unionAll(more)).select(F.col("node").alias("gid"), F.col("component").alias("cluster"))
    for done in (kept, held):
        drop_written(done)
    return clusters


def verified_edges(blocks: DataFrame, size: int, percent: int) -> DataFrame:
    """Joining edges (a, b) of the linked pairs in each block (cluster, x, y) of (rep, part, side, text).

    Pairs are of the two sides where x <> y, else of all rows; pairs inside one part are left out.
    """

    def compare(key, table):
        full, rows = {}, {}
        for rep, part, side in zip(*(table.column(c).to_pylist() for c in ("rep", "part", "side"))):
            rows[rep] = (part, side)  # repeated rows count once
        for batch in table.select(["text", "rep"]).to_batches():
            for piece in pieces(batch, 0):
                words = Words(piece.column(0))
                for i, rep in enumerate(piece.column(1).to_pylist()):
                    full[rep] = shingle_set(words.hash[words.first[i] : words.first[i + 1]], size)
        reps = np.array(list(rows), np.int64)
        part, side = (np.array([v[k] for v in rows.values()], np.int64) for k in (0, 1))
        whole = key[1].as_py() == key[2].as_py()
        one = np.arange(len(reps)) if whole else np.flatnonzero(side == 0)
        two = one if whole else np.flatnonzero(side == 1)
        found = []
        if len(one) and len(two):
            both = overlaps([full[x] for x in reps[one].tolist()], [full[x] for x in reps[two].tolist()])
            length = np.array([len(full[x]) for x in reps.tolist()])
            union = length[one][:, None] + length[two][None, :] - both
            linked = (100 * both >= percent * union) & (part[one][:, None] != part[two][None, :])
            r, c = np.nonzero(linked)
            found = joining_edges(len(reps), one[r], two[c])
        return pa.table({k: pa.array([int(reps[e[i]]) for e in found], pa.int64()) for i, k in enumerate("ab")})

    return blocks.select("cluster", "x", "y", "rep", "part", "side", "text").groupBy("cluster", "x", "y").applyInArrow(
        compare, "a long, b long"
    )


def confirmed_links(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Joining edges (a, b) of all linked pairs inside the clusters of (rep, cluster, n, doc_id, text_key)."""
    sums = members.groupBy("cluster").agg(
        F.count("*").alias("k"), F.sum("n").alias("w"), F.min("rep").alias("first")
    ).withColumn("blocks", F.expr(f"cast(least(k, greatest(ceil(k / {BLOCK_SETS}), ceil(w / {BLOCK_SHINGLES}))) as int)"))
    held = written(
        members.join(sums, "cluster").join(texts, ["doc_id", "text_key"])
        .select("cluster", "rep", "n", "k", "first", "blocks", "text"),
        "members",
    )
    # Neighbours in size share a block; the cluster's first set is in every block.
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    home = held.withColumn("x", F.when(F.col("rep") == F.col("first"), F.sequence(F.lit(0), F.col("blocks") - 1)).otherwise(F.array(own)))
    home = home.select("cluster", "rep", F.explode("x").alias("x"), "text").withColumn("y", F.col("x"))
    edges = written(
        verified_edges(home.select("*", F.col("rep").alias("part"), F.lit(0).alias("side")), size, percent), "links"
    )
    # A cluster of one block is done. In the others, parts that are still apart meet.
    part = components(edges).select(F.col("node").alias("rep"), F.col("component").alias("part"))
    large = held.where("blocks > 1").select("cluster", "rep", "n", "blocks").join(part, "rep", "left").withColumn(
        "part", F.coalesce("part", "rep")
    )
    parts = large.groupBy("cluster", "part").agg(F.count("*").alias("m"), F.sum("n").alias("v"))
    main = parts.groupBy("cluster").agg(F.max(F.struct("m", "part")).alias("e"), F.count("*").alias("parts")).where(
        "parts > 1"
    ).select("cluster", F.col("e.part").alias("main"))
    left = large.join(main, "cluster").withColumn("out", F.col("part") != F.col("main"))
    width = left.groupBy("cluster").agg(
        *[F.expr(f"cast(greatest(1, ceil(count_if({c}) / {BLOCK_SETS}), ceil(sum(if({c}, n, 0)) / {BLOCK_SHINGLES})) as int)").alias(name)
          for c, name in (("out", "n_out"), ("not out", "n_main"))]
    )
    left = written(left.join(width, "cluster").select("cluster", "rep", "part", "out", "n_out", "n_main"), "apart")
    here = F.pmod(F.xxhash64("rep"), F.when(F.col("out"), F.col("n_out")).otherwise(F.col("n_main"))).cast("int")
    left = left.withColumn("b", here)
    # Blocks of the outside are 0 .. n_out - 1, those of the largest part follow with negative numbers.
    main_rows = left.where("not out").select(
        "cluster", "rep", "part", F.expr("explode(sequence(0, n_out - 1))").alias("x"), (-1 - F.col("b")).alias("y"), F.lit(1).alias("side")
    )
    out_rows = left.where("out")
    to_main = out_rows.select(
        "cluster", "rep", "part", F.col("b").alias("x"), F.expr("explode(transform(sequence(0, n_main - 1), i -> -1 - i))").alias("y"),
        F.lit(0).alias("side"),
    )
    among = out_rows.select("cluster", "rep", "part", "b", F.expr("explode(sequence(0, n_out - 1))").alias("o")).select(
        "cluster", "rep", "part", F.least("b", "o").alias("x"), F.greatest("b", "o").alias("y"),
        F.when((F.col("b") == F.greatest("b", "o")) & (F.col("b") != F.col("o")), 1).otherwise(0).alias("side"),
    )
    dealt = main_rows.unionAll(to_main).unionAll(among).join(held.select("cluster", "rep", "text"), ["cluster", "rep"])
    return edges.unionAll(verified_edges(dealt, size, percent))


def jaccard_components(
    docs: DataFrame, size: int = 3, percent: int = 90, doc: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of `docs`.

    Documents are linked when 100 * |intersection| >= percent * |union| of their sets of `size`-word
    shingles (with fewer words, the whole sequence as one); component_id is the smallest doc_id reachable
    over links. Null and empty texts, and texts without words, have the empty set and no link. Repeated
    rows with one doc_id are one node, whatever their texts. A row without doc_id can't be named: it is
    linked with nothing and its component_id is null. An empty table gives an empty result. Other columns
    of `docs` are ignored, whatever their names.
    """
    docs = docs.select(
        F.col(doc).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    ).withColumn("text_key", F.xxhash64("text"))
    rows = written(set_rows(docs, size, percent), "sets")
    named = rows.where("doc_id is not null and n_shingles > 0")
    key, same = ["set_a", "set_b", "n_shingles"], ["n_shingles", "prefix_a", "prefix_b"]
    # A document is the node of its set; an id that stands for several sets gets a node for each of them.
    several = named.select("doc_id", *key).distinct().groupBy("doc_id").agg(F.count("*").alias("k")).where("k > 1")
    node = F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(
        F.lit(-(2**62)) - F.pmod(F.xxhash64("doc_id", "set_a", "set_b"), F.lit(2**61))
    )
    named = named.join(broadcast_if_small(several), "doc_id", "left").withColumn("rep", node).drop("k")
    sets = named.groupBy(*key).agg(F.min(F.struct("rep", "doc_id", "text_key", "prefix_a", "prefix_b")).alias("first"))
    sets = written(sets.select(*key, "first.*"), "distinct")
    groups = named.groupBy(*same).agg(F.min(F.struct("rep", "prefix")).alias("e")).select(
        *same, F.col("e.rep").alias("gid"), F.col("n_shingles").alias("n"), F.col("e.prefix").alias("prefix")
    )
    groups = written(groups, "groups")
    of_set = written(sets.join(groups.select(*same, "gid"), same), "expanded")
    # Prefixes are in the groups now; what follows needs the rows without them.
    wide, rows = rows, written(rows.select("doc_id", *key), "rows")
    drop_written(wide)

    clusters = candidate_clusters(groups, percent)
    crowded = of_set.groupBy("gid").agg(F.count("*").alias("k")).where("k > 1").select("gid")
    clusters = clusters.unionByName(crowded.join(clusters, "gid", "left_anti").select("gid", F.col("gid").alias("cluster")))
    clusters = written(clusters, "clusters")
    drop_written(groups)
    members = of_set.join(clusters, "gid").select("rep", "cluster", F.col("n_shingles").alias("n"), "doc_id", "text_key")
    links = confirmed_links(members, docs, size, percent)
    named = rows.where("doc_id is not null and n_shingles > 0")
    of_row = named.select("doc_id", *key).distinct().join(sets.select(*key, "rep"), key).select("doc_id", "rep")
    by_id = of_row.where("doc_id <> rep").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    part = components(links.unionAll(by_id))
    names = part.groupBy("component").agg(F.min(F.when(F.col("node") > -(2**62), F.col("node"))).alias("component_id"))
    part = part.join(names, "component").select(F.col("node").alias("doc_id"), "component_id")
    return rows.select("doc_id", "n_shingles").join(part, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )

"""Prefix trie of conversations, peeled from its deepest turns towards the root.

A node of depth d is a distinct sequence of first d turns (role, text). Peeling starts at the maximum
depth: the conversations that end there and the nodes that survive from one level below, their last
turn stripped, are grouped by the prefix that is left. One grouping thus discovers a level's nodes and
closes their aggregates (members, children, leaves, saved characters), and its rows are the survivors
of the next. Each level is written once.

Before the descent, what needs no round is taken off: equal conversations are one, and a conversation
is cut one turn below its longest prefix that another one shares. What hangs below the cut is a path
with the members of one conversation, whose nodes follow from running sums. So the number of rounds is
the longest prefix that two different conversations share, however long a single one is.

A turn travels as a digest and a length, never as its text. A prefix is known by the sums of 4 x 32
bits that each (position, role, digest of the text) contributes: a running sum, so a conversation that
holds a large part of all rows is spread over tasks (`skew.running_sums`). Two different prefixes would
be taken for one with a chance of 2 ** -128.
"""

from __future__ import annotations

from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from recolens.llm.store import shared_folder, written
from recolens.operators import skew

#: Conversation ids that are put into one text at a time, for the digest of a node's ends.
CELL = 4096

_LOW = 0xFFFFFFFF
_SUMS = ("w0", "w1", "w2", "w3")


def turn_rows(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """(conv_id, pos, role, digest, chars): the turns of each conversation, numbered from 1.

    Ordered by turn, nulls first, ties by role and the digest of the text. Null roles and texts are
    empty. Rows without conv_id belong to no conversation and are left out. Other columns are ignored.
    """
    said = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = turns.where(F.col(conv).isNotNull()).select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.sha2(said, 256).alias("digest"),
        F.char_length(said).cast("long").alias("chars"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    if skew.hot_keys(rows.select("conv_id"), ["conv_id"]) is None:
        hot = None
    else:
        rows = written(rows, "turns")
        hot = skew.hot_keys(rows.select("conv_id"), ["conv_id"])
    return written(skew.numbered(rows, ["conv_id"], order, "pos", "total", hot).drop("turn", "total"), "numbered")


def respliced(rows: DataFrame, base: Column, heads: Column, most: int) -> DataFrame:
    """Rebuilt conversations (conv_id, pos, role, digest, chars) from `turn_rows`.

    `base` and `heads` (at most `most`) are expressions on conv_id: a conversation becomes the first
    `heads` turns of conversation `base` (all if it has fewer, none if it is absent) and its own turns
    after its first `heads`.
    """
    held = rows.where(F.col("pos") == 1).select("conv_id", base.alias("base"), heads.alias("h"))
    first = rows.where(F.col("pos") <= most).select(F.col("conv_id").alias("base"), "pos", "role", "digest", "chars")
    head = held.join(first, "base").where("pos <= h").select("conv_id", "pos", "role", "digest", "chars")
    have = first.groupBy("base").agg(F.max("pos").alias("have"))
    own = (
        rows.select("*", base.alias("base"), heads.alias("h")).where("pos > h")
        .join(have, "base", "left")
        .withColumn("pos", F.expr("pos - h + least(h, coalesce(have, 0))"))
    )
    return head.unionAll(own.select("conv_id", "pos", "role", "digest", "chars"))


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, d, k1, k2, chars, upto): the key of every prefix and the characters up to its end."""
    parts = [F.xxhash64(F.lit(s), "pos", "role", "digest") for s in (1, 2)]
    words = [w for p in parts for w in (p.bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned(p, 32))]
    marked = rows.select("conv_id", "pos", "chars", *[w.alias(c) for w, c in zip(words, _SUMS)])
    marked = written(marked, "contributions")
    sums = skew.running_sums(marked, ["conv_id"], "pos", {f"s_{c}": c for c in (*_SUMS, "chars")})
    keys = [F.xxhash64(F.lit(s), "pos", *[f"s_{c}" for c in _SUMS]).alias(f"k{s}") for s in (1, 2)]
    return written(
        sums.select("conv_id", F.col("pos").cast("int").alias("d"), *keys, "chars", F.col("s_chars").alias("upto")),
        "prefixes",
    )


def ends_digests(ends: DataFrame) -> DataFrame:
    """(len, k1, k2, ends_sha256) from (conv_id, len, k1, k2): the ids that end at a node, ascending.

    Ids are joined in cells of `CELL` first. A node with one cell is done; the cells of the others are
    streamed in order through one hash, so that only a cell is ever held.
    """
    cells = written(
        ends.groupBy("len", "k1", "k2", F.expr(f"floor(conv_id / {CELL})").alias("cell"))
        .agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .select("len", "k1", "k2", "cell", F.expr("array_join(transform(ids, i -> cast(i as string)), ',')").alias("ids")),
        "ends",
    )
    number = cells.groupBy("len", "k1", "k2").agg(F.count("*").alias("n"))
    one = cells.join(number.where("n = 1"), ["len", "k1", "k2"]).select("len", "k1", "k2", F.sha2("ids", 256).alias("ends_sha256"))
    several = cells.join(number.where("n > 1").drop("n"), ["len", "k1", "k2"], "left_semi")

    def run(batches):
        at, hasher, out = None, None, []
        for batch in batches:
            for key in zip(*(batch.column(i).to_pylist() for i in range(5))):
                if key[:3] != at:
                    if at is not None:
                        out.append((*at, hasher.hexdigest()))
                    at, hasher = key[:3], sha256(key[4].encode())
                else:
                    hasher.update(b"," + key[4].encode())
        if at is not None:
            out.append((*at, hasher.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[i] for x in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.string()))],
            ["len", "k1", "k2", "ends_sha256"],
        )

    order = ["len", "k1", "k2", "cell"]
    streamed = several.repartition("len", "k1", "k2").sortWithinPartitions(*order).mapInArrow(
        run, "len int, k1 long, k2 long, ends_sha256 string"
    )
    return one.unionAll(streamed)


NO_ENDS = sha256(b"").hexdigest()


def prefix_trie(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id (the parent's conv_id, null for
    the root), n_convs (members), n_children, n_leaves (childless nodes of the subtree, itself included),
    saved_tokens (over the subtree, (n_convs - 1) times the characters of a node's last text) and
    ends_sha256 (SHA-256 of the ids that end here, ascending, joined by commas).

    `rows` has (conv_id, pos from 1, role, digest, chars), see `turn_rows`; `conversations` has the
    conv_id of all conversations, those without a row included. No conversation gives no node, not even
    a root. Repeated turns are turns of their own, repeated conversations members of the same nodes.
    """
    prefix = prefixes(rows)
    last = prefix.groupBy("conv_id").agg(F.max(F.struct("d", "k1", "k2", "upto")).alias("e"))
    ended = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct().join(last, "conv_id", "left")
    ended = written(
        ended.select(
            "conv_id", F.coalesce("e.d", F.lit(0)).alias("len"), F.coalesce("e.k1", F.lit(0)).alias("k1"),
            F.coalesce("e.k2", F.lit(0)).alias("k2"), F.coalesce("e.upto", F.lit(0)).alias("total"),
        ),
        "ended",
    )
    distinct = ended.groupBy("len", "k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.max("total").alias("total")
    )
    distinct = written(distinct.join(ends_digests(ended), ["len", "k1", "k2"]).drop("k1", "k2"), "distinct")

    paths = written(prefix.join(distinct.select("conv_id"), "conv_id", "left_semi"), "paths")
    shared = paths.groupBy("d", "k1", "k2").agg(F.count("*").alias("m")).where("m > 1").drop("m")
    depth = paths.join(shared, ["d", "k1", "k2"], "left_semi").groupBy("conv_id").agg(F.max("d").alias("shared"))
    cut = distinct.join(depth, "conv_id", "left").withColumn("t", F.expr("least(len, coalesce(shared, 0) + 1)")).drop("shared")
    cut = written(cut, "cut")

    below = paths.join(cut, "conv_id")
    tails = below.where("d > t").select(
        "conv_id", F.col("d").alias("depth"), F.col("conv_id").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        (F.col("d") < F.col("len")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"),
        F.expr("(n - 1) * (total - upto + chars)").alias("saved_tokens"),
        F.when(F.col("d") == F.col("len"), F.col("ends_sha256")).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    path = below.where("d <= t").groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("d", "k1", "k2", "chars"))).alias("path"), F.max("upto").alias("upto")
    )
    entries = cut.join(path, "conv_id", "left").select(
        "conv_id", "t", F.coalesce("path", F.expr("cast(array() as array<struct<d:int,k1:bigint,k2:bigint,chars:bigint>>)")).alias("path"),
        F.col("n").alias("n_convs"),
        (F.col("t") < F.col("len")).cast("long").alias("children"),
        (F.col("t") < F.col("len")).cast("long").alias("leaves"),
        F.when(F.col("t") < F.col("len"), F.expr("(n - 1) * (total - upto)")).otherwise(0).alias("saved"),
        F.when(F.col("t") == F.col("len"), F.col("ends_sha256")).alias("ends"),
    )
    nodes = peeled(entries)
    parents = nodes.select(
        (F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id")
    )
    merged = nodes.join(parents, ["depth", "p1", "p2"], "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256"),
    )
    return merged.unionByName(tails).withColumn("depth", F.col("depth").cast("long"))


def peeled(entries: DataFrame) -> DataFrame:
    """The nodes (depth, k1, k2, p1, p2, conv_id, n_convs, n_children, n_leaves, saved, ends) of a trie.

    An entry joins the descent at depth `t`, the length of its `path`: a conversation that ends there, or
    one with an unshared tail below, which counts as a child with one leaf.
    """
    spark = entries.sparkSession
    started = shared_folder(spark, "entries")
    entries.repartitionByRange("t", "conv_id").write.partitionBy("t").parquet(started)
    entries = spark.read.schema(entries.schema).parquet(started)
    deepest = entries.agg(F.max("t")).first()[0]
    levels = shared_folder(spark, "levels")
    columns = ["conv_id", "path", "n_convs", "children", "leaves", "saved", "ends"]
    survivors = None
    for d in range(-1 if deepest is None else deepest, -1, -1):
        now = entries.where(F.col("t") == d).select(*columns)
        if survivors is not None:
            now = now.unionByName(survivors)
        at = F.expr("element_at(path, -1)") if d else F.lit(None)
        keys = [at[f"k{i}"].alias(f"k{i}") for i in (1, 2)] if d else []
        level = now.groupBy(*keys).agg(
            F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.sum("children").alias("n_children"),
            F.sum("leaves").alias("below"), F.sum("saved").alias("saved_below"), F.max("ends").alias("ends"),
            F.any_value("path").alias("path"),
        )
        own = "element_at(path, -1).chars" if d else "0"
        up = [F.expr(f"path[{d - 2}].k{i}") if d > 1 else F.lit(0) for i in (1, 2)]
        level = level.select(
            *[F.col(f"k{i}") if d else F.lit(0).cast("long").alias(f"k{i}") for i in (1, 2)],
            *[(u if d else F.lit(None)).cast("long").alias(f"p{i}") for i, u in zip((1, 2), up)],
            "conv_id", "n_convs", "n_children",
            F.when(F.col("n_children") == 0, 1).otherwise(F.col("below")).cast("long").alias("n_leaves"),
            F.expr(f"saved_below + (n_convs - 1) * {own}").cast("long").alias("saved"), "ends", "path",
        )
        level.write.parquet(f"{levels}/depth={d}")
        schema = level.schema
        survivors = spark.read.schema(schema).parquet(f"{levels}/depth={d}").select(
            "conv_id", F.expr(f"slice(path, 1, {max(d - 1, 0)})").alias("path"), "n_convs", F.lit(1).cast("long").alias("children"),
            F.col("n_leaves").alias("leaves"), "saved", F.lit(None).cast("string").alias("ends"),
        )
    if survivors is None:
        kinds = "k1 long, k2 long, p1 long, p2 long, conv_id long, n_convs long, n_children long, n_leaves long, saved long, ends string"
        return spark.createDataFrame([], f"{kinds}, depth int")
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("depth", T.IntegerType())])).parquet(levels).drop("path")

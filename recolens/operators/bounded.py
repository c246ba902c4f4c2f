"""Top-k scoring that leaves out item blocks whose norms are too small to matter.

An inner product is at most the product of the norms (Cauchy-Schwarz). Items are cut into classes of
falling norm. All queries meet the first class; the k-th score found so far is a bar that a further class can
only pass if |query| times its largest norm does. So each query needs the classes down to a depth of
its own, and a block of items is shipped only to blocks of queries that need it: what is left out is
neither multiplied nor moved. Rounds take 1, 2, 4 ... classes, and the bars rise in between. The result
is that of :func:`scoring.top_items`, ties included.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from recolens.operators import scoring
from recolens.operators.cells import top_items_by_cells
from recolens.operators.scoring import _limit, _merge, _OUT, _scorer, top_items
from recolens.operators.skew import cut

#: Items a class holds, about; also the most that one task takes of a class.
CLASS_ITEMS = 100_000
#: Most classes. Their largest norms are known to the driver.
CLASSES = 256
_SLACK = 2 * 10.0**-scoring.DIGITS  # scores are rounded before they are ranked


@dataclass(frozen=True)
class Bounded:
    """``rows``: as :func:`scoring.top_items` gives them. ``work``: per class its items, its largest norm
    and the queries that were scored against it."""

    rows: DataFrame
    work: DataFrame


def norm(vector: str) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))


def norm_classes(items: DataFrame, class_items: int = CLASS_ITEMS) -> DataFrame:
    """``items`` with ``norm`` and ``cls``: 0 for the largest norms, then on downwards.

    Equal norms are of one class, so a table of unit vectors has one; the cuts come from a sketch of the
    norms and only shift work between classes.
    """
    normed = items.withColumn("norm", norm("vec"))
    n = items.count()
    classes = min(CLASSES, math.ceil(n / class_items))
    if classes < 2:
        return normed.withColumn("cls", F.lit(0))
    shares = [1 - i / classes for i in range(1, classes)]
    cuts = normed.agg(F.percentile_approx("norm", shares, 100 * CLASSES)).first()[0]
    below = [F.when(F.col("norm") < c, 1).otherwise(0) for c in sorted(set(cuts), reverse=True)]
    return normed.withColumn("cls", sum(below[1:], below[0]))


def top_items_bounded(
    queries: DataFrame,
    items: DataFrame,
    k: int = scoring.MAX_K,
    masked: DataFrame | None = None,
    exclude_self: bool = False,
    class_items: int = CLASS_ITEMS,
    query_block: int = scoring.QUERY_BLOCK,
) -> Bounded:
    """The best items per query by inner product, see :func:`scoring.top_items` for the columns.

    Pays off where norms differ, as those of factors do; with equal norms it is one round over all.
    """
    items = cut(norm_classes(items, class_items))
    about = items.groupBy("cls").agg(F.count(F.lit(1)).alias("n_items"), F.max("norm").alias("top_norm"))
    classes = sorted(about.collect())  # at most CLASSES rows
    if not classes:
        none = top_items(queries, items.drop("norm", "cls"), k, masked, exclude_self)
        return Bounded(none, about.withColumn("n_queries", F.lit(0).cast("long")))
    first = top_items(
        queries, items.where("cls = 0").drop("norm", "cls"), k, masked, exclude_self, query_block=query_block, item_block=class_items
    )
    wants = (_limit(k) if "n" in queries.columns else F.lit(k)).cast("int")
    asked = queries.where(F.col("vec").isNotNull()).withColumn("n", wants).withColumn("norm", norm("vec"))
    if "category" not in asked.columns:
        asked = asked.withColumn("category", F.lit(None).cast("string"))
    best, met, lo, width = cut(first), [asked.count()], 1, 1
    while lo < len(classes):
        # Twice as many classes each time, as every round raises the bars for what follows.
        now, lo, width = classes[lo : lo + width], lo + width, 2 * width
        found = best.groupBy("query_id").agg(F.count(F.lit(1)).alias("got"), F.min("score").alias("bar"))
        held = asked.join(found, "query_id", "left")
        # How many of these classes can lift an item over the bar; all while the list is short.
        tops = F.array(*[F.lit(float(c.top_norm)) for c in now])
        reached = F.size(F.filter(tops, lambda top: top * F.col("norm") + F.lit(_SLACK) >= F.col("bar")))
        depth = F.when(F.coalesce("got", F.lit(0)) < F.col("n"), F.size(tops)).otherwise(reached)
        sure = F.when(F.col("got") >= F.col("n"), F.col("bar")).cast("double").alias("bar")
        held = cut(held.withColumn("depth", depth).where("depth > 0").select("query_id", "vec", "category", "n", "depth", sure))
        depths = {r.depth: r["count"] for r in held.groupBy("depth").count().collect()}  # a row a class
        met += [sum(q for d, q in depths.items() if d >= i) for i in range(1, len(now) + 1)]
        if not depths:
            break
        more = _deeper(held, items, now, depths, k, masked, exclude_self, class_items, query_block)
        best = cut(_ranked(best.unionByName(more.drop("n")), asked))
    met += [0] * (len(classes) - len(met))
    work = queries.sparkSession.createDataFrame(
        [(c.cls, c.n_items, float(c.top_norm), m) for c, m in zip(classes, met)],
        "cls int, n_items long, top_norm double, n_queries long",
    )
    return Bounded(best, work)


def _ranked(rows: DataFrame, asked: DataFrame) -> DataFrame:
    limited = rows.join(asked.select("query_id", "n"), "query_id")
    return _merge(limited, False, None).select(*[f.name for f in _OUT if f.name != "n"])


def _deeper(held, items, classes, depths, k, masked, exclude_self, class_items, query_block) -> DataFrame:
    """Queries of like depths share blocks, which hold the classes that the deepest of them needs. A query meets
    its own classes inside, so it travels once per part of the items."""
    spark = held.sparkSession
    n_held, met = sum(depths.values()), classes[: max(depths)]
    if n_held * sum(c.n_items for c in met) >= scoring.CELL_PAIRS:
        number = F.create_map(*[F.lit(x) for i, c in enumerate(met, 1) for x in (c.cls, i)])
        has, none = items.columns, F.lit(None)
        offered = items.withColumn("c", number[F.col("cls")]).where("c > 0").select(
            "product_id",
            (F.col("category") if "category" in has else none).cast("string").alias("category"),
            (F.col("is_cold") if "is_cold" in has else none).cast("boolean").alias("is_cold"),
            F.col("vec").cast("array<float>").alias("vec"),
            "c",
        )
        asked = held.withColumns({"category": F.col("category").cast("string"), "vec": F.col("vec").cast("array<float>")})
        n_items = sum(c.n_items for c in met)
        return top_items_by_cells(asked, offered, n_held, n_items, k, masked, exclude_self, classes=len(met))
    most = min(query_block, max(1, scoring.OUT_ROWS // k))
    level_of = {d: (d - 1).bit_length() for d in depths}  # depths up to 1, 2, 4 ...
    load: dict[int, int] = {}
    for d, q in depths.items():
        load[level_of[d]] = load.get(level_of[d], 0) + q
    idle = math.ceil(2 * spark.sparkContext.defaultParallelism / len(load))
    wide = {i: max(math.ceil(q / most), min(idle, math.ceil(q / scoring.LEAST_QUERIES))) for i, q in load.items()}
    n_items = {i: sum(c.n_items for c in classes[: 2**i]) for i in load}
    parts = {
        i: max(math.ceil(n / scoring.ITEM_BLOCK), min(math.ceil(n / class_items), scoring.MOST_BLOCKS))
        for i, n in n_items.items()
    }

    def table(numbers: dict) -> Column:
        return F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair])

    def dealt(column: str, count: Column) -> Column:
        return F.pmod(F.xxhash64(column), count).cast("int")

    none = F.lit(None)
    blocks, split = table(wide), table(parts)
    number = table({c.cls: i for i, c in enumerate(classes, 1)})
    placed = items.withColumn("c", number[F.col("cls")]).where("c > 0")
    deep = held.withColumn("level", table(level_of)[F.col("depth")]).withColumn("block", dealt("query_id", blocks[F.col("level")]))
    left = deep.select(
        "level", "block", F.explode(F.sequence(F.lit(0), split[F.col("level")] - 1)).alias("part"), "query_id",
        none.cast("string").alias("product_id"), F.col("category").cast("string").alias("category"),
        F.col("n").cast("int").alias("n"), F.col("depth").cast("int").alias("depth"), "bar", F.col("vec").cast("array<float>").alias("vec"),
    )
    if masked is not None:
        pairs = masked.select("query_id", "product_id").distinct()
        pairs = pairs.join(placed.select("product_id", "c"), "product_id").join(
            deep.select("query_id", "depth", "level", "block"), "query_id"
        )
        left = left.unionByName(
            pairs.where("c <= depth").select(
                "level", "block", dealt("product_id", split[F.col("level")]).alias("part"), "query_id", "product_id",
                none.cast("string").alias("category"), none.cast("int").alias("n"), none.cast("int").alias("depth"),
                none.cast("double").alias("bar"), none.cast("array<float>").alias("vec"),
            )
        )
    # Which query blocks a class goes to follows from the levels, of which there are few.
    goes = F.array(*[F.struct(F.lit(i).alias("level"), F.lit(b).alias("block")) for i, q in wide.items() for b in range(q)])
    reach = table({i: 2**i for i in wide})
    has = items.columns
    right = placed.withColumn("to", F.explode(F.filter(goes, lambda t: reach[t["level"]] >= F.col("c")))).select(
        F.col("to.level").alias("level"), F.col("to.block").alias("block"),
        dealt("product_id", split[F.col("to.level")]).alias("part"), "c", "product_id",
        (F.col("category") if "category" in has else none).cast("string").alias("category"),
        (F.col("is_cold") if "is_cold" in has else none).cast("boolean").alias("is_cold"),
        F.col("vec").cast("array<float>").alias("vec"),
    )
    key = ["level", "block", "part"]
    groups = 2 * sum(wide[i] * parts[i] for i in wide)
    left, right = (side.repartition(groups, *key) for side in (left, right))
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_scorer(exclude_self, False, None), _OUT)


def left_out(work: DataFrame) -> DataFrame:
    """One row: all pairs, the pairs that were scored, and the share left out."""
    queries = F.max("n_queries")  # all queries meet the first class
    return work.agg(
        (queries * F.sum("n_items")).alias("n_pairs"), F.sum(F.col("n_queries") * F.col("n_items")).alias("n_scored")
    ).withColumn("left_out", 1 - F.try_divide(F.col("n_scored").cast("double"), "n_pairs"))

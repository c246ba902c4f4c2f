"""Building blocks for groups of unbounded size.

A window over ``partitionBy(key)`` puts one key's rows into one task. These helpers keep
that plan for ordinary keys and switch to range partitioning for the keys that outgrow it:
a range exchange on (key, order) cuts even a single key, ties included, into even pieces,
and the pieces are stitched together by per-piece offsets.

Settings (session configuration):

``spark.recolens.hotKeyRows``
    rows above which one key no longer goes through a single window task (default 2 000 000).
``spark.recolens.broadcastRows``
    rows up to which a dimension may be broadcast (default 1 000 000).
"""

from __future__ import annotations

import atexit
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

HOT_KEY_ROWS = 2_000_000
BROADCAST_ROWS = 1_000_000

_ROW = "__row"
_PIECE = "__piece"
_PIECE_BITS = 33  # monotonically_increasing_id keeps the row number in the low 33 bits


def _setting(spark: SparkSession, name: str, default: int) -> int:
    return int(spark.conf.get(f"spark.recolens.{name}", str(default)))


def hot_key_rows(spark: SparkSession) -> int:
    return _setting(spark, "hotKeyRows", HOT_KEY_ROWS)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder that ``spark.checkpoint.dir`` names; where it is unset, a folder in the
    warehouse, which driver and executors share in any deployment."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    context.setCheckpointDir(shared)
    atexit.register(delete_folder, spark, context.getCheckpointDir())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete what this session has checkpointed or put there; nothing if the session has ended."""
    try:
        place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
    except Exception:
        return


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so that every later use sees the same rows."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def broadcast_if_small(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Hint a broadcast only after counting that ``df`` stays within ``max_rows``.

    Beyond the bound the frame is returned without a hint: the join is then a shuffle join
    whose skewed partitions adaptive execution splits.
    """
    bound = max_rows or _setting(df.sparkSession, "broadcastRows", BROADCAST_ROWS)
    fits = df.limit(bound + 1).count() <= bound
    return F.broadcast(df) if fits else df


def by_shuffle(df: DataFrame) -> DataFrame:
    """``df`` as a side of a shuffle join, whatever size the planner expects.

    The planner counts an array as one element. A table of long vectors looks small enough to broadcast
    then, and would pass whole through the driver.
    """
    return df.hint("merge")


def hot_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame | None:
    """Keys with more rows than one task should take, or None when there are none.

    The counts combine on the map side. There are at most ``rows / hotKeyRows`` hot keys,
    so the returned table has a bound that does not depend on the number of keys.
    """
    limit = hot_key_rows(df.sparkSession)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot = counts.filter(F.col("__n") > limit).select(*keys)
    if hot.count() == 0:
        return None
    return cut(hot)


def _pieces(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Range-partition and sort by ``order``; tag each row with its position."""
    ordered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn(_ROW, F.monotonically_increasing_id())
    )
    # Range bounds are sampled, so the tags must be fixed before they are used twice.
    return cut(ordered.withColumn(_PIECE, F.shiftright(_ROW, _PIECE_BITS)))


def numbered_by_pieces(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], rank: str, total: str
) -> DataFrame:
    """What :func:`numbered` adds, for rows of keys that are all too large for one task."""
    placed = _pieces(df, [F.col(k) for k in keys] + list(order))
    by_piece = Window.partitionBy(*keys).orderBy(_PIECE)
    per_piece = placed.groupBy(*keys, _PIECE).agg(
        F.min(_ROW).alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    offsets = per_piece.select(
        *keys,
        _PIECE,
        "__first",
        F.coalesce(
            F.sum("__n").over(by_piece.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
        ).alias("__before"),
        F.sum("__n").over(Window.partitionBy(*keys)).alias(total),
    )
    # One row per piece plus one per hot key: bounded by the partition count.
    return (
        placed.join(F.broadcast(offsets), [*keys, _PIECE])
        .withColumn(rank, (F.col(_ROW) - F.col("__first") + F.col("__before") + 1))
        .drop(_ROW, _PIECE, "__first", "__before")
    )


def numbered(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    rank: str,
    total: str,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add ``rank`` (row number within ``keys`` by ``order``) and ``total`` (rows of the key).

    ``order`` must be total. ``hot`` lists the keys to spread over several tasks, see
    :func:`hot_keys`; without it one window task per key is used.
    """

    def windowed(part: DataFrame) -> DataFrame:
        return part.withColumn(
            rank, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("long")
        ).withColumn(total, F.count(F.lit(1)).over(Window.partitionBy(*keys)))

    if hot is None:
        return windowed(df)
    usual = df.join(F.broadcast(hot), list(keys), "left_anti")
    large = df.join(F.broadcast(hot), list(keys), "left_semi")
    return windowed(usual).unionByName(numbered_by_pieces(large, keys, order, rank, total))


def running_sums(
    df: DataFrame, keys: Sequence[str], order: str, sums: dict[str, str]
) -> DataFrame:
    """Running totals within ``keys`` by ``order``: ``sums`` maps new column to input column.

    ``order`` must be unique within a key. Keys with many distinct order values are spread.
    ``df`` is read for the size check and again for the sums: pass a written table.
    """

    def windowed(part: DataFrame) -> DataFrame:
        w = (
            Window.partitionBy(*keys)
            .orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow)
        )
        return part.select("*", *[F.sum(c).over(w).alias(out) for out, c in sums.items()])

    hot = hot_keys(df, keys)
    if hot is None:
        return windowed(df)
    usual = df.join(F.broadcast(hot), list(keys), "left_anti")
    large = df.join(F.broadcast(hot), list(keys), "left_semi")

    placed = _pieces(large, [*[F.col(k) for k in keys], F.col(order)])
    within = (
        Window.partitionBy(*keys, _PIECE)
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = (
        Window.partitionBy(*keys).orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    )
    per_piece = placed.groupBy(*keys, _PIECE).agg(
        *[F.sum(c).alias(f"__t_{out}") for out, c in sums.items()]
    )
    offsets = per_piece.select(
        *keys,
        _PIECE,
        *[
            F.coalesce(F.sum(f"__t_{out}").over(earlier), F.lit(0)).alias(f"__o_{out}")
            for out in sums
        ],
    )
    spread = (
        placed.select("*", *[F.sum(c).over(within).alias(f"__l_{o}") for o, c in sums.items()])
        .join(F.broadcast(offsets), [*keys, _PIECE])
        .select(
            *df.columns,
            *[(F.col(f"__l_{o}") + F.col(f"__o_{o}")).alias(o) for o in sums],
        )
    )
    return windowed(usual).unionByName(spread)


def dense_index(ids: DataFrame, id_col: str, out: str) -> DataFrame:
    """Number the distinct ids 0, 1, 2, ... in id order, without a single-task sort."""
    placed = _pieces(ids.select(id_col).where(F.col(id_col).isNotNull()).distinct(), [F.col(id_col)])
    per_piece = placed.groupBy(_PIECE).agg(
        F.min(_ROW).alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    # One row per partition, so this unpartitioned window is small.
    earlier = Window.orderBy(_PIECE).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_piece.select(
        _PIECE, "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")
    )
    return placed.join(F.broadcast(offsets), _PIECE).select(
        (F.col(_ROW) - F.col("__first") + F.col("__before")).cast("long").alias(out), id_col
    )

"""Streams that keep state under a watermark: late rows set aside, duplicates dropped, quantile sketches.

:mod:`recolens.streaming.partials` gives results that no order of arrival changes, at the price of a
merge over everything that has arrived. The forms here answer as the rows come in, with state that the
watermark bounds, and state what becomes of rows that arrive too late. All of them keep their state in
RocksDB on the executors, checkpointed to the folder that the starter is given, and can be stopped and
started again on the same checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from recolens.operators.service import FIVE_MINUTES, QUANTILE

#: Parts over which rows are dealt to look at their time; each has one state row.
SHARDS = 64
#: Size of a quantile sketch. One with at most this many values is exact.
SKETCH = 200

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's setting comes back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def rank_error(size: int = SKETCH) -> float:
    """Error of a sketch's quantile, in ranks as a share of the rows, exceeded with a chance of 1 %."""
    return 2.296 / size**0.9021  # fixed values: measured by the sketch's authors for one-sided ranks


# --- late rows -----------------------------------------------------------------------------


class LateRows(StatefulProcessor):
    """Tells late rows from others and counts both; the state of a shard is its two counts."""

    COUNTS = T.StructType([T.StructField("on_time", T.LongType()), T.StructField("late", T.LongType())])

    def __init__(self, names: list[str]):
        self.names = names

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getValueState("counts", self.COUNTS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        mark = timerValues.getCurrentWatermarkInMs()
        on_time, late = self.counts.get() if self.counts.exists() else (0, 0)
        for part in rows:
            part.columns = self.names  # computed columns arrive without their names
            # A row without a time is never late.
            is_late = (part["__us"] < mark * 1000).fillna(False).astype(bool)
            late, on_time = late + int(is_late.sum()), on_time + int((~is_late).sum())
            part = part.assign(late=is_late, n_late=late, n_on_time=on_time)
            yield part[["shard", *[c for c in self.names if c != "shard"], "late", "n_late", "n_on_time"]]
        self.counts.update((on_time, late))

    def close(self) -> None:
        pass


def split_late(stream: DataFrame, delay: str, ts: str = "ts", shards: int = SHARDS) -> DataFrame:
    """Every row of ``stream`` with ``late``: whether its time was older than the watermark when it came.

    The watermark of a micro-batch is the newest time of all batches before it, less ``delay``. Rows are
    dealt to ``shards`` parts by their content, so a busy user is spread; each part counts its rows in
    state, and the counts so far are the columns ``shard``, ``n_late`` and ``n_on_time``.
    """
    columns = stream.columns
    # The stateful operator sees the time as a plain number: it drops nothing by itself.
    marked = (
        stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
        .withColumn("__us", F.unix_micros(ts)).drop(ts)
        .withColumn("shard", F.pmod(F.xxhash64(*[c for c in columns if c != ts], "__us"), F.lit(shards)).cast("int"))
    )
    kinds = [f for f in marked.schema.fields if f.name != "shard"]
    out = T.StructType(
        [T.StructField("shard", T.IntegerType()), *kinds, T.StructField("late", T.BooleanType()),
         T.StructField("n_late", T.LongType()), T.StructField("n_on_time", T.LongType())]
    )
    judged = marked.groupBy("shard").transformWithStateInPandas(
        statefulProcessor=LateRows(marked.columns), outputStructType=out, outputMode="Append", timeMode="EventTime"
    )
    return judged.select(
        *[F.timestamp_micros("__us").alias(ts) if c == ts else F.col(c) for c in columns], "late", "shard", "n_late", "n_on_time"
    )


def start_split(judged: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write the rows of :func:`split_late` to ``path`` to the end of the input: the late table is the
    partition ``late=true``, the others are ``late=false``. A batch that is replayed replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("late").parquet(f"{path}/batch_id={batch_id}")

    with rocksdb(judged.sparkSession):
        return (
            judged.writeStream.foreachBatch(write).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )


def read_split(spark: SparkSession, path: str) -> DataFrame:
    """What :func:`start_split` has written; a filter on ``late`` reads one of the two tables only."""
    return spark.read.parquet(path).withColumn("late", F.col("late").cast("boolean"))


def late_counts(split: DataFrame) -> DataFrame:
    """One row (n_late, n_on_time): what the state of all shards has counted, from the written table."""
    last = split.groupBy("shard").agg(F.max("n_late").alias("l"), F.max("n_on_time").alias("o"))
    return last.agg(F.coalesce(F.sum("l"), F.lit(0)).alias("n_late"), F.coalesce(F.sum("o"), F.lit(0)).alias("n_on_time"))


# --- duplicates ----------------------------------------------------------------------------


def dedup_state(interactions: DataFrame, delay: str, keys: tuple[str, ...] = ("user_id", "product_id", "ts")) -> DataFrame:
    """The first row of every key. A key is remembered until the watermark is ``delay`` past its time, so
    state holds the keys of about the last ``delay`` only; rows older than the watermark are dropped."""
    timed = interactions.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return timed.dropDuplicatesWithinWatermark(list(keys))


def start_dedup(unique: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the rows of :func:`dedup_state` to ``path``; a restart goes on where the checkpoint ends."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    with rocksdb(unique.sparkSession):
        return (
            unique.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )


def state_rows(query: StreamingQuery) -> list[int]:
    """Rows in the state stores after each micro-batch."""
    return [sum(op.numRowsTotal for op in p.stateOperators) for p in query.recentProgress if p.stateOperators]


# --- service metrics -----------------------------------------------------------------------


def latency_sketches(requests: DataFrame, delay: str, window: str = FIVE_MINUTES, size: int = SKETCH) -> DataFrame:
    """Requests, hits and a mergeable quantile sketch (KLL) of the latencies per window, under a watermark.

    The state of a window has a fixed size, whatever the traffic and however many distinct latencies.
    """
    timed = requests.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    return (
        timed.groupBy(F.window("ts", window))
        .agg(
            F.count(F.lit(1)).alias("n_requests"),
            F.count_if("cache_hit").alias("hits"),
            F.count("latency_ms").alias("n_timed"),
            F.kll_sketch_agg_double(F.col("latency_ms").cast("double"), size).alias("sketch"),
        )
        .select(F.col("window.start").alias("window_start"), "n_requests", "hits", "n_timed", "sketch")
    )


def sketch_quantile(sketch: str = "sketch", q: float = QUANTILE):
    """The quantile that a sketch gives: one of the values, the smallest with a rank of at least ``q``."""
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(q))


def rolled_up(sketches: DataFrame, window: str) -> DataFrame:
    """The same table for longer windows, from the sketches alone."""
    return (
        sketches.groupBy(F.window("window_start", window).getField("start").alias("window_start"))
        .agg(
            F.sum("n_requests").alias("n_requests"), F.sum("hits").alias("hits"), F.sum("n_timed").alias("n_timed"),
            F.kll_merge_agg_double("sketch").alias("sketch"),
        )
    )


def start_sketches(sketches: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write every change of a window; a replayed batch replaces itself. See ``logs.latest``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    with rocksdb(sketches.sparkSession):
        return (
            sketches.writeStream.outputMode("update").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )

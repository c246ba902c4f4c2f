"""Event logs as streams. The transformations are the batch operators' or their
incremental form; every starter takes a checkpoint folder and returns the running query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from recolens.functions import scalars as S
from recolens.operators.abtest import POSITIVE, judge_feedback
from recolens.operators.service import FIVE_MINUTES, ONE_HOUR, QUANTILE


def read_log(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
    files_per_trigger: int | None = None,
) -> DataFrame:
    """A folder of log files as a stream; new files are picked up as they appear."""
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def with_event_time(stream: DataFrame, delay: str, col: str = "ts") -> DataFrame:
    """Watermarked event time; zone-less timestamps are read in the session zone.

    Rows that arrive more than ``delay`` behind the newest one are dropped by what follows. Where no
    row may be lost, use :mod:`recolens.streaming.partials`, which needs no watermark.
    """
    return stream.withColumn(col, F.col(col).cast("timestamp")).withWatermark(col, delay)


def stream_feedback(
    feedback: DataFrame, accepted: str, rejected: str, checkpoint: str
) -> StreamingQuery:
    """Validate, append the good rows, and keep the others with their reason.

    Each micro-batch overwrites its own ``batch_id`` folder, so a batch that is replayed
    after a failure replaces itself instead of being appended twice.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        judged = judge_feedback(batch).persist()
        try:
            good = judged.filter(F.col("reason").isNull()).drop("reason")
            good.write.mode("overwrite").parquet(f"{accepted}/batch_id={batch_id}")
            judged.filter(F.col("reason").isNotNull()).write.mode("overwrite").parquet(
                f"{rejected}/batch_id={batch_id}"
            )
        finally:
            judged.unpersist()

    return (
        feedback.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def impressions_of(requests: DataFrame) -> DataFrame:
    """An impression per recommendation request, with the assigned variant."""
    return requests.select("user_id", S.ab_variant(F.col("user_id")).alias("ab_variant"), "ts")


def stream_impressions(requests: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        impressions_of(requests)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def ab_users(impressions: DataFrame) -> DataFrame:
    """Running number of distinct impressed users per variant (update or complete mode).

    One state row per (variant, user), spread by that key; the counts behind it combine
    before the shuffle.
    """
    distinct = impressions.select("ab_variant", "user_id").dropDuplicates()
    return distinct.groupBy("ab_variant").agg(F.count(F.lit(1)).alias("n_users"))


def ab_clicks(feedback: DataFrame) -> DataFrame:
    """Running clicks plus purchases per variant."""
    acted = feedback.filter(F.col("interaction_type").isin(*POSITIVE))
    return acted.groupBy("ab_variant").agg(F.count(F.lit(1)).alias("n_clicks"))


def _window(size: str):
    return F.window("ts", size)


def _flat(windowed: DataFrame) -> DataFrame:
    rest = [c for c in windowed.columns if c != "window"]
    return windowed.select(F.col("window.start").alias("window_start"), *rest)


def service_latency(requests: DataFrame, window: str = FIVE_MINUTES) -> DataFrame:
    """Requests, cache hits and p95 latency per window, for a watermarked stream.

    The quantile is a bounded sketch: state per window does not grow with the traffic.
    """
    return _flat(
        requests.groupBy(_window(window)).agg(
            F.count(F.lit(1)).alias("n_requests"),
            F.count_if("cache_hit").alias("hits"),
            F.percentile_approx("latency_ms", QUANTILE, 10000).alias("latency_p95"),
        )
    )


def service_ctr(events: DataFrame, window: str = ONE_HOUR) -> DataFrame:
    """Requests and feedback posts per window from one log with a boolean ``is_request``."""
    return _flat(
        events.groupBy(_window(window)).agg(
            F.count_if("is_request").alias("n_requests"),
            F.count_if(~F.col("is_request")).alias("n_feedback"),
        )
    ).withColumn("ctr", F.try_divide(F.col("n_feedback").cast("double"), "n_requests"))


def dedup_stream(interactions: DataFrame) -> DataFrame:
    """First row per (user, product, time) among those the watermark still covers."""
    return interactions.dropDuplicatesWithinWatermark(["user_id", "product_id", "ts"])


def popularity_stream(interactions: DataFrame, window: str = ONE_HOUR) -> DataFrame:
    """Rows per window, category and product."""
    return _flat(
        interactions.groupBy(_window(window), "category", "product_id").agg(
            F.count(F.lit(1)).alias("nb_interactions")
        )
    )


def start_table(
    result: DataFrame, name: str, checkpoint: str, mode: str = "append"
) -> StreamingQuery:
    """Run to the end of the available input into an in-memory table (small results)."""
    return (
        result.writeStream.format("memory")
        .queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_files(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append finished rows as Parquet files."""
    return (
        result.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def start_updates(result: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write every change of a running aggregate; a replayed batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        result.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest(updates: DataFrame, *keys: str) -> DataFrame:
    """The last written state of each key of :func:`start_updates`."""
    values = [c for c in updates.columns if c not in (*keys, "batch_id")]
    newest = updates.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("__v"))
    return newest.select(*keys, *[F.col(f"__v.{c}").alias(c) for c in values])


def late_rows(query: StreamingQuery) -> int:
    """Rows the stateful operators dropped because they were older than the watermark."""
    return sum(
        op.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for op in progress.stateOperators
    )

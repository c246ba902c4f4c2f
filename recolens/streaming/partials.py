"""Streams whose result doesn't depend on the order in which rows arrive.

Every micro-batch is reduced to mergeable partial rows, which overwrite the batch's own folder, so a
replayed batch replaces itself. The result is the merge of all partials: it equals the batch operator
over all rows that have arrived, however late or shuffled they are. No watermark drops a row and no
state grows in the executors; partial tables are small and can be merged into one at any time, since
merging partials gives a partial.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from recolens.operators.service import FIVE_MINUTES, ONE_HOUR, QUANTILE, latency_counts, latency_of_counts
from recolens.operators.silver import dedup_interactions


def start_partials(
    stream: DataFrame, partial: Callable[[DataFrame], DataFrame], path: str, checkpoint: str
) -> StreamingQuery:
    """Write ``partial`` of every micro-batch to its folder under ``path``, to the end of the input."""

    def write(batch: DataFrame, batch_id: int) -> None:
        partial(batch).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _start(window: str):
    return F.window("ts", window)["start"].alias("window_start")


def popularity(rows: DataFrame, window: str = ONE_HOUR) -> DataFrame:
    """Rows per window, category and product."""
    return rows.groupBy(_start(window), "category", "product_id").agg(F.count(F.lit(1)).alias("nb_interactions"))


def merge_popularity(partials: DataFrame) -> DataFrame:
    return partials.groupBy("window_start", "category", "product_id").agg(
        F.sum("nb_interactions").alias("nb_interactions")
    )


def clicks(events: DataFrame, window: str = ONE_HOUR) -> DataFrame:
    """Requests and posts per window from one log with a boolean ``is_request``."""
    return events.groupBy(_start(window)).agg(
        F.count_if("is_request").alias("n_requests"), F.count_if(~F.col("is_request")).alias("n_feedback")
    )


def merge_clicks(partials: DataFrame) -> DataFrame:
    merged = partials.groupBy("window_start").agg(
        F.sum("n_requests").alias("n_requests"), F.sum("n_feedback").alias("n_feedback")
    )
    return merged.withColumn("ctr", F.try_divide(F.col("n_feedback").cast("double"), "n_requests"))


def latency(requests: DataFrame, window: str = FIVE_MINUTES) -> DataFrame:
    """Rows and cache hits per window and latency, which keep the quantile exact."""
    return latency_counts(requests, window)


def merge_latency(partials: DataFrame, q: float = QUANTILE) -> DataFrame:
    """Requests, hits and the exact latency quantile per window."""
    merged = partials.groupBy("window_start", "x").agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    hits = merged.groupBy("window_start").agg(F.sum("hits").alias("hits"))
    timed = merged.filter(F.col("x").isNotNull()).select("window_start", "x", "n")
    return latency_of_counts(timed, q).join(hits, "window_start")


def dedup(interactions: DataFrame) -> DataFrame:
    """The batch dedup; of partials it is their merge as well."""
    return dedup_interactions(interactions)

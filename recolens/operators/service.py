"""Service metrics over a request log, in tumbling windows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recolens.operators.skew import cut, running_sums

FIVE_MINUTES, ONE_HOUR = "5 minutes", "1 hour"
QUANTILE = 0.95


def _bucket(size: str):
    return F.window("ts", size)["start"].alias("window_start")


def latency_counts(requests: DataFrame, window: str = FIVE_MINUTES) -> DataFrame:
    """Rows and cache hits per (window, latency)."""
    return requests.groupBy(_bucket(window), F.col("latency_ms").alias("x")).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("cache_hit").alias("hits")
    )


def latency_p95(requests: DataFrame, window: str = FIVE_MINUTES, q: float = QUANTILE) -> DataFrame:
    """Exact, interpolated latency quantile per window."""
    counts = requests.filter(F.col("latency_ms").isNotNull()).groupBy(
        _bucket(window), F.col("latency_ms").alias("x")
    )
    return latency_of_counts(counts.agg(F.count(F.lit(1)).alias("n")), q)


def latency_of_counts(counts: DataFrame, q: float = QUANTILE) -> DataFrame:
    """The quantile read off the running counts of (window_start, x, n) rows; a window with very many
    distinct latencies is cut into range pieces."""
    counts = cut(counts)
    totals = counts.groupBy("window_start").agg(F.sum("n").alias("total"))
    walked = running_sums(counts, ["window_start"], "x", {"upto": "n"}).join(
        totals, "window_start"
    )
    place = (F.col("total") - 1) * F.lit(q)  # zero-based position in the sorted latencies
    low, high = F.floor(place), F.ceil(place)
    first = F.col("upto") - F.col("n")

    def at(position):
        return F.max(F.when((first <= position) & (position < F.col("upto")), F.col("x")))

    return (
        walked.groupBy("window_start", "total")
        .agg(at(low).alias("x_low"), at(high).alias("x_high"))
        .select(
            "window_start",
            F.col("total").alias("n_requests"),
            (F.col("x_low") + (F.col("x_high") - F.col("x_low")) * (place - low)).alias(
                "latency_p95"
            ),
        )
    )


def cache_hit_rate(requests: DataFrame, window: str = FIVE_MINUTES) -> DataFrame:
    return (
        requests.groupBy(_bucket(window))
        .agg(F.count_if("cache_hit").alias("hits"), F.count(F.lit(1)).alias("n_requests"))
        .withColumn("hit_rate", F.try_divide(F.col("hits").cast("double"), "n_requests"))
    )


def ctr_rate(requests: DataFrame, feedback: DataFrame, window: str = ONE_HOUR) -> DataFrame:
    """Feedback posts per recommendation request; windows with posts alone have no rate."""
    asked = requests.groupBy(_bucket(window)).agg(F.count(F.lit(1)).alias("n_requests"))
    posted = feedback.groupBy(_bucket(window)).agg(F.count(F.lit(1)).alias("n_feedback"))
    both = asked.join(posted, "window_start", "full").fillna(0, ["n_requests", "n_feedback"])
    return both.withColumn("ctr", F.try_divide(F.col("n_feedback").cast("double"), "n_requests"))

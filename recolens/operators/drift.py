"""Distribution drift between consecutive months (two-sample Kolmogorov-Smirnov)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from recolens.functions.scalars import valid_month
from recolens.functions.stats import ks_p_value, ks_p_value_auto
from recolens.operators.skew import cut, running_sums

ALPHA, MIN_ROWS = 0.05, 10


def consecutive_months(months: DataFrame) -> DataFrame:
    """Each month with the next available one; ``months`` has one row per month."""
    following = F.lead("year_month").over(Window.orderBy("year_month"))
    return (
        months.select(F.col("year_month").alias("month_a"), following.alias("month_b"))
        .filter(F.col("month_b").isNotNull())
    )


P_VALUES = {"auto": ks_p_value_auto, "asymptotic": ks_p_value}


def drift_ks(
    interactions: DataFrame, alpha: float = ALPHA, min_rows: int = MIN_ROWS, method: str = "asymptotic"
) -> DataFrame:
    """KS test on ``converted``. With values 0 and 1 the statistic is |rate_a - rate_b|, so
    month sums are all that is needed; the pairing window runs over one row per month.

    ``method``: "asymptotic", one law at every size, or "auto", on request only, which is exact for
    months of up to 10 000 rows."""
    monthly = (
        interactions.filter(valid_month(F.col("year_month")) & F.col("converted").isNotNull())
        .groupBy("year_month")
        .agg(F.count(F.lit(1)).alias("n"), F.avg("converted").alias("rate"))
    )
    w = Window.orderBy("year_month")
    pairs = monthly.select(
        F.col("year_month").alias("month_a"),
        F.lead("year_month").over(w).alias("month_b"),
        F.col("n").alias("n_a"),
        F.lead("n").over(w).alias("n_b"),
        F.col("rate").alias("conv_rate_a"),
        F.lead("rate").over(w).alias("conv_rate_b"),
    ).filter((F.col("n_a") >= min_rows) & (F.col("n_b") >= min_rows))
    return _judge(
        pairs.withColumn("ks_statistic", F.abs(F.col("conv_rate_a") - F.col("conv_rate_b"))),
        alpha,
        method,
    )


def _judge(pairs: DataFrame, alpha: float, method: str) -> DataFrame:
    p_value = P_VALUES[method](F.col("ks_statistic"), F.col("n_a"), F.col("n_b"))
    return pairs.withColumn("p_value", p_value).withColumn("drift_detected", F.col("p_value") < alpha)


def drift_ks_numeric(
    df: DataFrame, value: str, month: str = "year_month", alpha: float = ALPHA,
    min_rows: int = MIN_ROWS, method: str = "asymptotic",
) -> DataFrame:
    """KS test of any numeric column between consecutive available months.

    Rows are counted per (month, value) first. Each month then meets its predecessor and
    successor as running counts over the distinct values; a month with very many distinct
    values is cut into range pieces, so none has to fit one task.
    """
    counts = cut(
        df.filter(valid_month(F.col(month)) & F.col(value).isNotNull())
        .groupBy(F.col(month).alias("year_month"), F.col(value).alias("x"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    totals = counts.groupBy("year_month").agg(F.sum("n").alias("n"))
    w = Window.orderBy("year_month")  # one row per month
    pairs = totals.select(
        F.col("year_month").alias("month_a"),
        F.lead("year_month").over(w).alias("month_b"),
        F.col("n").alias("n_a"),
        F.lead("n").over(w).alias("n_b"),
    ).filter((F.col("n_a") >= min_rows) & (F.col("n_b") >= min_rows))
    # A month takes part in at most two pairs: once as the earlier, once as the later one.
    roles = pairs.select(
        F.explode(
            F.array(
                F.struct(F.col("month_a").alias("year_month"), "month_a", F.lit(True).alias("first")),
                F.struct(F.col("month_b").alias("year_month"), "month_a", F.lit(False).alias("first")),
            )
        ).alias("r")
    ).select("r.*")
    points = cut(
        counts.join(F.broadcast(roles), "year_month")
        .groupBy("month_a", "x")
        .agg(
            F.sum(F.when(F.col("first"), F.col("n")).otherwise(0)).alias("a"),
            F.sum(F.when(F.col("first"), 0).otherwise(F.col("n"))).alias("b"),
        )
    )
    walked = running_sums(points, ["month_a"], "x", {"cum_a": "a", "cum_b": "b"})
    gaps = (
        walked.join(F.broadcast(pairs.select("month_a", "n_a", "n_b")), "month_a")
        .groupBy("month_a")
        .agg(
            F.max(F.abs(F.col("cum_a") / F.col("n_a") - F.col("cum_b") / F.col("n_b"))).alias(
                "ks_statistic"
            )
        )
    )
    return _judge(pairs.join(gaps, "month_a"), alpha, method)


def drift_summary(report: DataFrame) -> DataFrame:
    return report.agg(
        F.count(F.lit(1)).alias("n_pairs"), F.count_if("drift_detected").alias("n_drift")
    )

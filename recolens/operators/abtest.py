"""A/B experiment: assignment, counts, click-through and the two-sided Z test."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from recolens.functions import scalars as S
from recolens.functions.stats import two_sided_normal_p

INTERACTION_TYPES = ("click", "purchase", "skip")
VARIANTS = (S.CONTROL, S.TREATMENT)
POSITIVE = ("click", "purchase")
SIGNIFICANCE = 0.05
EXPERIMENT = "hybrid_vs_als_only"


def ab_variant(df: DataFrame) -> DataFrame:
    return df.withColumn("ab_variant", S.ab_variant(F.col("user_id")))


def rejection_reason() -> Column:
    """Why a feedback row is not acceptable, NULL when it is."""
    return (
        F.when(F.col("user_id").isNull(), "missing user_id")
        .when(F.col("product_id").isNull(), "missing product_id")
        .when(F.col("interaction_type").isNull(), "missing interaction_type")
        .when(~F.col("interaction_type").isin(*INTERACTION_TYPES), "invalid interaction_type")
        .when(F.col("ab_variant").isNull(), "missing ab_variant")
        .when(~F.col("ab_variant").isin(*VARIANTS), "invalid ab_variant")
    )


def judge_feedback(feedback: DataFrame, now: Column | None = None) -> DataFrame:
    """Feedback with its ``reason`` and a timestamp, the present one when none was sent."""
    filled = F.coalesce(F.col("ts"), F.current_timestamp() if now is None else now)
    return feedback.withColumn("reason", rejection_reason()).withColumn("ts", filled)


def validate_feedback(
    feedback: DataFrame, now: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with reason)."""
    judged = judge_feedback(feedback, now)
    return (
        judged.filter(F.col("reason").isNull()).drop("reason"),
        judged.filter(F.col("reason").isNotNull()),
    )


def ab_counts(impressions: DataFrame, feedback: DataFrame) -> DataFrame:
    """Per variant: distinct impressed users, impressions, clicks plus purchases."""
    return _counts(impressions, feedback, ["ab_variant"])


def ab_counts_by_segment(
    impressions: DataFrame, feedback: DataFrame, users: DataFrame
) -> DataFrame:
    """The same per user segment; users without one are casual."""

    def tagged(df: DataFrame) -> DataFrame:
        segments = users.select("user_id", "segment")
        return df.join(segments, "user_id", "left").withColumn(
            "segment", F.coalesce("segment", F.lit(S.CASUAL))
        )

    return _counts(tagged(impressions), tagged(feedback), ["segment", "ab_variant"])


def _counts(impressions: DataFrame, feedback: DataFrame, keys: list[str]) -> DataFrame:
    # Users are made distinct per (variant, user) and then counted: two combining steps.
    shown = (
        impressions.groupBy(*keys, "user_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(*keys)
        .agg(F.count("user_id").alias("n_users"), F.sum("n").alias("n_impressions"))
    )
    acted = (
        feedback.filter(F.col("interaction_type").isin(*POSITIVE))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_clicks"))
    )
    return shown.join(acted, keys, "full").select(
        *keys,
        *[
            F.coalesce(c, F.lit(0)).cast("long").alias(c)
            for c in ("n_users", "n_impressions", "n_clicks")
        ],
    )


def ab_results(
    counts: DataFrame, start: str, today: str, experiment_id: str = EXPERIMENT,
    keys: tuple[str, ...] = (),
) -> DataFrame:
    """Click-through rates, lift and the pooled two-sided Z test from the counts.

    The rate is clicks plus purchases over distinct impressed users; it can exceed 1, in
    which case the standard error is 0 and p is 1. ``keys`` (e.g. segment) gives one result
    per group.
    """

    def of(variant: str, col: str) -> Column:
        picked = F.sum(F.when(F.col("ab_variant") == variant, F.col(col)).otherwise(0))
        return picked.cast("double")

    wide = counts.groupBy(*keys).agg(
        of(S.CONTROL, "n_users").alias("nc"),
        of(S.TREATMENT, "n_users").alias("nt"),
        of(S.CONTROL, "n_clicks").alias("cc"),
        of(S.TREATMENT, "n_clicks").alias("ct"),
        of(S.CONTROL, "n_impressions").alias("ic"),
        of(S.TREATMENT, "n_impressions").alias("it"),
    )
    zero = F.lit(0.0)
    rate_c = F.coalesce(F.try_divide("cc", "nc"), zero)
    rate_t = F.coalesce(F.try_divide("ct", "nt"), zero)
    rates = wide.withColumns({"rc": rate_c, "rt": rate_t})
    pooled = F.try_divide(F.col("cc") + F.col("ct"), F.col("nc") + F.col("nt"))
    spread = F.try_divide(F.lit(1.0), "nc") + F.try_divide(F.lit(1.0), "nt")
    variance = F.coalesce(F.greatest(pooled * (1 - pooled) * spread, zero), zero)
    z = F.try_divide(F.col("rt") - F.col("rc"), F.sqrt(variance))
    p = F.coalesce(two_sided_normal_p(z), F.lit(1.0))
    tested = rates.withColumn("p", p)
    return tested.select(
        *keys,
        F.lit(experiment_id).alias("experiment_id"),
        F.lit(start).alias("start_date"),
        S.days_running(F.to_date(F.lit(start)), F.to_date(F.lit(today)))
        .cast("long")
        .alias("n_days"),
        F.round("rc", 4).alias("control_ctr"),
        F.round("rt", 4).alias("treatment_ctr"),
        F.round(
            F.when(F.col("rc") > 0, (F.col("rt") - F.col("rc")) / F.col("rc") * 100).otherwise(0.0),
            2,
        ).alias("lift_pct"),
        F.round("p", 4).alias("p_value"),
        (F.col("p") < SIGNIFICANCE).alias("significant"),
        F.col("nc").cast("long").alias("n_users_control"),
        F.col("nt").cast("long").alias("n_users_treatment"),
        F.round(F.try_divide("cc", "ic"), 4).alias("control_ctr_per_impression"),
        F.round(F.try_divide("ct", "it"), 4).alias("treatment_ctr_per_impression"),
    )


def ctr_table(results: DataFrame) -> DataFrame:
    """The two bars of the dashboard's click-through chart."""
    return results.select(
        F.expr(
            "stack(2, 'control', control_ctr, 'treatment', treatment_ctr) AS (variant, ctr)"
        )
    )


def variant_mismatch(feedback: DataFrame) -> DataFrame:
    """Feedback whose sent variant is not the assigned one."""
    wrong = F.col("ab_variant") != S.ab_variant(F.col("user_id"))
    return feedback.agg(
        F.count(F.lit(1)).alias("n_feedback"), F.count_if(wrong).alias("n_mismatch")
    ).withColumn("mismatch_rate", F.try_divide(F.col("n_mismatch").cast("double"), "n_feedback"))

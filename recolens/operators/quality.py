"""Data-quality checks: one aggregate pass per table, one result row per check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

CONVERSION_RANGE = (0.17, 0.23)
SOURCES = ("als", "bridge", "popular")


class QualityError(ValueError):
    """Raised in fail mode when a check does not pass."""


def _checks(df: DataFrame, table: str, failing: dict[str, Column]) -> DataFrame:
    """Rows (table, check, failed, total, success); an empty table fails its row count."""
    names = list(failing)
    one = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(c).alias(f"f{i}") for i, c in enumerate(failing.values())],
    ).withColumn("f_rows", F.when(F.col("total") > 0, 0).otherwise(1).cast("long"))
    cases = [f"'{n}', f{i}" for i, n in enumerate(names)] + ["'row_count', f_rows"]
    return one.select(
        F.lit(table).alias("table_name"),
        "total",
        F.expr(f"stack({len(cases)}, {', '.join(cases)}) AS (check_name, failed)"),
    ).select(
        "table_name", "check_name", "failed", "total", (F.col("failed") == 0).alias("success")
    )


def dq_interactions(interactions: DataFrame) -> DataFrame:
    """Rating within 0..5 (NULLs pass), keys present, not empty."""
    return _checks(
        interactions,
        "interactions",
        {
            "rating_between": F.col("rating").isNotNull() & ~F.col("rating").between(0, 5),
            "user_id_not_null": F.col("user_id").isNull(),
            "product_id_not_null": F.col("product_id").isNull(),
        },
    )


def dq_gold_products(gold: DataFrame) -> DataFrame:
    rate = F.col("conversion_rate")
    return _checks(
        gold,
        "gold_products",
        {
            "product_id_not_null": F.col("product_id").isNull(),
            "conversion_rate_between": rate.isNotNull() & ~rate.between(0, 1),
        },
    )


def dq_scores(recs: DataFrame) -> DataFrame:
    """Scores within 0..1 and sources of the closed set."""
    return _checks(
        recs,
        "recommendations",
        {
            "score_between": F.col("score").isNull() | ~F.col("score").between(0, 1),
            "source_in_set": F.col("source").isNull() | ~F.col("source").isin(*SOURCES),
        },
    )


def dq_global_conversion(
    gold: DataFrame, low: float = CONVERSION_RANGE[0], high: float = CONVERSION_RANGE[1]
) -> DataFrame:
    """Mean of the per-product rates against the expected range."""
    mean = gold.agg(F.avg("conversion_rate").alias("mean_conversion_rate"))
    return mean.select(
        "mean_conversion_rate",
        F.coalesce(F.col("mean_conversion_rate").between(low, high), F.lit(False)).alias(
            "success"
        ),
    )


def dq_summary(*checks: DataFrame, mode: str = "report") -> DataFrame:
    """Checks passed and total per table; ``mode="fail"`` raises when one failed."""
    if mode not in ("report", "fail"):
        raise ValueError("mode is report or fail")
    results = checks[0]
    for other in checks[1:]:
        results = results.unionByName(other)
    if mode == "fail":
        failed = results.filter(~F.col("success")).collect()  # one row per check
        if failed:
            names = [f"{r.table_name}.{r.check_name}" for r in failed]
            raise QualityError(f"failed checks: {names}")
    return results.groupBy("table_name").agg(
        F.count_if("success").alias("passed"), F.count(F.lit(1)).alias("total")
    )

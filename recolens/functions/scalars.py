"""Column expressions shared by the operators. All stay inside generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Labels and bounds of the data model.
PURCHASE, REVIEW = "purchase", "review"
CONTROL, TREATMENT = "control", "treatment"
POWER, REGULAR, CASUAL = "power_user", "regular_user", "casual_user"
MIN_INTERACTIONS = 5
RATING_MIN, RATING_MAX = 0.0, 5.0
MINMAX_EPSILON = 1e-8

# Epoch milliseconds of 0001-01-01 and 9999-12-31T23:59:59.999: what a timestamp can print.
MIN_EPOCH_MS, MAX_EPOCH_MS = -62135596800000, 253402300799999


def interaction_type(verified: Column) -> Column:
    """purchase / review from the verified flag; an unknown flag stays unknown."""
    return F.when(verified, PURCHASE).when(~verified, REVIEW)


def converted(kind: Column) -> Column:
    return F.when(kind == PURCHASE, 1).otherwise(0).cast("int")


def event_time(epoch_ms: Column) -> Column:
    """Epoch milliseconds to timestamp; NULL outside the printable range (ANSI-safe)."""
    usable = epoch_ms.between(MIN_EPOCH_MS, MAX_EPOCH_MS)
    return F.timestamp_millis(F.when(usable, epoch_ms))


def year_month(epoch_ms: Column) -> Column:
    return F.date_format(event_time(epoch_ms), "yyyy-MM")


def valid_month(month: Column) -> Column:
    """Readers accept both NULL and the text form of a missing period."""
    return month.isNotNull() & (month != "NaT")


def clamp_rating(rating: Column) -> Column:
    """Below 0 becomes 0, above 5 becomes 5; NULL stays NULL."""
    return (
        F.when(rating < RATING_MIN, RATING_MIN)
        .when(rating > RATING_MAX, RATING_MAX)
        .otherwise(rating)
    )


def segment(purchases: Column, p50: Column, p90: Column) -> Column:
    return (
        F.when(purchases >= p90, POWER).when(purchases >= p50, REGULAR).otherwise(CASUAL)
    )


def is_cold(n: Column, min_interactions: int = MIN_INTERACTIONS) -> Column:
    return F.coalesce(n, F.lit(0)) < min_interactions


def minmax(x: Column, low: Column, high: Column) -> Column:
    return (x - low) / (high - low + F.lit(MINMAX_EPSILON))


def clip01(x: Column) -> Column:
    return F.when(x < 0, 0.0).when(x > 1, 1.0).otherwise(x)


def source_label(cold: Column) -> Column:
    return F.when(cold, "bridge").otherwise("als")


def corpus_text(title: Column, description: Column | None = None) -> Column:
    """Title plus the first description entry, NULLs as empty text."""
    parts = [F.coalesce(title, F.lit(""))]
    if description is not None:
        parts.append(F.coalesce(F.try_element_at(description, F.lit(1)), F.lit("")))
    return F.trim(F.concat_ws(" ", *parts))


def ab_variant(user_id: Column) -> Column:
    """MD5 of the id read as an integer: even is control, odd is treatment.

    The parity of the integer is the parity of its last hexadecimal digit.
    """
    last = F.substring(F.md5(user_id.cast("string")), -1, 1)
    return F.when(last.isin(*"02468ace"), CONTROL).otherwise(TREATMENT)


def lift_pct(value: Column, base: Column) -> Column:
    """Relative gain in percent; infinite over a zero base, 0 when both are zero."""
    return (
        F.when((base == 0) & (value > 0), F.lit(float("inf")))
        .when(base == 0, F.lit(0.0))
        .otherwise((value - base) / F.when(base != 0, base) * 100)
    )


def days_running(start: Column, today: Column) -> Column:
    return F.greatest(F.datediff(today, start) + 1, F.lit(1))

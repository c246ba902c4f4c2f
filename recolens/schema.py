"""Table schemas and schema conformance."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

VECTOR = T.ArrayType(T.FloatType(), True)

REVIEWS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("asin", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("verified_purchase", T.BooleanType()),
        T.StructField("helpful_vote", T.LongType()),
    ]
)

METADATA = T.StructType(
    [
        T.StructField("parent_asin", T.StringType()),
        T.StructField("asin", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("description", T.ArrayType(T.StringType())),
        T.StructField("price", T.DoubleType()),
        T.StructField("average_rating", T.DoubleType()),
        T.StructField("rating_number", T.LongType()),
        T.StructField("store", T.StringType()),
    ]
)

INTERACTIONS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("rating", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
        T.StructField("interaction_type", T.StringType()),
        T.StructField("converted", T.IntegerType()),
        T.StructField("year_month", T.StringType()),
        T.StructField("helpful_vote", T.LongType()),
        T.StructField("category", T.StringType()),
    ]
)

PRODUCTS = T.StructType(
    [
        T.StructField("product_id", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("average_rating", T.DoubleType()),
        T.StructField("rating_number", T.LongType()),
        T.StructField("store", T.StringType()),
    ]
)

FEEDBACK = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("interaction_type", T.StringType()),
        T.StructField("ab_variant", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)

IMPRESSIONS = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("ab_variant", T.StringType()),
        T.StructField("ts", T.TimestampType()),
    ]
)


def conform(
    df: DataFrame, schema: T.StructType, required: tuple[str, ...] = ()
) -> DataFrame:
    """Project ``df`` onto ``schema``: cast what exists, null-fill what is optional.

    A missing ``required`` column is an error; columns outside the schema are dropped,
    so the projection still prunes the scan below it.
    """
    present = set(df.columns)
    missing = [name for name in required if name not in present]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None))
            .cast(f.dataType)
            .alias(f.name)
            for f in schema.fields
        ]
    )

"""User profiles kept up to date as interactions arrive, and distinct counts that roll up.

Profiles. Every batch of interactions leaves its mergeable partials per (category, user) in a folder of
its own, ``deltas/batch=N``; the profiles of the users it concerns, and only those, are recomputed from
the partials and written to ``profiles/batch=N``. A profile is the newest row of a user. A batch that is
written again replaces itself. :func:`compact` merges old folders; readers take the newest compacted
folder and the batches after it, so a crash between its steps changes no result.

Distinct counts. A HyperLogLog sketch per (month, category) is merged for every coarser level; users are
counted once per sketch, never twice, and no level reads the interactions again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from recolens.operators.bronze import merge_profiles

#: Logarithm of the number of registers of a sketch.
LG_K = 14
_SUMS = ("total_interactions", "total_purchases", "rating_sum", "rating_n")


def _folders(spark: SparkSession, path: str) -> dict[str, list[int]]:
    """Finished folders under ``path`` by kind (batch, upto), ascending numbers."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[str, list[int]] = {"batch": [], "upto": []}
    if files.exists(root):
        for status in files.listStatus(root):
            kind, _, number = status.getPath().getName().partition("=")
            done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
            if kind in out and files.exists(done):
                out[kind].append(int(number))
    return {kind: sorted(numbers) for kind, numbers in out.items()}


def _current(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest compacted folder and the batches after it, with their number ``batch``."""
    have = _folders(spark, path)
    upto = have["upto"][-1] if have["upto"] else None
    parts = [] if upto is None else [spark.read.parquet(f"{path}/upto={upto}").withColumn("batch", F.lit(upto).cast("long"))]
    later = [b for b in have["batch"] if upto is None or b > upto]
    parts += [spark.read.parquet(f"{path}/batch={b}").withColumn("batch", F.lit(b).cast("long")) for b in later]
    if not parts:
        return None
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def partial_sums(interactions: DataFrame) -> DataFrame:
    """Per (category, user) the sums that merge by adding."""
    return interactions.filter(F.col("user_id").isNotNull()).groupBy("category", "user_id").agg(
        F.count("product_id").alias("total_interactions"),
        F.sum("converted").cast("long").alias("total_purchases"),
        F.sum("rating").alias("rating_sum"),
        F.count("rating").alias("rating_n"),
    )


def _merged(deltas: DataFrame) -> DataFrame:
    return deltas.groupBy("category", "user_id").agg(*[F.sum(c).alias(c) for c in _SUMS])


def add_batch(interactions: DataFrame, path: str, batch: int) -> DataFrame:
    """Take in a batch of new interactions; the profiles it has changed.

    ``batch`` numbers rise. Writing a number again replaces that batch, as a retry does; a number below
    a compacted one is refused.
    """
    spark = interactions.sparkSession
    done = _folders(spark, f"{path}/deltas")["upto"]
    if done and batch <= done[-1]:
        raise ValueError(f"batch {batch} is part of the folders compacted up to {done[-1]}")
    partial_sums(interactions).write.mode("overwrite").parquet(f"{path}/deltas/batch={batch}")
    fresh = spark.read.parquet(f"{path}/deltas/batch={batch}").select("user_id").distinct()
    deltas = _current(spark, f"{path}/deltas").where(F.col("batch") <= batch).join(fresh, "user_id", "left_semi")
    merge_profiles(_merged(deltas).withColumn("avg_rating", F.try_divide("rating_sum", "rating_n"))).write.mode(
        "overwrite"
    ).parquet(f"{path}/profiles/batch={batch}")
    return spark.read.parquet(f"{path}/profiles/batch={batch}")


def profiles(spark: SparkSession, path: str) -> DataFrame:
    """One row per user: the totals and ratings of :func:`bronze.merge_profiles` over all batches."""
    rows = _current(spark, f"{path}/profiles")
    if rows is None:
        raise ValueError(f"no batch under {path}")
    values = [c for c in rows.columns if c not in ("user_id", "batch")]
    newest = rows.groupBy("user_id").agg(F.max_by(F.struct(*values), "batch").alias("__p"))
    return newest.select("user_id", *[F.col(f"__p.{c}").alias(c) for c in values])


def compact(spark: SparkSession, path: str) -> None:
    """Merge all finished batches of both tables into a folder each. The old folders may then go."""
    numbers = _folders(spark, f"{path}/deltas")["batch"]
    if not numbers:
        return
    upto = numbers[-1]
    _merged(_current(spark, f"{path}/deltas")).write.mode("overwrite").parquet(f"{path}/deltas/upto={upto}")
    profiles(spark, path).write.mode("overwrite").parquet(f"{path}/profiles/upto={upto}")


def user_sketches(interactions: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """A sketch of the distinct users per (year_month, category); rows without a user count for nothing."""
    rows = interactions.filter(F.col("user_id").isNotNull())
    return rows.groupBy("year_month", "category").agg(F.hll_sketch_agg("user_id", lg_k).alias("users"))


def distinct_users_at(sketches: DataFrame, *keys: str) -> DataFrame:
    """Estimated distinct users per ``keys`` (none: all), merged from finer sketches."""
    return sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("users")).alias("n_users"))


def estimate_error(lg_k: int = LG_K) -> float:
    """Relative standard error of an estimate."""
    return 1.04 / 2 ** (lg_k / 2)

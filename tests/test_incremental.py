"""Incremental profiles, distinct sketches, and ingest that survives a kill."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from recolens.operators import bronze, incremental
from recolens.sources import ingest

SCHEMA = "user_id string, product_id string, category string, rating double, converted int, year_month string"


def interactions(spark, n, seed, users=40):
    r = random.Random(seed)
    rows = [
        (r.choice([f"u{r.randrange(users)}", "u0", None]), r.choice(["p", None]), r.choice(["A", "B", None]),
         r.choice([None, 1.0, 4.0]), r.randrange(2), f"2026-0{r.randrange(1, 4)}")
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


def test_profiles_equal_a_rebuild_and_touch_changed_users_only(spark, tmp_path):
    path, seen = f"{tmp_path}/p", None
    for batch, n in ((1, 300), (2, 7), (5, 40), (6, 5)):
        new = interactions(spark, n, batch)
        seen = new if seen is None else seen.unionByName(new)
        incremental.add_batch(new, path, batch)
        changed = incremental.add_batch(new, path, batch)  # a retry replaces itself
        assert rows_of(changed.select("user_id")) == rows_of(new.where("user_id is not null").select("user_id").distinct())
        want = rows_of(bronze.merge_profiles(bronze.user_profile_partial(seen)))
        assert rows_of(incremental.profiles(spark, path)) == want
        if batch in (2, 6):
            incremental.compact(spark, path)
            assert rows_of(incremental.profiles(spark, path)) == want
    with pytest.raises(ValueError):
        incremental.add_batch(new, path, 6)
    with pytest.raises(ValueError):
        incremental.profiles(spark, f"{tmp_path}/nothing")


def test_sketches_roll_up(spark):
    rows = spark.range(60_000).select(
        F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(20_000))).alias("user_id"),
        F.concat(F.lit("c"), F.col("id") % 5).alias("category"), F.concat(F.lit("2026-0"), F.col("id") % 3 + 1).alias("year_month"),
    )
    sketches = incremental.user_sketches(rows.unionByName(rows.limit(5).withColumn("user_id", F.lit(None).cast("string"))))
    for keys in (["year_month", "category"], ["category"], []):
        about = {tuple(x[:-1]): x[-1] for x in incremental.distinct_users_at(sketches, *keys).collect()}
        exact = {tuple(x[:-1]): x[-1] for x in rows.groupBy(*keys).agg(F.countDistinct("user_id")).collect()}
        assert about.keys() == exact.keys()
        assert all(abs(about[k] - n) <= 4 * incremental.estimate_error() * n for k, n in exact.items())


def test_a_kill_before_the_commit_loses_and_doubles_nothing(spark, tmp_path):
    source, table = f"{tmp_path}/in", f"{tmp_path}/t"
    frames = [spark.range(i * 100, i * 100 + 100).withColumn("x", F.col("id") * 2) for i in range(4)]

    def deliver(i):
        frames[i].coalesce(2).write.mode("append").parquet(source)

    def die():
        raise KeyboardInterrupt

    def ids():
        return sorted(r.id for r in ingest.read_committed(spark, table).collect())

    deliver(0)
    with pytest.raises(KeyboardInterrupt):
        ingest.ingest(spark, source, table, before_commit=die)
    with pytest.raises(ValueError):
        ingest.read_committed(spark, table)
    first = ingest.ingest(spark, source, table)
    assert ids() == list(range(100))
    deliver(1)
    with pytest.raises(KeyboardInterrupt):  # its rows are written, but never seen
        ingest.ingest(spark, source, table, before_commit=die)
    assert ids() == list(range(100))
    deliver(2)
    assert ingest.ingest(spark, source, table) not in (None, first)
    assert ids() == list(range(300)) and ingest.ingest(spark, source, table) is None
    assert ingest.manifest(spark, table).groupBy("batch").agg(F.max("rows").alias("n")).agg(F.sum("n")).first()[0] == 300
    assert ingest.broken_batches(spark, table) == []
    frames[3].write.mode("append").parquet(f"{table}/data/{first}")
    assert ingest.broken_batches(spark, table) == [first]

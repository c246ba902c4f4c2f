"""Streams with state: late rows, duplicates, sketches; restarts in the middle of the input."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from checks.catalog import ORACLES, QUERIES
from checks.compare import difference, oracle
from helpers import SF, rows_of
from recolens.streaming import logs, stateful

START = dt.datetime(2026, 1, 1)


def finish(query):
    query.awaitTermination(180)
    assert query.exception() is None
    return query


def arrive(spark, path, batches, schema):
    """One file per batch, written in order."""
    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(path)
    return logs.read_log(spark, path, spark.read.parquet(path).schema, files_per_trigger=1)


@pytest.mark.parametrize("name", ["stream_late_rows", "stream_latency_sketch", "stream_dedup_state"])
def test_query_equals_oracle(spark, name):
    actual = QUERIES[name](spark, SF).toPandas()
    assert difference(actual, oracle(SF).execute(ORACLES[name]).df()) is None


def test_late_rows_are_set_aside_and_counted_over_a_restart(spark, tmp_path):
    r = random.Random(4)
    batches, want, newest, n = [], {}, None, 0
    for b in range(6):
        rows = []
        for _ in range(40):
            minute = b * 60 + r.randrange(60) - (r.random() < 0.2) * r.randrange(200)
            rows.append((n, START + dt.timedelta(minutes=minute), "x"))
            want[n] = newest is not None and rows[-1][1] < newest - dt.timedelta(minutes=30)
            n += 1
        rows.append((n, None, "no time"))
        want[n] = False
        n += 1
        newest = max([t for _, t, _ in rows if t] + ([newest] if newest else []))
        batches.append(rows)
    schema = "id long, ts timestamp, late_note string"
    path, out, mark = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/c"
    for part in (batches[:3], batches[3:]):  # the second run goes on from the checkpoint
        stream = arrive(spark, path, part, schema)
        query = finish(stateful.start_split(stateful.split_late(stream, "30 minutes", shards=5), out, mark))
        assert max(stateful.state_rows(query)) <= 5  # a row a shard, whatever the input
    split = stateful.read_split(spark, out)
    assert {x.id: x.late for x in split.collect()} == want and split.count() == n
    assert any(want.values())
    counts = stateful.late_counts(split).first()
    assert (counts.n_late, counts.n_on_time) == (sum(want.values()), n - sum(want.values()))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", "none").find("RocksDB") == -1


def test_dedup_state_is_bounded_and_survives_a_restart(spark, tmp_path):
    schema = "user_id string, product_id string, ts timestamp"
    batches = [[(f"u{i % 7}", f"p{i}", START + dt.timedelta(hours=10 * b, minutes=i)) for i in range(60)] for b in range(8)]
    batches = [b + (batches[i - 1][:20] if i else []) + b[:5] for i, b in enumerate(batches)]
    path, out, mark = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/c"
    held = []
    for part in (batches[:3], batches[3:]):
        stream = arrive(spark, path, part, schema)
        held += stateful.state_rows(finish(stateful.start_dedup(stateful.dedup_state(stream, "12 hours"), out, mark)))
    got = spark.read.parquet(out).select("user_id", "product_id", "ts")
    assert rows_of(got) == rows_of(spark.createDataFrame([x for b in batches for x in b], schema).distinct())
    # 480 keys pass; the last 12 hours have about two batches of 60
    assert max(held) <= 240 and held[-1] < 240


def test_sketches_stay_within_their_rank_error(spark, tmp_path):
    r = random.Random(8)
    rows = [(START + dt.timedelta(minutes=i // 40), r.lognormvariate(3, 1), i % 3 == 0) for i in range(20_000)]
    schema = "ts timestamp, latency_ms double, cache_hit boolean"
    stream = arrive(spark, f"{tmp_path}/in", [rows[k::4] for k in range(4)], schema)
    table = stateful.latency_sketches(stream, "1 day", "2 hours", size=64)
    finish(stateful.start_sketches(table, f"{tmp_path}/out", f"{tmp_path}/c"))
    found = logs.latest(spark.read.parquet(f"{tmp_path}/out"), "window_start")
    exact = spark.createDataFrame(rows, schema)
    windows = exact.groupBy(F.window("ts", "2 hours")["start"].alias("window_start"))
    counts = windows.agg(F.count(F.lit(1)).alias("n_requests"), F.count_if("cache_hit").alias("hits"))
    assert rows_of(found.select("window_start", "n_requests", "hits")) == rows_of(counts)
    largest = found.agg(F.max(F.octet_length("sketch"))).first()[0]
    assert largest < 4000  # 4800 latencies a window
    for sketches, size in ((found, "2 hours"), (stateful.rolled_up(found, "1 day"), "1 day")):
        p95 = sketches.select("window_start", stateful.sketch_quantile().alias("p95"))
        ranks = exact.withColumn("window_start", F.window("ts", size)["start"]).join(p95, "window_start").groupBy("window_start").agg(
            F.avg((F.col("latency_ms") <= F.col("p95")).cast("double")).alias("rank")
        )
        worst = ranks.agg(F.max(F.abs(F.col("rank") - 0.95))).first()[0]
        assert worst <= 2 * stateful.rank_error(64)

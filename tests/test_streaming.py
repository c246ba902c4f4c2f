"""Streams over bounded files end in what the batch operators give."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows_of
from recolens.operators import abtest, service
from recolens.schema import FEEDBACK, IMPRESSIONS
from recolens.sources import writers
from recolens.streaming import logs, partials


def finish(query):
    query.awaitTermination(120)
    assert query.exception() is None
    return query


def test_feedback_is_split_into_accepted_and_rejected(spark, lake, tmp_path):
    raw = lake.raw_feedback().drop("event_id")
    raw.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = logs.read_log(spark, f"{tmp_path}/in", FEEDBACK, files_per_trigger=1)
    finish(logs.stream_feedback(stream, f"{tmp_path}/ok", f"{tmp_path}/bad", f"{tmp_path}/cp"))
    good, bad = abtest.validate_feedback(raw)
    assert rows_of(spark.read.parquet(f"{tmp_path}/ok").drop("batch_id")) == rows_of(good)
    assert rows_of(spark.read.parquet(f"{tmp_path}/bad").drop("batch_id")) == rows_of(bad)
    # a second run over the same log adds nothing
    finish(logs.stream_feedback(stream, f"{tmp_path}/ok", f"{tmp_path}/bad", f"{tmp_path}/cp"))
    assert spark.read.parquet(f"{tmp_path}/ok").count() == good.count()


def test_impressions_get_their_variant(spark, lake, tmp_path):
    requests = lake.requests().select("user_id", "ts")
    requests.write.parquet(f"{tmp_path}/in")
    stream = logs.read_log(spark, f"{tmp_path}/in", requests.schema)
    finish(logs.stream_impressions(stream, f"{tmp_path}/out", f"{tmp_path}/cp"))
    assert rows_of(spark.read.parquet(f"{tmp_path}/out")) == rows_of(lake.impressions())


def test_running_ab_counts_end_as_the_batch_counts(spark, lake, tmp_path):
    writers.append_impressions(lake.impressions(), f"{tmp_path}/imp")
    writers.append_feedback(lake.feedback(), f"{tmp_path}/fb")
    shown = logs.ab_users(logs.read_log(spark, f"{tmp_path}/imp", IMPRESSIONS))
    acted = logs.ab_clicks(logs.read_log(spark, f"{tmp_path}/fb", FEEDBACK))
    finish(logs.start_table(shown, "ab_users_out", f"{tmp_path}/c1", "complete"))
    finish(logs.start_table(acted, "ab_clicks_out", f"{tmp_path}/c2", "complete"))
    batch = abtest.ab_counts(lake.impressions(), lake.feedback())
    assert rows_of(spark.table("ab_users_out")) == rows_of(batch.select("ab_variant", "n_users"))
    assert rows_of(spark.table("ab_clicks_out")) == rows_of(batch.select("ab_variant", "n_clicks"))


def test_service_metrics(spark, lake, tmp_path):
    requests = lake.requests()
    requests.write.parquet(f"{tmp_path}/in")
    stream = logs.with_event_time(logs.read_log(spark, f"{tmp_path}/in", requests.schema), "10 minutes")
    finish(logs.start_table(logs.service_latency(stream), "latency_out", f"{tmp_path}/c", "update"))
    out = spark.table("latency_out")
    hits = service.cache_hit_rate(requests).select("window_start", "n_requests", "hits")
    assert rows_of(out.select("window_start", "n_requests", "hits")) == rows_of(hits)
    spread = out.join(service.latency_p95(requests).withColumnRenamed("latency_p95", "exact"), "window_start")
    # the sketch returns a latency that occurred, the exact form interpolates upwards to it
    assert spread.filter(F.col("latency_p95") < F.col("exact") - 1e-9).isEmpty()


def test_ctr_per_hour(spark, lake, tmp_path):
    both = lake.requests().select("ts", F.lit(True).alias("is_request")).unionByName(
        lake.feedback().select("ts", F.lit(False).alias("is_request"))
    )
    both.write.parquet(f"{tmp_path}/in")
    stream = logs.with_event_time(logs.read_log(spark, f"{tmp_path}/in", both.schema), "10 minutes")
    finish(logs.start_table(logs.service_ctr(stream), "ctr_out", f"{tmp_path}/c", "update"))
    got = spark.table("ctr_out").filter("n_requests > 0")
    assert rows_of(got) == rows_of(service.ctr_rate(lake.requests(), lake.feedback()).filter("n_requests > 0"))


def stamps(spark, tmp_path, *batches):
    """One file per batch, in order."""
    schema = "user_id string, product_id string, category string, ts timestamp"
    for i, batch in enumerate(batches):
        rows = [("u", p, "A", dt.datetime(2026, 1, 1) + dt.timedelta(minutes=m)) for p, m in batch]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = logs.read_log(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, files_per_trigger=1)
    return logs.with_event_time(stream, "10 minutes")


def test_stream_dedup_within_the_watermark(spark, tmp_path):
    stream = stamps(spark, tmp_path, [("a", 0), ("a", 0), ("b", 1)], [("a", 0), ("a", 2)], [("b", 1)])
    finish(logs.start_files(logs.dedup_stream(stream), f"{tmp_path}/out", f"{tmp_path}/c"))
    got = [(r.product_id, r.ts.minute) for r in spark.read.parquet(f"{tmp_path}/out").collect()]
    assert sorted(got) == [("a", 0), ("a", 2), ("b", 1)]


def test_popularity_per_window_and_late_rows(spark, tmp_path):
    # rows are late once a batch has run with the advanced watermark, hence the third batch
    stream = stamps(
        spark, tmp_path, [("a", 0), ("a", 5), ("b", 6)], [("a", 200)], [("c", 202)], [("a", 1), ("a", 201)]
    )
    query = finish(logs.start_updates(logs.popularity_stream(stream), f"{tmp_path}/out", f"{tmp_path}/c"))
    updates = spark.read.parquet(f"{tmp_path}/out")
    assert updates.select("batch_id").distinct().count() > 1
    final = logs.latest(updates, "window_start", "category", "product_id").collect()
    assert {(r.window_start.hour, r.product_id): r.nb_interactions for r in final} == {(0, "a"): 2, (0, "b"): 1, (3, "a"): 2, (3, "c"): 1}
    assert logs.late_rows(query) == 1


def test_watermark_needs_zoned_time(spark, lake):
    raw = spark.readStream.schema(lake.table("events").schema).parquet("/root/testdata/sf0.001/events.parquet")
    assert dict(logs.with_event_time(raw, "1 minute").dtypes)["ts"] == "timestamp"
    with pytest.raises(Exception):
        raw.withWatermark("ts", "1 minute").groupBy(F.window("ts", "1 minute")).count().writeStream.format("noop").start()


@pytest.mark.parametrize("seed", [1, 2])
def test_partials_lose_no_late_row(spark, lake, tmp_path, seed):
    """Six files in shuffled order, one per trigger, give what the batch operators give."""
    rows = lake.interactions().filter("user_id is not null and product_id is not null").withColumn(
        "ts", F.timestamp_millis("timestamp")
    )
    rows.repartition(6, F.rand(seed)).write.parquet(f"{tmp_path}/in")
    stream = logs.read_log(spark, f"{tmp_path}/in", rows.schema, files_per_trigger=1)
    finish(partials.start_partials(stream, partials.popularity, f"{tmp_path}/p", f"{tmp_path}/c1"))
    kept = spark.read.parquet(f"{tmp_path}/p")
    assert kept.select("batch_id").distinct().count() == 6
    assert rows_of(partials.merge_popularity(kept)) == rows_of(partials.popularity(rows))
    finish(partials.start_partials(stream.drop("ts"), partials.dedup, f"{tmp_path}/d", f"{tmp_path}/c2"))
    once = partials.dedup(spark.read.parquet(f"{tmp_path}/d").drop("batch_id"))
    assert rows_of(once) == rows_of(partials.dedup(rows.drop("ts")))


def test_latency_partials_are_exact(spark, lake, tmp_path):
    requests = lake.requests()
    requests.repartition(5, F.rand(3)).write.parquet(f"{tmp_path}/in")
    stream = logs.read_log(spark, f"{tmp_path}/in", requests.schema, files_per_trigger=1)
    finish(partials.start_partials(stream, partials.latency, f"{tmp_path}/p", f"{tmp_path}/c"))
    got = partials.merge_latency(spark.read.parquet(f"{tmp_path}/p"))
    assert rows_of(got.drop("hits")) == rows_of(service.latency_p95(requests))
    hits = service.cache_hit_rate(requests).select("window_start", "hits", "n_requests")
    assert rows_of(got.select("window_start", "hits", "n_requests")) == rows_of(hits)

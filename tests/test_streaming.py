"""Streams give the same results as the batch operators."""

import collections
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from stategrid.operators.batching import batch_rows
from stategrid.operators.counters import ingest_counters
from stategrid.operators.states import state_changes, with_reason
from stategrid.plans import alerts as al
from stategrid.sinks.store import read_group
from stategrid.sources import fixture
from stategrid.streaming.batcher import batch_stream, drain
from stategrid.streaming import metrics
from stategrid.streaming.pipeline import process_batch, stream_changes

from conftest import SF
from frames import frame, state


def test_stream_changes_equals_batch(spark, tmp_dir):
    events = spark.read.parquet(os.path.join(SF["0.001"], "events.parquet"))
    text = fixture.event_frame_text(events)
    src = f"{tmp_dir}/in"
    # two files -> two micro-batches
    text.where("seq % 2 = 0").select("raw").coalesce(1).write.text(f"{src}/a")
    text.where("seq % 2 = 1").select("raw").coalesce(1).write.text(f"{src}/b")
    out = f"{tmp_dir}/out"
    q = stream_changes(spark, f"{src}/*", out, f"{tmp_dir}/ckpt", max_files_per_trigger=1)
    q.awaitTermination(300)
    assert q.exception() is None
    expected = state_changes(fixture.event_frames(events))
    for g, col in [("bool", "state_bool"), ("string", "state_text"), ("double", "state_double"),
                   ("bigint", "state_long"), ("timestamp", "state_time")]:
        exp = sorted((r.entity_id, r.last_updated, r[col]) for r in
                     expected.where(F.col("type_group") == g).collect())
        got = sorted((r.entity_id, r.last_updated, r.state) for r in
                     read_group(spark, out, g).collect()) if exp else []
        assert got == exp, g
    rej = spark.read.parquet(f"{out}/_rejects")
    assert rej.count() == events.count() - expected.count()
    assert {r.batch for r in rej.select("batch").distinct().collect()} == {0, 1}


def run_batcher(spark, tmp_dir, parts, lateness, size, wait):
    """The records of a stream over ``parts`` (one micro-batch each) and of its drain."""
    src, n = f"{tmp_dir}/ev", len(parts)
    for i, p in enumerate(parts):
        p.coalesce(1).write.parquet(f"{src}/p{i}")
        os.utime(next(os.path.join(f"{src}/p{i}", f) for f in os.listdir(f"{src}/p{i}")
                      if f.endswith(".parquet")), (1_700_000_000 + i,) * 2)
    stream = (spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1)
              .parquet(f"{src}/*"))
    out = batch_stream(stream, "event_type", "ts", "event_id", max_size=size, max_wait=wait,
                       lateness=lateness)
    q = (out.writeStream.format("parquet").option("path", f"{tmp_dir}/out").outputMode("append")
         .option("checkpointLocation", f"{tmp_dir}/ck2").trigger(availableNow=True).start())
    q.awaitTermination(300)
    assert q.exception() is None and q.lastProgress["batchId"] >= n - 1
    return (spark.read.parquet(f"{tmp_dir}/out").collect()
            + drain(spark, f"{tmp_dir}/ck2", max_size=size, max_wait=wait).collect())


def check_batches(got, events, size, wait):
    """Rows equal ``batch_rows`` of the rows that were not late; one close a batch."""
    late = {r.seq for r in got if r.kind == "late"}
    on_time = events.where(~F.col("event_id").isin(*late)) if late else events
    exp = {(r.event_type, r.event_id): (r.batch_no, r.batch_start) for r in
           batch_rows(on_time, "event_type", "ts", ["ts", "event_id"], size, wait).collect()}
    rows = [r for r in got if r.kind == "row"]
    assert {(r.key, r.seq): (r.batch_no, r.batch_start) for r in rows} == exp
    assert len(rows) == len(exp) and len(rows) + len(late) == events.count()
    sizes = collections.Counter((k, b) for (k, _), (b, _) in exp.items())
    assert collections.Counter({(r.key, r.batch_no): r.size for r in got if r.kind == "close"}) == sizes
    assert sum(r.kind == "close" for r in got) == len(sizes)
    return late


def test_shuffled_micro_batches_equal_batch_rows(spark, tmp_dir):
    """Any order of arrival within the lateness: every row once, no late ones."""
    events = spark.read.parquet(os.path.join(SF["0.001"], "events.parquet")) \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    parts = [events.where(F.pmod(F.xxhash64("event_id"), F.lit(3)) == i) for i in range(3)]
    got = run_batcher(spark, tmp_dir, parts, "60d", 7, "2h")
    assert not check_batches(got, events, 7, "2h")


def test_late_rows_come_out_as_errors(spark, tmp_dir):
    """No lateness allowed: what a key has passed is late, the rest is batched."""
    events = spark.read.parquet(os.path.join(SF["0.001"], "events.parquet")) \
        .withColumn("ts", F.col("ts").cast("timestamp"))
    mid = events.selectExpr("percentile_approx(unix_micros(ts), 0.5)").first()[0]
    early = F.unix_micros("ts") <= mid
    held = early & (F.pmod(F.xxhash64("event_id"), F.lit(10)) == 0)
    parts = [events.where(early & ~held), events.where(~early), events.where(held)]
    got = run_batcher(spark, tmp_dir, parts, "0s", 20, "2h")
    late = check_batches(got, events, 20, "2h")
    assert late == {r.event_id for r in events.where(held).collect()}


def test_dump_events_console_stream(spark, tmp_dir):
    from stategrid.streaming.pipeline import dump_events
    from frames import SAMPLE, frame, state
    src = f"{tmp_dir}/dump"
    spark.createDataFrame([(SAMPLE,), (frame(state("light.a", "on"), None),)], "value string") \
        .coalesce(1).write.text(src)
    q = dump_events(spark, src, f"{tmp_dir}/dump_ckpt")
    q.awaitTermination(120)
    assert q.exception() is None
    assert q.lastProgress["numInputRows"] == 2


def test_stream_metrics(spark, tmp_dir):
    """Samples of a drained stream equal the counters of the same frames; batch
    and insert durations of the run reach the quantiles the rules read."""
    events = spark.read.parquet(os.path.join(SF["0.001"], "events.parquet"))
    text = fixture.event_frame_text(events)
    src, out = f"{tmp_dir}/in", f"{tmp_dir}/out"
    text.where("seq % 2 = 0").select("raw").coalesce(1).write.text(f"{src}/a")
    text.where("seq % 2 = 1").select("raw").coalesce(1).write.text(f"{src}/b")
    for i, part in enumerate("ab"):
        for f in os.listdir(f"{src}/{part}"):
            os.utime(f"{src}/{part}/{f}", (1_700_000_000 + i,) * 2)
    heard = metrics.BatchDurations(spark, out)
    spark.streams.addListener(heard)
    try:
        q = stream_changes(spark, f"{src}/*", out, f"{tmp_dir}/ckpt", max_files_per_trigger=1,
                           durations=heard)
        q.awaitTermination(300)
        assert q.exception() is None and heard.wait()
    finally:
        spark.streams.removeListener(heard)
    process_batch(text.where("seq % 2 = 0").select("raw"), 0, out)      # a replay counts once
    seen = metrics.read_observations(spark, out).persist()
    samples = metrics.metric_samples(seen, "1s").persist()
    last = {(r.metric, tuple(sorted(r.labels.items()))): r.v for r in samples.groupBy(
        "metric", F.map_entries("labels").alias("e")).agg(F.max("value").alias("v"))
        .select("metric", F.map_from_entries("e").alias("labels"), "v").collect()}
    counts = {r.counter: r.value for r in
              ingest_counters(with_reason(fixture.event_frames(events))).collect()}
    for c in ("received", "filtered", "processed"):
        assert last[(f"ingest_events_{c}_total", ())] == counts[c]
    assert last[("ingest_database_operations_total",
                 (("operation", "create_table"), ("status", "success")))] == 5
    assert last[("ingest_batch_processing_duration_seconds_count", ())] == 2
    assert last[("ingest_batch_size_sum", ())] == counts["processed"]
    inserts = last[("ingest_database_operations_total",
                    (("operation", "insert"), ("status", "success")))]
    assert inserts == last[("ingest_batches_processed_total", ())] == last[
        ("ingest_store_query_duration_seconds_count", (("query_type", "insert"),))]
    slow = al.quantile_of_rates(al.rates(samples, [al.M_BATCH_DURATION + "_bucket"], "5m", "1s"),
                               al.M_BATCH_DURATION, 0.95).collect()
    assert slow and all(r.value is None or 0 < r.value <= 10 for r in slow)
    assert any(r.value for r in slow)


def test_failed_insert_is_counted(spark, tmp_dir):
    out = f"{tmp_dir}/out"
    raws = [frame(state("light.a", "on"), state("light.a", "off"))]
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    os.makedirs(out)
    open(f"{out}/string", "w").close()               # a file where the dataset should be
    with pytest.raises(Exception):
        process_batch(df, 0, out)
    got = metrics.read_observations(spark, out).collect()
    assert [(r.metric, r.operation, r.status, r.value) for r in got] == [
        ("database_operations_total", "insert", "error", 1.0)]


def test_metric_samples_small(spark):
    empty = spark.createDataFrame([], metrics.OBSERVATION)
    assert metrics.metric_samples(empty).count() == 0
    t = dt.datetime(2024, 1, 1, 0, 0, 10)
    rows = [(t, "counter", "x_total", None, "", "", 2.0), (t, "counter", "x_total", "", "", "", None),
            (t + dt.timedelta(seconds=60), "counter", "x_total", "", "", "", 3.0),
            (None, "counter", "x_total", "", "", "", 9.0),
            (t, "histogram", "batch_size", "", "", "", 110.0)]
    got = metrics.metric_samples(spark.createDataFrame(rows, metrics.OBSERVATION), "30s").collect()
    x = sorted((r.ts, r.value) for r in got if r.metric == "ingest_x_total")
    start = dt.datetime(2024, 1, 1)
    assert x == [(start + dt.timedelta(seconds=30 * i), v) for i, v in enumerate([0, 2, 2, 5])]
    top = {r.labels["le"]: r.value for r in got if r.metric == "ingest_batch_size_bucket"
           and r.ts == start + dt.timedelta(seconds=90)}
    assert top["10"] == 0 and top["110"] == 1 and top["+Inf"] == 1 and len(top) == 11

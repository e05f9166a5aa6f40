"""The pipeline's metrics as samples, its ten alert rules and its dashboard
panels, composed from the series operators.

Metric samples: ``ts timestamp, metric string, labels map<string,string>,
value double``. A series is (metric, labels); inside the plans the labels are
carried as a canonical text key (sorted entries as JSON), since maps cannot
be grouped on.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stategrid.functions.values import parse_ts
from stategrid.operators.counters import is_received
from stategrid.operators import series as ts
from stategrid.session import scratch_folder

# ---------------------------------------------------------------------------
# Metric names, buckets and alert rules of the source system.
# ---------------------------------------------------------------------------
# The job's metric names are <prefix><name>; pass the deployment's prefix.
PREFIX = "ingest_"
M_RECEIVED = PREFIX + "events_received_total"
M_FILTERED = PREFIX + "events_filtered_total"
M_PROCESSED = PREFIX + "events_processed_total"
M_BATCHES = PREFIX + "batches_processed_total"
M_BATCH_SIZE = PREFIX + "batch_size"
M_DB_OPS = PREFIX + "database_operations_total"
M_BATCH_DURATION = PREFIX + "batch_processing_duration_seconds"
M_SOURCE_UP = PREFIX + "source_connection_status"
M_STORE_UP = PREFIX + "store_connection_status"
M_QUERY_DURATION = PREFIX + "store_query_duration_seconds"
M_RETRY = PREFIX + "store_retry_attempts_total"
M_RETRY_OK = PREFIX + "store_retry_success_total"
BATCH_SIZE_BOUNDS = ts.linear_bounds(10, 100, 10)     # 10, 110, .. 910

# (name, severity, hold, threshold) per rule; the expressions are in alert_rules.
RULES = [
    ("PodNotRunning", "critical", "5m", 1.0),       # threshold = replicas
    ("ConnectionDown", "critical", "5m", 0.0),
    ("NoEventsReceived", "warning", "30m", 0.0),
    ("HighEventFilterRate", "warning", "15m", 0.5),
    ("SlowBatchProcessing", "warning", "15m", 5.0),
    ("DatabaseErrors", "warning", "15m", 0.0),
    ("HighRetryRate", "warning", "15m", 1.0),
    ("SlowDatabaseQueries", "warning", "15m", 10.0),
    ("HighCPUUsage", "warning", "15m", 0.8),
    ("HighMemoryUsage", "warning", "15m", 0.8),
]


def series_key(labels: Column, drop: Sequence[str] = ()) -> Column:
    """Canonical text of a label map (optionally without some labels)."""
    m = labels
    if drop:
        m = F.map_filter(m, lambda k, v: ~k.isin(*drop))
    return F.to_json(F.array_sort(F.map_entries(m)))


def as_samples(df: DataFrame, metric: str, label_cols: Sequence[str] = (),
               t: str = "t", value: str = "value") -> DataFrame:
    labels = F.create_map(*[x for c in label_cols for x in (F.lit(c), F.col(c).cast("string"))]) \
        if label_cols else F.create_map().cast("map<string,string>")
    return df.select(F.col(t).alias("ts"), F.lit(metric).alias("metric"), labels.alias("labels"),
                     F.col(value).cast("double").alias("value"))


_LABELS = ("operation", "status", "le")


def pipeline_metrics(staged_frames: DataFrame, batches: DataFrame, step="30s") -> DataFrame:
    """Counters the ingest job exports, computed from what it read and wrote.

    ``staged_frames``: frames with ``reason`` (``operators.states.with_reason``);
    ``batches``: the batched events with ``domain``, ``batch_no``, ``batch_start``
    (``operators.batching.batch_rows``). Times are event times.

    All counters come from one union of tagged rows and one
    ``counter_samples`` over (metric, labels): one aggregate, one
    densification and one running sum for every series together.
    """
    def tag(df: DataFrame, t: str, metric: str, **labels) -> DataFrame:
        return df.select(F.col(t).alias("t_obs"), F.lit(metric).alias("metric"),
                         *[F.lit(labels.get(k, "")).alias(k) for k in _LABELS])

    ev = staged_frames.where(is_received()).select(
        parse_ts(F.col("event.time_fired")).alias("t_ev"), "reason")
    per_batch = batches.groupBy("domain", "batch_no").agg(
        F.min("batch_start").alias("t_b"), F.count(F.lit(1)).alias("size"))
    bounds = BATCH_SIZE_BOUNDS + [float("inf")]
    le_text = F.when(F.col("_le") == float("inf"), "+Inf") \
        .otherwise(F.regexp_replace(F.col("_le").cast("string"), r"\.0$", ""))
    sized = (per_batch.withColumn("_le", F.explode(F.array(*[F.lit(b) for b in bounds])))
                      .where(F.col("size") <= F.col("_le"))
                      .select(F.col("t_b").alias("t_obs"),
                              F.lit(M_BATCH_SIZE + "_bucket").alias("metric"),
                              F.lit("").alias("operation"), F.lit("").alias("status"),
                              le_text.alias("le")))
    rows = (tag(ev, "t_ev", M_RECEIVED)
            .unionByName(tag(ev.where(F.col("reason") == "event_type"), "t_ev", M_FILTERED))
            .unionByName(tag(ev.where(F.col("reason").isNull()), "t_ev", M_PROCESSED))
            .unionByName(tag(per_batch, "t_b", M_BATCHES))
            .unionByName(tag(per_batch, "t_b", M_DB_OPS, operation="insert", status="success"))
            .unionByName(sized))
    c = ts.counter_samples(rows, "t_obs", ["metric", *_LABELS], step)
    labels = F.map_filter(F.create_map(*[x for k in _LABELS for x in (F.lit(k), F.col(k))]),
                          lambda k, v: v != "")
    return c.select(F.col("t").alias("ts"), "metric", labels.alias("labels"),
                    F.col("value").cast("double").alias("value"))


# -- PromQL building blocks over samples --------------------------------------------

def _sel(samples: DataFrame, metric: str, **labels: str) -> DataFrame:
    s = ts.select_series(samples, metric, **labels)
    return s.select("ts", "labels", "value", series_key(F.col("labels")).alias("sk"))


def instant(samples: DataFrame, metric: str, step, lookback="5m", **labels) -> DataFrame:
    """Instant vector on the step grid: per series and step, the latest sample
    in (t - lookback, t] (each sample is slid onto its lookback steps)."""
    s = _sel(samples, metric, **labels)
    st, lb = ts.seconds(step), ts.seconds(lookback)
    first = ts.step_of(F.col("ts"), step)
    spread = s.select("sk", "labels", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("_us"),
                      F.explode(F.sequence(first, first + F.lit(((lb // st) - 1) * st), F.lit(st)))
                      .alias("t_sec"))
    spread = spread.where(F.col("_us") > (F.col("t_sec") - F.lit(lb)) * F.lit(1_000_000))
    latest = spread.groupBy("sk", "t_sec").agg(
        F.max_by(F.struct("value", "labels"), "_us").alias("_l"))
    return latest.select("sk", F.timestamp_seconds("t_sec").alias("t"), "_l.labels", "_l.value")


_RATE_SCHEMA = "metric string, labels map<string,string>, sk string, t timestamp, value double"


def rates(samples: DataFrame, metrics: Sequence[str], window, step) -> DataFrame:
    """Rates of all series of some counters, ``metric, labels, sk, t, value``:
    computed once and written by metric, so that each rule or panel reads only
    its counters' part. The labels are read back from the series' key."""
    spark = samples.sparkSession
    s = samples.where(F.col("metric").isin(*metrics)).select(
        "metric", "ts", "value", series_key(F.col("labels")).alias("sk"))
    r = ts.rate_samples(s, ["metric", "sk"], window, step, ts="ts", extrapolate=True)
    path = scratch_folder(spark, "rates")
    r.select("metric", F.map_from_entries(F.from_json(
        "sk", "array<struct<key:string,value:string>>")).alias("labels"), "sk", "t", "value") \
        .write.partitionBy("metric").parquet(path)
    return spark.read.schema(_RATE_SCHEMA).parquet(path)


def rate(table: DataFrame, metric: str, **labels) -> DataFrame:
    """The rates of one counter's series, from a table of ``rates``."""
    return ts.select_series(table, metric, **labels).select("sk", "t", "labels", "value")


def total(df: DataFrame) -> DataFrame:
    """sum(...) without by: one value per step."""
    return df.groupBy("t").agg(F.sum("value").alias("value")).withColumn("sk", F.lit("[]"))


def quantile_of_rates(table: DataFrame, metric: str, q: float, **labels) -> DataFrame:
    """histogram_quantile(q, rate(metric_bucket[w])) per series (labels but le)."""
    r = rate(table, metric + "_bucket", **labels)
    le = F.when(F.col("labels")["le"] == "+Inf", F.lit(float("inf"))) \
          .otherwise(F.col("labels")["le"].cast("double"))
    h = r.select(series_key(F.col("labels"), ["le"]).alias("sk"), "t", le.alias("le"), "value")
    return ts.bucket_quantile(h, q, ["sk", "t"])


def quantile_over_all(table: DataFrame, metric: str, q: float, **labels) -> DataFrame:
    """histogram_quantile(q, sum by (le) (rate(metric_bucket[w]))): one histogram
    per step over all series."""
    r = rate(table, metric + "_bucket", **labels)
    h = (r.groupBy("t", F.col("labels")["le"].alias("_le")).agg(F.sum("value").alias("value"))
          .select(F.lit("[]").alias("sk"), "t", "value",
                  F.when(F.col("_le") == "+Inf", F.lit(float("inf")))
                   .otherwise(F.col("_le").cast("double")).alias("le")))
    return ts.bucket_quantile(h, q, ["sk", "t"])


def max_by_service(v: DataFrame) -> DataFrame:
    """max by (service) (v)."""
    return _by_label(v, "service", F.max("value"))


def alert_rules(samples: DataFrame, step="30s", replicas: int = 1,
                container: str = "ingest") -> DataFrame:
    """The ten alert rules: ``alertname, severity, sk (series), t, state,
    active_since`` for every step where a rule is pending or firing."""
    r = {name: (sev, hold, thr) for name, sev, hold, thr in RULES}
    five = rates(samples, [M_FILTERED, M_RECEIVED, M_BATCH_DURATION + "_bucket", M_DB_OPS, M_RETRY,
                           M_QUERY_DURATION + "_bucket", "container_cpu_usage_seconds_total"],
                 "5m", step)
    out = []

    def add(name: str, cond: DataFrame):
        sev, hold, _ = r[name]
        a = ts.alert(cond.select("sk", "t"), hold, step, ["sk"])
        out.append(a.select(F.lit(name).alias("alertname"), F.lit(sev).alias("severity"),
                            "sk", "t", "state", "active_since"))

    running = total(instant(samples, "kube_pod_container_status_running", step, container=container))
    add("PodNotRunning", ts.compare(running, "<", float(replicas)))
    down = ts.vector_or(ts.compare(instant(samples, M_SOURCE_UP, step), "==", 0.0),
                        ts.compare(instant(samples, M_STORE_UP, step), "==", 0.0), ["sk", "t"])
    add("ConnectionDown", down)
    half_hour = rates(samples, [M_RECEIVED], "30m", step)
    add("NoEventsReceived", ts.compare(rate(half_hour, M_RECEIVED), "==", 0.0))
    share = ts.vector_binary(rate(five, M_FILTERED).select("sk", "t", "value"),
                             rate(five, M_RECEIVED).select("sk", "t", "value"),
                             ["sk", "t"], "/")
    add("HighEventFilterRate", ts.compare(share, ">", r["HighEventFilterRate"][2]))
    add("SlowBatchProcessing", ts.compare(
        quantile_of_rates(five, M_BATCH_DURATION, 0.95), ">",
        r["SlowBatchProcessing"][2]))
    add("DatabaseErrors", ts.compare(
        rate(five, M_DB_OPS, status="error"), ">", 0.0))
    add("HighRetryRate", ts.compare(rate(five, M_RETRY), ">", 1.0))
    add("SlowDatabaseQueries", ts.compare(
        quantile_of_rates(five, M_QUERY_DURATION, 0.95, query_type="insert"),
        ">", 10.0))
    cpu = ts.vector_binary(
        total(rate(five, "container_cpu_usage_seconds_total", container=container)),
        total(instant(samples, "kube_pod_container_resource_limits", step,
                      container=container, resource="cpu")), ["sk", "t"], "/")
    add("HighCPUUsage", ts.compare(cpu, ">", 0.8))
    mem = ts.vector_binary(
        total(instant(samples, "container_memory_working_set_bytes", step, container=container)),
        total(instant(samples, "kube_pod_container_resource_limits", step,
                      container=container, resource="memory")), ["sk", "t"], "/")
    add("HighMemoryUsage", ts.compare(mem, ">", 0.8))
    res = out[0]
    for o in out[1:]:
        res = res.unionByName(o)
    return res


def panels(samples: DataFrame, step="30s") -> DataFrame:
    """The dashboards' panels as one long table ``panel, series, sk, t, value``;
    ``series`` is the legend, ``sk`` the labels that the expression keeps."""
    def p(panel: str, series: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(panel).alias("panel"), F.lit(series).alias("series"), "sk", "t",
                         F.col("value").cast("double").alias("value"))

    def by_label(panel: str, fmt_label: str, suffix: str, df: DataFrame) -> DataFrame:
        return df.select(F.lit(panel).alias("panel"),
                         F.concat(F.coalesce(F.col("labels")[fmt_label], F.lit("")), F.lit(suffix))
                         .alias("series"), "sk", "t", F.col("value").cast("double").alias("value"))

    five = rates(samples, [M_RECEIVED, M_FILTERED, M_PROCESSED, M_BATCHES, M_DB_OPS, M_RETRY, M_RETRY_OK,
                           M_BATCH_DURATION + "_bucket", M_BATCH_SIZE + "_bucket",
                           M_QUERY_DURATION + "_bucket"], "5m", step)
    recv = total(rate(five, M_RECEIVED))
    filt = total(rate(five, M_FILTERED))
    parts = [
        p("Connection Status", "Source Connection",
          max_by_service(instant(samples, M_SOURCE_UP, step))),
        p("Connection Status", "Store Connection",
          max_by_service(instant(samples, M_STORE_UP, step))),
        p("Event Rates", "Receive Rate", recv),
        p("Event Rates", "Process Rate", ts.vector_binary(recv, filt, ["sk", "t"], "-")),
        p("Event Rates", "Filter Rate", filt),
        p("Event Processing Rate", "Events Received", rate(five, M_RECEIVED)),
        p("Event Processing Rate", "Events Processed", rate(five, M_PROCESSED)),
        p("Batch Processing Rate", "Batches Processed", rate(five, M_BATCHES)),
        p("Batch Processing Duration", "Batch Processing (p95)",
          quantile_over_all(five, M_BATCH_DURATION, 0.95)),
        p("Batch Processing Duration", "Batch Processing (p50)",
          quantile_over_all(five, M_BATCH_DURATION, 0.50)),
        p("Batch Size", "Batch Size (p95)", quantile_over_all(five, M_BATCH_SIZE, 0.95)),
        p("Batch Size", "Batch Size (p50)", quantile_over_all(five, M_BATCH_SIZE, 0.50)),
        by_label("Database Operations", "operation", " - success",
                 _by_label(rate(five, M_DB_OPS, status="success"), "operation", F.sum("value"))),
        by_label("Database Operations", "operation", " - error",
                 _by_label(rate(five, M_DB_OPS, status="error"), "operation", F.sum("value"))),
        p("Database Query Duration", "Insert Queries (p95)",
          quantile_over_all(five, M_QUERY_DURATION, 0.95, query_type="insert")),
        p("Database Query Duration", "Insert Queries (p50)",
          quantile_over_all(five, M_QUERY_DURATION, 0.50, query_type="insert")),
        p("Store Query Duration", "Insert Query Duration (p95)",
          quantile_over_all(five, M_QUERY_DURATION, 0.95, query_type="insert")),
        p("Retry Rate", "Retry Attempts", rate(five, M_RETRY)),
        p("Retry Rate", "Successful Retries", rate(five, M_RETRY_OK)),
    ]
    inc_att = total(_increase(samples, M_RETRY, "1h", step))
    inc_ok = total(_increase(samples, M_RETRY_OK, "1h", step))
    parts += [p("Retry Count (1h)", "Retry Attempts", inc_att),
              p("Retry Count (1h)", "Successful Retries", inc_ok),
              p("Retry Success Rate (1h)", "Success Rate",
                ts.vector_binary(inc_ok, inc_att, ["sk", "t"], "/"))]
    res = parts[0]
    for x in parts[1:]:
        res = res.unionByName(x)
    return res


def _by_label(df: DataFrame, label: str, value: Column) -> DataFrame:
    """An aggregate by one label; a series without it has no labels left."""
    labels = F.when(F.col("_l").isNull(), F.create_map().cast("map<string,string>")) \
              .otherwise(F.create_map(F.lit(label), F.col("_l")))
    return (df.groupBy(F.col("labels")[label].alias("_l"), "t").agg(value.alias("value"))
              .select(labels.alias("labels"), "t", "value")
              .select("*", series_key(F.col("labels")).alias("sk")))


def _increase(samples: DataFrame, metric: str, window, step) -> DataFrame:
    s = _sel(samples, metric)
    return ts.increase_samples(s.select("sk", "ts", "value"), ["sk"], window, step, ts="ts",
                               extrapolate=True)


__all__ = ["pipeline_metrics", "alert_rules", "panels", "instant", "rates", "rate", "RULES"]

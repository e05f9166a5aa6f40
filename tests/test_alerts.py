"""Alert rules and panels on literal metric samples."""

import datetime as dt

from pyspark.sql import functions as F

from stategrid.plans import alerts as al

T0 = dt.datetime(2024, 1, 1)


def samples(spark, rows):
    return spark.createDataFrame(
        [(T0 + dt.timedelta(minutes=m), metric, labels, float(v)) for m, metric, labels, v in rows],
        "ts timestamp, metric string, labels map<string,string>, value double")


def test_filter_share_and_pod_rules(spark):
    rows = []
    for m in range(0, 41):
        rows.append((m, al.M_RECEIVED, {}, 10 * m))
        rows.append((m, al.M_FILTERED, {}, 6 * m))           # 60 % filtered
        rows.append((m, "kube_pod_container_status_running", {"container": "ingest"},
                     0 if m < 12 else 1))
    out = al.alert_rules(samples(spark, rows), "1m")
    got = {(r.alertname, r.t): r.state for r in out.collect()}
    share = sorted(t for (n, t) in got if n == "HighEventFilterRate")
    assert share[0] == T0 + dt.timedelta(minutes=1)          # two samples in the window
    assert got[("HighEventFilterRate", T0 + dt.timedelta(minutes=15))] == "pending"
    assert got[("HighEventFilterRate", T0 + dt.timedelta(minutes=16))] == "firing"
    pod = {t: s for (n, t), s in got.items() if n == "PodNotRunning"}
    assert pod[T0] == "pending" and pod[T0 + dt.timedelta(minutes=5)] == "firing"
    # the gauge is back at 1 from minute 12, but an instant vector looks back
    # 5 min for the latest sample: minute 12 already sees the new value
    assert T0 + dt.timedelta(minutes=12) not in pod
    assert {n for (n, _) in got} == {"HighEventFilterRate", "PodNotRunning"}
    sev = {r.alertname: r.severity for r in out.select("alertname", "severity").distinct().collect()}
    assert sev == {"HighEventFilterRate": "warning", "PodNotRunning": "critical"}


def test_no_events_rule_fires_on_flat_counter(spark):
    rows = [(m, al.M_RECEIVED, {}, 5.0) for m in range(0, 70)]
    out = al.alert_rules(samples(spark, rows), "1m").where(F.col("alertname") == "NoEventsReceived")
    states = {r.t: r.state for r in out.collect()}
    assert states[T0 + dt.timedelta(minutes=1)] == "pending"
    assert states[T0 + dt.timedelta(minutes=31)] == "firing"


def test_panels_rates_and_quantiles(spark):
    rows = []
    for m in range(0, 11):
        rows.append((m, al.M_RECEIVED, {}, 60 * m))           # 1 event / s
        rows.append((m, al.M_FILTERED, {}, 30 * m))
        for le, share in (("10", 0.5), ("110", 1.0), ("+Inf", 1.0)):
            rows.append((m, al.M_BATCH_SIZE + "_bucket", {"le": le}, share * 100 * m))
    p = al.panels(samples(spark, rows), "1m")
    at10 = {(r.panel, r.series): r.value for r in
            p.where(F.col("t") == T0 + dt.timedelta(minutes=10)).collect()}
    assert abs(at10[("Event Rates", "Receive Rate")] - 1.0) < 1e-9      # 4 deltas of 60, stretched to 300 s
    assert abs(at10[("Event Rates", "Process Rate")] - 0.5) < 1e-9
    assert abs(at10[("Batch Size", "Batch Size (p50)")] - 10.0) < 1e-9
    assert abs(at10[("Batch Size", "Batch Size (p95)")] - 100.0) < 1e-9   # 10 + 100 * (95-50)/50


def test_both_connections_down_fire_once_per_step(spark):
    rows = [(m, name, {}, 0) for m in range(11) for name in (al.M_SOURCE_UP, al.M_STORE_UP)]
    out = al.alert_rules(samples(spark, rows), "1m").where(F.col("alertname") == "ConnectionDown")
    states = [(r.t, r.state) for r in out.orderBy("t").collect()]
    assert len(states) == len({t for t, _ in states})
    got = dict(states)
    assert got[T0 + dt.timedelta(minutes=4)] == "pending"
    assert got[T0 + dt.timedelta(minutes=5)] == "firing"


def test_panels_join_instances_in_quantiles_and_keep_series(spark):
    rows = []
    for m in range(0, 11):
        for who, low in (("a", 1.0), ("b", 0.0)):             # a: all <= 10, b: all in (10, 110]
            for le, share in (("10", low), ("110", 1.0), ("+Inf", 1.0)):
                rows.append((m, al.M_BATCH_SIZE + "_bucket", {"le": le, "instance": who}, share * 60 * m))
            rows.append((m, al.M_RECEIVED, {"instance": who}, 60 * m))
        rows += [(m, al.M_SOURCE_UP, {"service": s, "instance": i}, v)
                 for s, i, v in (("x", "a", 0), ("x", "b", 1), ("y", "a", 0))]
    p = al.panels(samples(spark, rows), "1m").where(F.col("t") == T0 + dt.timedelta(minutes=10))
    got = {}
    for r in p.collect():
        got.setdefault((r.panel, r.series), {})[r.sk] = r.value
    assert got[("Batch Size", "Batch Size (p50)")] == {"[]": 10.0}
    assert sorted(got[("Connection Status", "Source Connection")].values()) == [0.0, 1.0]
    assert len(got[("Event Processing Rate", "Events Received")]) == 2
    assert list(got[("Event Rates", "Receive Rate")]) == ["[]"]


def test_retry_rule_sees_the_rate_to_the_windows_edges(spark):
    """1.05 retries a second, scraped every 30 s: the span of the samples alone gives
    0.945, which would never reach the rule's threshold of 1."""
    rows = [(m / 2, al.M_RETRY, {}, 1000 + 31.5 * m) for m in range(0, 60)]
    out = al.alert_rules(samples(spark, rows), "30s").where(F.col("alertname") == "HighRetryRate")
    states = {r.t: r.state for r in out.collect()}
    assert states[T0 + dt.timedelta(minutes=10)] == "pending"
    assert states[T0 + dt.timedelta(minutes=28)] == "firing"


def test_errors_durations_and_resources(spark):
    """The rules on errors, slow batches, slow inserts, CPU and memory, at rates and
    shares beyond their thresholds; other query types and containers do not count."""
    rows = []
    for m in range(0, 41):
        rows.append((m, al.M_DB_OPS, {"operation": "insert", "status": "error"}, 2 * m))
        rows.append((m, al.M_DB_OPS, {"operation": "insert", "status": "success"}, 90 * m))
        for metric, labels, low, high in (
                (al.M_BATCH_DURATION, {}, "5", "10"),
                (al.M_QUERY_DURATION, {"query_type": "insert"}, "10", "20"),
                (al.M_QUERY_DURATION, {"query_type": "select"}, "20", "40")):
            for le, share in ((low, 0.5), (high, 1.0), ("+Inf", 1.0)):     # half lie above
                rows.append((m, metric + "_bucket", {"le": le, **labels}, share * 60 * m))
        rows.append((m, "container_cpu_usage_seconds_total", {"container": "ingest"}, 54 * m))
        rows.append((m, "container_memory_working_set_bytes", {"container": "ingest"}, 900))
        for resource, limit in (("cpu", 1), ("memory", 1000)):
            rows.append((m, "kube_pod_container_resource_limits",
                         {"container": "ingest", "resource": resource}, limit))
        rows.append((m, "container_memory_working_set_bytes", {"container": "other"}, 10_000))
    got = {}
    for r in al.alert_rules(samples(spark, rows), "1m").collect():
        got.setdefault((r.alertname, r.sk), {})[r.t] = r.state
    query = '[{"key":"query_type","value":"insert"}]'
    errors = '[{"key":"operation","value":"insert"},{"key":"status","value":"error"}]'
    assert set(got) == {("DatabaseErrors", errors), ("SlowBatchProcessing", "[]"),
                        ("SlowDatabaseQueries", query), ("HighCPUUsage", "[]"), ("HighMemoryUsage", "[]")}
    for (name, _), states in got.items():
        # rates need two samples; the CPU's is 0.9 once the counter's start has left the
        # window (at minute 4 the counter has risen by 216 in 300 s)
        begin = {"HighMemoryUsage": 0, "HighCPUUsage": 5}.get(name, 1)
        assert min(states) == T0 + dt.timedelta(minutes=begin)
        assert states[T0 + dt.timedelta(minutes=begin + 14)] == "pending"
        assert states[T0 + dt.timedelta(minutes=begin + 15)] == "firing"

"""Counters of undecodable frames and alerts over repeated steps."""

import datetime as dt

from stategrid.operators import series as ts
from stategrid.operators.counters import ingest_counters


def test_received_counts_decoded_frames_with_an_id(spark):
    rows = [("event", None), ("event", "bad_frame"), ("event", "no_id"), ("event", "event_type"),
            ("result", "not_event"), (None, "bad_frame")]
    got = {r.counter: r.value for r in ingest_counters(
        spark.createDataFrame(rows, "type string, reason string")).collect()}
    assert (got["received"], got["filtered"], got["processed"]) == (2, 1, 1)
    assert got["rejected_bad_frame"] == 2


def test_repeated_steps_count_once(spark):
    t0 = dt.datetime(2024, 1, 1)
    rows = [("s", t0 + dt.timedelta(minutes=m)) for m in range(10) for _ in range(2)]
    got = ts.alert(spark.createDataFrame(rows, "sk string, t timestamp_ntz"), "5m", "1m", ["sk"])
    states = [r.state for r in got.orderBy("t").collect()]
    assert states == ["pending"] * 5 + ["firing"] * 5

"""Rule-by-rule tests of the ingest chain on literal frames."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from stategrid.functions.values import attribute
from stategrid.operators.states import split_changes
from stategrid.sources.frames import decode_frames

from frames import SAMPLE, frame, state


def run(spark, *raws):
    df = spark.createDataFrame([(r, i) for i, r in enumerate(raws)], "raw string, seq long")
    kept, rej = split_changes(decode_frames(df))
    return [r.asDict() for r in kept.orderBy("seq").collect()], \
        {r.seq: r.reason for r in rej.collect()}


def test_sample_frame(spark):
    kept, rej = run(spark, SAMPLE)
    assert rej == {}
    (r,) = kept
    assert r["domain"] == "numeric_sensor" and r["type_group"] == "double"
    assert r["entity_id"] == "sensor.boiler_return"      # S1
    assert r["state_double"] == 31.0 and r["old_state_double"] == 31.0
    assert r["last_changed"] == dt.datetime(2023, 3, 7, 5, 2, 11, 130000)
    assert r["last_updated"] == dt.datetime(2023, 3, 7, 6, 15, 42, 481000)
    assert r["last_reported"] == r["last_updated"]
    assert r["month"] == 202303
    assert json.loads(r["context"]) == {"id": "new", "parent_id": None, "user_id": None}
    a = spark.createDataFrame([(r["attributes"],)], "a string").select(
        attribute("a", "$.load", "double").alias("p"),
        attribute("a", "$.maker.name").alias("m")).first()
    assert a.p == 7.25 and a.m == "TX-40"


def test_domain_split(spark):
    df = spark.createDataFrame([("light.kitchen",), ("nodot",), (".lead",), ("a.b.c",)], "e string")
    from stategrid.functions.values import entity_domain
    got = [r[0] for r in df.select(entity_domain("e")).collect()]
    assert got == ["light", "nodot", "", "a"]


@pytest.mark.parametrize("value,domain,col,expected", [
    ("on", "binary_sensor", "state_bool", True),
    ("false", "binary_sensor", "state_bool", False),
    ("ON", "sensor", "state_text", "ON"),                 # case-sensitive
    ("1e5", "numeric_sensor", "state_double", 100000.0),
    ("-.5", "numeric_sensor", "state_double", -0.5),
    ("12 ", "sensor", "state_text", "12 "),               # blanks are not numbers
    ("idle", "sensor", "state_text", "idle"),
])
def test_sensor_reclassified_by_new_state(spark, value, domain, col, expected):   # S3, S4
    kept, _ = run(spark, frame(state("sensor.x", value), state("sensor.x", "idle")))
    assert kept[0]["domain"] == domain and kept[0][col] == expected


@pytest.mark.parametrize("value,reason", [
    ("", "skipped_state"), ("unknown", "skipped_state"), ("unavailable", "skipped_state"),
    ("Unknown", None),
])
def test_skipped_new_state(spark, value, reason):                                    # S5
    kept, rej = run(spark, frame(state("light.a", value), state("light.a", "on")))
    assert rej.get(0) == reason
    assert len(kept) == (0 if reason else 1)


def test_missing_state_field_is_skipped(spark):                                      # S12
    new = state("light.a", "x")
    del new["state"]
    _, rej = run(spark, frame(new, state("light.a", "on")))
    assert rej == {0: "skipped_state"}


def test_skipped_old_state_blank_or_false(spark):                                   # S6, S7
    kept, _ = run(spark,
                  frame(state("light.a", "on"), state("light.a", "unavailable")),
                  frame(state("switch.a", "on"), state("switch.a", "unknown")),
                  frame(state("switch.b", "off"), state("switch.b", "weird")))
    assert kept[0]["old_state_text"] == "" and kept[0]["state_text"] == "on"
    assert kept[1]["state_bool"] is True and kept[1]["old_state_bool"] is False
    assert kept[2]["state_bool"] is False and kept[2]["old_state_bool"] is False


def test_old_state_takes_new_domain_type(spark):                                     # S8
    kept, _ = run(spark, frame(state("sensor.t", "21.5"), state("sensor.t", "abc")))
    assert kept[0]["domain"] == "numeric_sensor"
    assert kept[0]["state_double"] == 21.5 and kept[0]["old_state_double"] is None


def test_first_sighting_and_removal_dropped(spark):                                  # S9
    _, rej = run(spark, frame(state("light.a", "on"), None), frame(None, state("light.a", "on")))
    assert rej == {0: "no_old_state", 1: "no_new_state"}


def test_absent_last_reported_is_epoch(spark):                                       # S10
    kept, _ = run(spark, frame(state("light.a", "on", reported=False), state("light.a", "off")))
    assert kept[0]["last_reported"] == dt.datetime(1970, 1, 1)


def test_strict_decode(spark):                                                       # S13
    num_state = json.loads(frame(state("light.a", "on"), state("light.a", "off")))
    num_state["event"]["data"]["new_state"]["state"] = 24
    bad_time = frame(state("light.a", "on", updated="2023-03-07 06:15:42"), state("light.a", "off"))
    _, rej = run(spark, json.dumps(num_state), "{not json", bad_time,
                 json.dumps({"id": 3}))
    assert rej == {0: "bad_frame", 1: "bad_frame", 2: "bad_frame", 3: "bad_frame"}


def test_frame_kinds_and_ids(spark):
    _, rej = run(spark,
                 json.dumps({"type": "mystery", "id": 1}),
                 json.dumps({"type": "result", "id": 2, "success": True, "result": []}),
                 frame(state("light.a", "on"), state("light.a", "off"), fid=0),
                 frame(state("light.a", "on"), state("light.a", "off"), fid=None),
                 frame(state("light.a", "on"), state("light.a", "off"), event_type="call_service"))
    assert rej == {0: "unknown_type", 1: "not_event", 2: "no_id", 3: "no_id", 4: "event_type"}


def test_entity_checks(spark):
    _, rej = run(spark,
                 frame(state("", "on"), state("light.a", "off")),
                 frame(state("light.a", "on"), state("light.a", "off"), data_entity=""))
    assert rej == {0: "no_entity_id", 1: "no_entity_id"}


def test_bad_domain_and_cast_failures(spark):                                        # D6, D7
    kept, rej = run(spark,
                    frame(state("Bad-Domain.x", "on"), state("Bad-Domain.x", "off")),
                    frame(state("counter.c", "idle"), state("counter.c", "1")),
                    frame(state("counter.c", "12.5"), state("counter.c", "1")),
                    frame(state("input_datetime.d", "10:11:12"), state("input_datetime.d", "x")),
                    frame(state("timer.t", "2024-01-02 03:04:05"), state("timer.t", "idle")),
                    frame(state("counter.c", "7"), state("counter.c", "")))
    assert rej == {0: "bad_domain", 1: "cast_failed", 2: "cast_failed", 3: "cast_failed"}
    assert kept[0]["state_time"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert kept[0]["old_state_time"] is None
    assert kept[1]["state_long"] == 7 and kept[1]["old_state_long"] is None


def test_unlisted_domain_is_text(spark):
    kept, _ = run(spark, frame(state("vacuum.v", "docked"), state("vacuum.v", "cleaning")))
    assert kept[0]["state_type"] == "String" and kept[0]["state_text"] == "docked"


def test_read_states_snapshot(spark):
    from stategrid.sources.frames import read_states
    ok = json.dumps({"id": 5, "type": "result", "success": True,
                     "result": [state("light.a", "on"), state("sensor.b", "3")]})
    bad = json.dumps({"id": 6, "type": "result", "success": False,
                      "error": {"code": "unauthorized", "message": "no"}})
    df = spark.createDataFrame([(ok, 0), (bad, 1)], "raw string, seq long")
    states, failures = read_states(decode_frames(df))
    assert [(r.id, r.pos, r.entity_id, r.state) for r in states.orderBy("pos").collect()] == \
        [(5, 0, "light.a", "on"), (5, 1, "sensor.b", "3")]
    assert [(r.id, r.code) for r in failures.collect()] == [(6, "unauthorized")]


def test_fill_defaults_and_destination_check(spark):
    from stategrid.operators.batching import batch_by_count
    from stategrid.operators.states import check_destination, fill_defaults, state_changes
    df = spark.createDataFrame([(frame(state("light.a", "on", reported=False), state("light.a", "off")), 0),
                                (frame(state("light.b", "on"), state("light.b", "off")), 1)],
                               "raw string, seq long")
    c = state_changes(decode_frames(df), database="home", absent_ts="null")
    assert c.where("last_reported IS NULL").count() == 1
    filled = fill_defaults(c).collect()
    assert all(r.received_at is not None for r in filled)
    assert {r.last_reported for r in filled} >= {dt.datetime(1970, 1, 1)}
    b = batch_by_count(c, "domain", ["last_updated", "seq"], 10)
    assert check_destination(b, "home").count() == 0          # one table, right database
    assert check_destination(b, "other").count() == 1


def test_event_log_lists_every_event(spark):
    from stategrid.sources.frames import event_log
    df = spark.createDataFrame([(SAMPLE, 0), (frame(None, state("light.a", "on"),
                                                    event_type="call_service"), 1)],
                               "raw string, seq long")
    rows = {r.seq: r for r in event_log(decode_frames(df)).collect()}
    assert rows[0].event_type == "state_changed" and rows[0].entity_id == "sensor.boiler"
    assert rows[1].event_type == "call_service"
    assert json.loads(rows[0].event_json)["data"]["new_state"]["state"] == "31"
    assert "\n" in rows[0].event_json                          # indented

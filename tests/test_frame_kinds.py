"""Strict kinds of a frame's fields, and the size of the code that checks them."""

import json

import pytest

from stategrid.plans.registry import QUERIES
from stategrid.sources.frames import decode_frames

STATE = {"entity_id": "light.a", "state": "on"}


def event(**data):
    return {"type": "event", "id": 1, "event": {"event_type": "state_changed", "data": {
        "entity_id": "light.a", "old_state": STATE, "new_state": STATE} | data}}


CASES = [
    (event(), True), (event(old_state=None), True), (event(old_state={}), True),
    (event(old_state="x"), False), (event(new_state=[STATE]), False), (event(new_state=7), False),
    (event(new_state=STATE | {"state": 7}), False), (event(old_state=STATE | {"state": {"a": 1}}), False),
    (event(new_state=STATE | {"state": None}), True), (event(old_state=STATE | {"entity_id": 1}), False),
    (event(entity_id=["a"]), False), (event(entity_id=None), True), (event(more=[1, {}]), True),
    (event() | {"id": "1"}, False), (event() | {"id": 1.5}, False), (event() | {"id": None}, True),
    (event() | {"event": "x"}, False), (event() | {"event": []}, False), (event() | {"event": None}, True),
    (event() | {"event": {"event_type": 3}}, False), (event() | {"event": {"data": 3}}, True),
    (event() | {"type": 3}, False), (event() | {"type": None}, False), ({}, False), ([1], False),
    ("x", False), ({"type": "result", "id": 2, "result": [1]}, True),
]


def test_kinds(spark):
    rows = [(i, json.dumps(f)) for i, (f, _) in enumerate(CASES)] + [(len(CASES), '{"type":'), (len(CASES) + 1, None)]
    got = {r.seq: r.valid for r in decode_frames(
        spark.createDataFrame(rows, "seq long, raw string")).select("seq", "valid").collect()}
    assert got == dict(enumerate([ok for _, ok in CASES] + [False, False]))


@pytest.mark.parametrize("name", ["state_changes", "state_changes_from_text"])
def test_code_of_frames_is_compiled(spark, name):
    """No part of the plan is left in a method that the JVM does not compile."""
    key = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.unset(key)
    QUERIES[name](spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get(key)) <= 8000

"""Sinks: JSON lines, type-group tables, views, idempotent batches."""

import json

import pytest
from pyspark.sql import functions as F

from stategrid.operators.states import state_changes, wire_changes
from stategrid.sinks.store import ensure_table, read_group, to_json_rows, write_changes
from stategrid.sources.frames import decode_frames

from frames import SAMPLE, frame, state


def changes(spark, raws, absent_ts="epoch"):
    df = spark.createDataFrame([(r, i) for i, r in enumerate(raws)], "raw string, seq long")
    return state_changes(decode_frames(df), absent_ts=absent_ts)


def test_json_rows_cases(spark):
    long_value = "x" * 1000
    raws = [SAMPLE,
            frame(state("light.a", "on"), state("light.a", "unknown")),
            frame(state("light.b", long_value, reported=False), state("light.b", "off")),
            frame(state("switch.s", "on", attrs={"n": None, "ok": True, "arr": [1, {"a": 2}]}),
                  state("switch.s", "off"))]
    # On the wire an absent last_reported is left out (the store fills it in).
    df = spark.createDataFrame([(r, i) for i, r in enumerate(raws)], "raw string, seq long")
    c = wire_changes(decode_frames(df)).orderBy("seq")
    rows = [json.loads(r.value) for r in to_json_rows(c).collect()]
    assert len(rows) == 4
    assert list(rows[0]) == ["entity_id", "state", "old_state", "attributes", "context",
                             "last_changed", "last_updated", "last_reported"]
    # states travel as text (but for the boolean domains), times uncut
    assert rows[0]["state"] == "31" and rows[0]["last_updated"] == "2023-03-07T06:15:42.481207Z"
    assert rows[0]["attributes"]["maker"]["name"] == "TX-40"
    assert rows[1]["old_state"] == ""                      # skipped old state blanked
    assert rows[2]["state"] == long_value and "last_reported" not in rows[2]
    assert rows[3]["state"] is True and rows[3]["old_state"] is False
    assert rows[3]["attributes"] == {"n": None, "ok": True, "arr": [1, {"a": 2}]}
    assert rows[3]["context"]["parent_id"] is None


def test_json_rows_empty(spark):
    df = spark.createDataFrame([(frame(None, None), 0)], "raw string, seq long")
    assert to_json_rows(wire_changes(decode_frames(df))).count() == 0


def test_write_groups_idempotent_and_view(spark, tmp_dir):
    raws = [SAMPLE, frame(state("light.a", "on"), state("light.a", "off")),
            frame(state("switch.s", "on"), state("switch.s", "off")),
            frame(state("counter.c", "5"), state("counter.c", "4"))]
    c = changes(spark, raws)
    root = f"{tmp_dir}/store"
    write_changes(c, root, batch_id=7)
    write_changes(c, root, batch_id=7)         # replay: replaced, not appended
    assert read_group(spark, root, "double").count() == 1
    assert read_group(spark, root, "string").count() == 1
    b = read_group(spark, root, "bool", months=[202303]).first()
    assert b.domain == "switch" and b.state is True and b.batch == 7 and b.received_at is not None
    assert dict(read_group(spark, root, "bigint").dtypes)["state"] == "bigint"
    view = ensure_table(spark, "home", "light", root)
    got = spark.sql(f"SELECT entity_id, state FROM {view}").collect()
    assert [(r.entity_id, r.state) for r in got] == [("light.a", "on")]


def test_partition_pruning_on_month(spark, tmp_dir):
    c = changes(spark, [frame(state("light.a", "on"), state("light.a", "off"))])
    root = f"{tmp_dir}/store"
    write_changes(c, root)
    df = read_group(spark, root, "string", months=[202303]).where(F.col("domain") == "light")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "month" in plan


def test_tables_before_data(spark, tmp_dir):
    root = f"{tmp_dir}/it's"
    for domain in ("light", "switch", "counter"):
        assert spark.table(ensure_table(spark, "home", domain, root)).count() == 0
    write_changes(changes(spark, [frame(state("light.a", "on"), state("light.a", "off")),
                                  frame(state("counter.c", "5"), state("counter.c", "4"))]), root)
    write_changes(changes(spark, [frame(state("light.b", "on"), state("light.b", "off"))]), root,
                  batch_id=3)
    lights = spark.table(ensure_table(spark, "home", "light", root))
    assert sorted((r.entity_id, r.month, r.batch) for r in lights.collect()) == [
        ("light.a", 202303, -1), ("light.b", 202303, 3)]
    counter = spark.table(ensure_table(spark, "home", "counter", root)).first()
    assert counter.state == 5 and counter.old_state == 4
    assert spark.table(ensure_table(spark, "home", "switch", root)).count() == 0
    assert spark.table(ensure_table(spark, "home", "light", f"{tmp_dir}/other")).count() == 0
    for database, domain in (("home", "a-b"), ("ho me", "light")):
        with pytest.raises(ValueError):
            ensure_table(spark, database, domain, root)

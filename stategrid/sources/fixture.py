"""Event frames derived from the driver's ``events`` table.

The driver tables carry no home-automation frames, so a deterministic mapping
turns each ``events`` row into one decoded frame (the shape of
``decode_frames``). One entity kind per user keeps an entity in one domain;
all arithmetic is exact so DuckDB reproduces it. The mapping:

* kind = user_id % 12; entity = prefix(kind) || '.u' || user_id
* event type: ``call_service`` for event_type = 'error', else ``state_changed``
* new state text by event_id and kind (see ``_new_raw``); event_id % 97 = 0
  removes the entity (no new state)
* old state = previous row's new state of the entity in (ts, event_id) order,
  none after a removal or for the first row
* timestamps = ts; last_reported only for even event_id; attributes = props
* frame id = event_id + 1 (id 0 means "no id")
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stategrid.plans.prefix import lag_across
from stategrid.session import session_cached

# Fixture definition: entity prefix per kind (user_id % 12).
KIND_PREFIX = ("switch", "binary_sensor", "light", "climate", "counter",
               "input_number", "input_datetime", "lock",
               "sensor", "sensor", "sensor", "sensor")


def rfc3339_text(ts) -> Column:
    """Timestamp -> RFC 3339 text with microseconds and a +00:00 offset."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


# The mapping of FIXTURE rows to entity ids and state texts, as SQL (one
# expression each, evaluated on the JVM).
_ENTITY_SQL = ("concat(element_at(array(" + ", ".join(f"'{p}'" for p in KIND_PREFIX)
               + "), CAST(user_id % 12 AS INT) + 1), '.u', CAST(user_id AS STRING))")
_NEW_RAW_SQL = """
CASE WHEN event_id % 23 = 0 THEN 'unknown'
     WHEN event_id % 29 = 0 THEN 'unavailable'
     WHEN event_id % 31 = 0 THEN ''
     ELSE CASE user_id % 12
       WHEN 0 THEN IF(value < 20, 'on', 'off')
       WHEN 1 THEN IF(value < 20, 'true', 'open')
       WHEN 2 THEN IF(value < 20, 'on', 'off')
       WHEN 3 THEN IF(value < 20, 'heat', 'cool')
       WHEN 4 THEN CAST(CAST(floor(value) AS BIGINT) AS STRING)
       WHEN 5 THEN CAST(value AS STRING)
       WHEN 6 THEN '2024-01-02 03:04:05'
       WHEN 7 THEN IF(value < 20, 'locked', 'unlocked')
       WHEN 8 THEN CAST(value AS STRING)
       WHEN 9 THEN IF(value < 20, 'on', 'false')
       WHEN 10 THEN concat('mode_', event_type)
       ELSE CASE event_id % 3 WHEN 0 THEN CAST(value AS STRING) WHEN 1 THEN 'on' ELSE 'idle' END
     END
END"""


def _state(entity: Column, raw: Column, ts_text: Column, reported: Column,
           attrs: Column, ctx: Column) -> Column:
    return F.struct(entity.alias("entity_id"), raw.alias("state"),
                    attrs.alias("attributes"), ts_text.alias("last_changed"),
                    ts_text.alias("last_updated"), reported.alias("last_reported"),
                    ctx.alias("context"))


@session_cached
def _frame_columns() -> list[Column]:
    ts_text = rfc3339_text(F.col("ts"))
    reported = F.when(F.col("event_id") % 2 == 0, ts_text)
    ctx = F.struct(F.col("event_id").cast("string").alias("id"),
                   F.lit(None).cast("string").alias("parent_id"),
                   F.lit(None).cast("string").alias("user_id"))
    entity, attrs = F.col("entity"), F.col("props")
    new_state = F.when(~F.col("removed"), _state(entity, F.col("new_raw"), ts_text,
                                                 reported, attrs, ctx))
    old_state = F.when(F.col("old_raw").isNotNull(),
                       _state(entity, F.col("old_raw"), ts_text, reported, attrs, ctx))
    event = F.struct(
        F.when(F.col("event_type") == "error", "call_service")
         .otherwise("state_changed").alias("event_type"),
        ts_text.alias("time_fired"), F.lit("LOCAL").alias("origin"), ctx.alias("context"),
        F.struct(entity.alias("entity_id"), old_state.alias("old_state"),
                 new_state.alias("new_state")).alias("data"))
    return [
        F.col("event_id").alias("seq"), F.lit(True).alias("valid"),
        F.lit("event").alias("type"), (F.col("event_id") + 1).alias("id"),
        F.lit(None).cast("boolean").alias("success"),
        F.lit(None).cast("string").alias("result"),
        F.lit(None).cast("struct<code:string,message:string>").alias("error"),
        event.alias("event")]


def event_frames(events: DataFrame) -> DataFrame:
    """``events`` -> decoded frames (schema ``stategrid.schema.FRAME``)."""
    base = events.select(
        "event_id", "ts", "user_id", "event_type", "value", "props",
        F.expr(_ENTITY_SQL).alias("entity"), F.expr(_NEW_RAW_SQL).alias("new_raw"),
        (F.col("event_id") % 97 == 0).alias("removed"))
    # Old state = previous new state of the entity; two-level so that a hot
    # entity is spread over its days.
    base = lag_across(base, ["entity"], ["ts", "event_id"],
                      F.when(~F.col("removed"), F.col("new_raw")),
                      F.date_trunc("day", F.col("ts")), "old_raw")
    return base.select(*_frame_columns())


def event_frame_text(events: DataFrame) -> DataFrame:
    """The same frames as JSON text lines (column ``raw``), for the decode path."""
    f = event_frames(events)
    return f.select(F.col("seq"), F.to_json(F.struct(
        "type", "id", F.struct(
            "event.event_type", "event.time_fired", "event.origin", "event.context",
            F.struct(
                "event.data.entity_id",
                _json_state("event.data.old_state").alias("old_state"),
                _json_state("event.data.new_state").alias("new_state")).alias("data"),
        ).alias("event"))).alias("raw"))


def damaged_frame_text(events: DataFrame) -> DataFrame:
    """``event_frame_text`` with nine of thirteen frames damaged by event_id, so
    that every reject reason occurs: cut short (1), a time that is none (2), an
    unknown type (3), another type (4), id 0 (5), no entity in the data (6), a
    domain that is no name (7), states that are no numbers (8), states that are
    no text (9)."""
    raw = F.col("raw")
    damage = {
        1: F.substring(raw, 1, 40),
        2: F.regexp_replace(raw, r'"last_updated":"[^"]*"', '"last_updated":"yesterday"'),
        3: F.regexp_replace(raw, r'^\{"type":"event"', '{"type":"surprise"'),
        4: F.regexp_replace(raw, r'^\{"type":"event"', '{"type":"auth_ok"'),
        5: F.regexp_replace(raw, r'^\{"type":"event","id":[0-9]+', '{"type":"event","id":0'),
        6: F.regexp_replace(raw, r'"data":\{"entity_id":"[^"]*"', '"data":{"entity_id":""'),
        7: F.regexp_replace(raw, r'"entity_id":"[a-z_]+\.', '"entity_id":"Bad-Domain.'),
        8: F.regexp_replace(raw, r'"state":"[^"]*"', '"state":"12x"'),
        9: F.regexp_replace(raw, r'"state":"[^"]*"', '"state":7'),
    }
    out = raw
    for k, text in damage.items():
        out = F.when(F.pmod("seq", F.lit(13)) == k, text).otherwise(out)
    return event_frame_text(events).select("seq", out.alias("raw"))


SNAPSHOT_STATES = 20


def snapshot_frame_text(events: DataFrame) -> DataFrame:
    """Result frames as JSON text (column ``raw``): a snapshot of the states of
    every ``SNAPSHOT_STATES`` events by id, of which one in seven failed."""
    ts_text = rfc3339_text(F.col("ts"))
    state = F.struct(
        "event_id", F.expr(_ENTITY_SQL).alias("entity_id"), F.expr(_NEW_RAW_SQL).alias("state"),
        F.parse_json("props").alias("attributes"), ts_text.alias("last_changed"),
        ts_text.alias("last_updated"), F.when(F.col("event_id") % 2 == 0, ts_text).alias("last_reported"),
        F.struct(F.col("event_id").cast("string").alias("id")).alias("context"))
    one = events.select(F.floor(F.col("event_id") / F.lit(SNAPSHOT_STATES)).alias("n"),
                        "event_id", F.to_json(state).alias("state"))
    frames = one.groupBy("n").agg(F.array_sort(F.collect_list(F.struct("event_id", "state"))).alias("_s"))
    head = F.concat(F.lit('{"id":'), (F.col("n") + 1).cast("string"), F.lit(',"type":"result","success":'))
    whole = F.concat(head, F.lit('true,"result":['),
                     F.concat_ws(",", F.transform("_s", lambda x: x.state)), F.lit("]}"))
    failed = F.concat(head, F.lit('false,"error":{"code":"busy_'), (F.col("n") % 3).cast("string"),
                      F.lit('","message":"snapshot '), F.col("n").cast("string"), F.lit(' refused"}}'))
    return frames.select(F.when(F.col("n") % 7 == 3, failed).otherwise(whole).alias("raw"))


def _json_state(path: str) -> Column:
    s = F.col(path)
    # attributes are JSON text in the frame; embed them as JSON, not as a string.
    return F.when(s.isNotNull(), F.struct(
        s.entity_id.alias("entity_id"), s.state.alias("state"),
        F.parse_json(s.attributes).alias("attributes"),
        s.last_changed.alias("last_changed"), s.last_updated.alias("last_updated"),
        s.last_reported.alias("last_reported"), s.context.alias("context")))

"""Event-frame sources: read, decode, select, snapshot.

A frame is one JSON text message. ``read_frames`` reads a directory of JSON
lines (static or streaming); ``decode_frames`` parses each frame once into a
VARIANT and extracts the typed fields from it, flagging frames a strict
decoder would refuse (``valid = false``) instead of dropping them, so that
rejects keep their reason.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stategrid.schema import FRAME, STATE
from stategrid.functions.values import parse_ts

# Strict RFC 3339 date-time, as a strict time decoder requires.
RFC3339 = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]+)?(Z|[+-][0-9]{2}:[0-9]{2})\z"
_INT_KINDS = ("BIGINT", "INT", "SMALLINT", "TINYINT")


def read_frames(spark: SparkSession, path: str, streaming: bool = False,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """One row per text line (column ``raw``) plus an arrival sequence.

    Static reads number lines with ``monotonically_increasing_id`` (stable for
    a given file split); streams get the sequence inside ``foreachBatch``.
    """
    if streaming:
        r = spark.readStream.format("text")
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return r.load(path).withColumnRenamed("value", "raw")
    return (spark.read.text(path).withColumnRenamed("value", "raw")
                 .withColumn("seq", F.monotonically_increasing_id()))


def _kind_in(v: Column, *kinds: str) -> Column:
    """Absent, JSON null, or a value of one of the types named."""
    return F.coalesce(F.schema_of_variant(v).isin("NULL", "VOID", *kinds), F.lit(True))


def _object_or_none(v: Column, path: str, cast: Column) -> Column:
    """Absent, JSON null or an object. ``cast``: the value as a struct, which
    only an object can be; so the value is looked up in the others alone."""
    at = F.try_variant_get(v, path, "variant")
    return cast.isNotNull() | at.isNull() | F.is_variant_null(at)


def _time_ok(t: Column) -> Column:
    return t.isNull() | t.rlike(RFC3339)


def _state_ok(s: Column) -> Column:
    return s.isNull() | (_time_ok(s.last_changed) & _time_ok(s.last_updated)
                         & _time_ok(s.last_reported))


# The fields whose JSON kind a strict decoder checks (a number is not text), cut out in one pass:
# all are text but ``id``. Objects are checked by ``_object_or_none``.
_STATE_KINDS = "struct<entity_id: variant, state: variant>"
_KINDS = ("struct<type: variant, id: variant, event: struct<event_type: variant, "
          f"data: struct<entity_id: variant, old_state: {_STATE_KINDS}, new_state: {_STATE_KINDS}>>>")


def decode_frames(df: DataFrame, col: str = "raw") -> DataFrame:
    """JSON text frames -> decoded frames (schema ``stategrid.schema.FRAME``).

    One JSON parse per frame (``try_parse_json``) and one cast of the whole
    value to the frame struct; objects where text is declared (attributes,
    result) come back as JSON text. Malformed JSON, a missing ``type``, a value
    of the wrong JSON kind, or a time that is not RFC 3339 gives
    ``valid = false`` (reason ``bad_frame``) instead of a silent NULL.
    """
    seq = F.col("seq") if "seq" in df.columns else F.monotonically_increasing_id()
    staged = df.select(seq.alias("seq"), F.try_parse_json(F.col(col)).alias("_v"))
    v = F.col("_v")
    body = ", ".join(f"{f.name}: {f.dataType.simpleString()}"
                     for f in FRAME.fields if f.name not in ("seq", "valid"))
    staged = staged.select("seq", "_v", F.try_variant_get(v, "$", _KINDS).alias("_k"),
                           F.try_variant_get(v, "$", f"struct<{body}>").alias("_f"))
    k = F.col("_k")
    kinds_ok = _kind_in(k.id, *_INT_KINDS)
    for text in (k.type, k.event.event_type, k.event.data.entity_id,
                 k.event.data.old_state.entity_id, k.event.data.old_state.state,
                 k.event.data.new_state.entity_id, k.event.data.new_state.state):
        kinds_ok = kinds_ok & _kind_in(text, "STRING")
    f = F.col("_f")
    ev = f.event
    event_ok = ev.isNull() | (_time_ok(ev.time_fired) & _state_ok(ev.data.old_state)
                              & _state_ok(ev.data.new_state))
    for path, cast in (("$.event", ev), ("$.event.data.old_state", ev.data.old_state),
                       ("$.event.data.new_state", ev.data.new_state)):
        kinds_ok = kinds_ok & _object_or_none(v, path, cast)
    valid = v.isNotNull() & kinds_ok & f.type.isNotNull() & event_ok
    return staged.select(
        "seq", F.coalesce(valid, F.lit(False)).alias("valid"),
        f.type.alias("type"), f.id.alias("id"), f.success.alias("success"),
        f.result.alias("result"), f.error.alias("error"),
        F.when(f.type == "event", ev).alias("event"))


def select_events(frames: DataFrame, event_type: str | None = None) -> DataFrame:
    """Event frames, optionally of one event type (a subscription)."""
    out = frames.where(F.col("type") == "event")
    if event_type:
        out = out.where(F.col("event.event_type") == event_type)
    return out


def require_frame_id(frames: DataFrame) -> DataFrame:
    """Drop frames whose id is absent or 0."""
    return frames.where(F.coalesce(F.col("id"), F.lit(0)) != 0)


def read_states(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """State snapshot from ``result`` frames.

    Returns ``(states, failures)``: one row per State of successful results
    (with the frame id and the position in the array), and one row per failed
    result with its error code and message.
    """
    res = frames.where((F.col("type") == "result") & F.col("valid"))
    ok = res.where(F.coalesce(F.col("success"), F.lit(False)))
    states = (ok.select("id", F.posexplode(F.from_json("result", f"array<{STATE.simpleString()}>"))
                        .alias("pos", "s"))
                .select("id", "pos", "s.*")
                .withColumn("last_changed", parse_ts("last_changed"))
                .withColumn("last_updated", parse_ts("last_updated"))
                .withColumn("last_reported", parse_ts("last_reported")))
    failures = (res.where(~F.coalesce(F.col("success"), F.lit(False)))
                   .select("id", F.col("error.code").alias("code"),
                           F.col("error.message").alias("message")))
    return states, failures


def latest_states(changes: DataFrame) -> DataFrame:
    """Latest stored state per entity ("all states" from the change log).

    Ties on ``last_updated`` go to the later frame (``batch`` of the store, if
    there, then ``seq``). Aggregated partially: each task keeps one row per
    entity before the shuffle, so a hot entity costs one row per task, not a
    skewed partition. The struct is no hash-aggregate buffer, so each task
    sorts its rows by entity first.
    """
    cols = [c for c in changes.columns if c != "entity_id"]
    best = F.max_by(F.struct(*cols), F.struct("last_updated", *[c for c in ("batch", "seq") if c in cols]))
    return changes.groupBy("entity_id").agg(best.alias("_s")).select("entity_id", "_s.*")


def event_log(frames: DataFrame) -> DataFrame:
    """Debug listing of events: type, entity and the event as indented JSON."""
    return frames.where(F.col("type") == "event").select(
        "seq", F.col("event.event_type").alias("event_type"),
        F.col("event.data.entity_id").alias("entity_id"),
        F.to_json("event", {"pretty": "true"}).alias("event_json"))

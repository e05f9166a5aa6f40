"""Decoded frames -> validated, classified, typed state changes.

One narrow projection, no shuffle: every rule is a column expression, and the
first failing rule of a row is kept as its ``reason``. Kept rows and rejects
come from the same pass (``split_changes``), no anti-join.

Output record of ``state_changes`` (one row per stored change):

* ``database``, ``domain`` (the destination table), ``state_type`` (store
  type name), ``type_group`` (bool / string / double / bigint / timestamp)
* ``entity_id`` - the *new* state's entity id
* typed state pair of the row's group, the other pairs NULL:
  ``state_bool/old_state_bool``, ``state_text/old_state_text``,
  ``state_double/old_state_double``, ``state_long/old_state_long``,
  ``state_time/old_state_time``
* ``attributes``, ``context`` (JSON text), ``last_changed``, ``last_updated``,
  ``last_reported`` (UTC, milliseconds), ``month`` (YYYYMM), ``seq``
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stategrid.functions.values import (
    blank_skipped, classify_domain, float_value, is_skipped, month_of,
    normalize_bool, parse_datetime_state, parse_int_state, parse_ts,
    state_type, type_group,
)
from stategrid.schema import DOMAIN_PATTERN, FRAME_KINDS, STATE_CHANGED
from stategrid.session import session_cached


def _epoch() -> Column:
    return F.timestamp_millis(F.lit(0))

CHANGE_COLUMNS = [
    "database", "domain", "state_type", "type_group", "entity_id",
    "state_bool", "old_state_bool", "state_text", "old_state_text",
    "state_double", "old_state_double", "state_long", "old_state_long",
    "state_time", "old_state_time",
    "attributes", "context", "last_changed", "last_updated", "last_reported",
    "month", "seq",
]


def _data() -> Column:
    return F.col("event.data")


def new_state() -> Column:
    return F.col("event.data.new_state")


def old_state() -> Column:
    return F.col("event.data.old_state")


# -- single rules (each usable alone as a filter) ------------------------------

def is_state_changed() -> Column:
    return F.coalesce(F.col("event.event_type") == STATE_CHANGED, F.lit(False))


def filter_rows(df: DataFrame, predicate: Column) -> DataFrame:
    """Generic predicate filter; rows keep their order inside a partition."""
    return df.where(predicate)


def filter_state_changed(frames: DataFrame) -> DataFrame:
    """Keep ``state_changed`` events (others are 'filtered', not errors)."""
    return frames.where((F.col("type") == "event") & is_state_changed())


def has_routing_key() -> Column:
    ns = new_state()
    return ns.isNotNull() & (F.coalesce(ns.entity_id, F.lit("")) != "")


def require_routing_key(df: DataFrame) -> DataFrame:
    """new_state present with a non-empty entity id."""
    return df.where(has_routing_key())


def require_fields(df: DataFrame) -> DataFrame:
    """data.entity_id non-empty, old_state and new_state present."""
    d = _data()
    return df.where((F.coalesce(d.entity_id, F.lit("")) != "")
                    & d.old_state.isNotNull() & d.new_state.isNotNull())


def drop_skipped_states(df: DataFrame) -> DataFrame:
    """Drop changes whose new state is empty, unknown or unavailable."""
    return df.where(~is_skipped(new_state().state))


def require_supported_event(df: DataFrame) -> DataFrame:
    return df.where(is_state_changed())


def _required_times_ok() -> Column:
    ns = new_state()
    ok = (parse_ts(ns.last_changed).isNotNull() & parse_ts(ns.last_updated).isNotNull()
          & (ns.last_reported.isNull() | parse_ts(ns.last_reported).isNotNull()))
    return ns.isNull() | ok


# -- the whole chain -----------------------------------------------------------

@session_cached
def _stage_columns():
    """(flat texts, domain / blanked old text, type group, typed values)."""
    ns, os_ = new_state(), old_state()
    flat = [ns.entity_id.alias("_ent"), ns.state.alias("_new"), os_.state.alias("_old")]
    second = {"_domain": classify_domain("_ent", "_new"), "_old_txt": blank_skipped("_old")}
    grp_col = type_group("_domain")
    grp, new_txt, old_txt = F.col("_grp"), F.col("_new"), F.col("_old_txt")
    in_g = lambda g, c: F.when(grp == g, c)
    typed = {
        "state_bool": in_g("bool", normalize_bool(new_txt)),
        "old_state_bool": in_g("bool", normalize_bool(F.col("_old"))),
        "state_text": in_g("string", new_txt),
        "old_state_text": in_g("string", old_txt),
        "state_double": in_g("double", float_value(new_txt)),
        "old_state_double": in_g("double", float_value(old_txt)),
        "state_long": in_g("bigint", parse_int_state(new_txt)),
        "old_state_long": in_g("bigint", parse_int_state(old_txt)),
        "state_time": in_g("timestamp", parse_datetime_state(new_txt)),
        "old_state_time": in_g("timestamp", parse_datetime_state(old_txt)),
    }
    return flat, second, grp_col, [c.alias(n) for n, c in typed.items()]


def _stage(frames: DataFrame) -> DataFrame:
    """Add the intermediate columns once (flat texts, domain, type group, typed
    values) so that later rules refer to columns instead of repeating the
    expression trees they come from."""
    flat, second, grp_col, typed = _stage_columns()
    s = frames.select("*", *flat).withColumns(second).withColumn("_grp", grp_col)
    return s.select("*", *typed)


TYPED_COLUMNS = [
    "state_bool", "old_state_bool", "state_text", "old_state_text",
    "state_double", "old_state_double", "state_long", "old_state_long",
    "state_time", "old_state_time",
]


@session_cached
def _reason() -> Column:
    """First rule a staged frame breaks, NULL when it is stored."""
    ns, d = new_state(), _data()
    grp = F.col("_grp")
    cast_failed = ((grp == "double") & F.col("state_double").isNull()) \
        | ((grp == "bigint") & F.col("state_long").isNull()) \
        | ((grp == "timestamp") & F.col("state_time").isNull())
    typ = F.col("type")
    rules = [
        (~F.coalesce(F.col("valid"), F.lit(False)) | typ.isNull()
         | ((typ == "event") & ~_required_times_ok()), "bad_frame"),
        (~typ.isin(*FRAME_KINDS), "unknown_type"),
        (typ != "event", "not_event"),
        (F.coalesce(F.col("id"), F.lit(0)) == 0, "no_id"),
        (~is_state_changed(), "event_type"),
        (ns.isNull(), "no_new_state"),
        ((F.coalesce(F.col("_ent"), F.lit("")) == "")
         | (F.coalesce(d.entity_id, F.lit("")) == ""), "no_entity_id"),
        (d.old_state.isNull(), "no_old_state"),
        (is_skipped(F.col("_new")), "skipped_state"),
        (~F.col("_domain").rlike(DOMAIN_PATTERN), "bad_domain"),
        (cast_failed, "cast_failed"),
    ]
    out = None
    for cond, name in rules:
        cond = F.coalesce(cond, F.lit(False))
        out = F.when(cond, F.lit(name)) if out is None else out.when(cond, F.lit(name))
    return out


def with_reason(frames: DataFrame, database: str = "home") -> DataFrame:
    """Staged frames plus ``reason`` (NULL = stored)."""
    return _stage(frames).withColumn("reason", _reason())


@session_cached
def _record(database: str, absent_ts: str) -> list[Column]:
    """Columns of the stored record over staged frames."""
    ns = new_state()
    reported = parse_ts(ns.last_reported)
    if absent_ts == "epoch":
        reported = F.coalesce(reported, _epoch())
    elif absent_ts != "null":
        raise ValueError("absent_ts must be 'epoch' or 'null'")
    updated = parse_ts(ns.last_updated)
    return [
        F.lit(database).alias("database"), F.col("_domain").alias("domain"),
        state_type("_domain").alias("state_type"), F.col("_grp").alias("type_group"),
        F.col("_ent").alias("entity_id"),
        *[F.col(c) for c in TYPED_COLUMNS],
        ns.attributes.alias("attributes"),
        F.to_json(ns.context, {"ignoreNullFields": "false"}).alias("context"),
        parse_ts(ns.last_changed).alias("last_changed"),
        updated.alias("last_updated"),
        reported.alias("last_reported"),
        month_of(updated).alias("month"),
        F.col("seq"),
    ]


def to_change(df: DataFrame, database: str = "home", absent_ts: str = "epoch") -> DataFrame:
    """Project the stored record from the new state (entity id of the new state)."""
    if "_grp" not in df.columns:
        df = _stage(df)
    return df.select(*_record(database, absent_ts))


def change_or_null(database: str = "home", absent_ts: str = "epoch") -> Column:
    """The stored record of frames that carry ``reason``, NULL of a reject."""
    return F.when(F.col("reason").isNull(), F.struct(*_record(database, absent_ts)))


def _rows_where(df: DataFrame, cond: Column, cols: list[Column]) -> DataFrame:
    """Rows of df where cond holds, projected to cols, as a generator.

    A plain ``where`` on ``reason`` would be pushed below the projection
    that computes it, so every rule would be evaluated twice (and the fused
    code outgrows the JVM method limit); predicates do not cross a
    generator, so each rule is computed once per row."""
    return df.select(F.inline(F.when(cond, F.array(F.struct(*cols)))))


def split_changes(frames: DataFrame, database: str = "home",
                  absent_ts: str = "epoch") -> tuple[DataFrame, DataFrame]:
    """(stored changes, rejects) from one reason column.

    Callers that use both should persist ``with_reason(frames)`` first (or use
    the streaming writer, which does) so that frames are decoded once.
    """
    r = with_reason(frames, database)
    kept = _rows_where(r, F.col("reason").isNull(), _record(database, absent_ts))
    rejects = _rows_where(r, F.col("reason").isNotNull(), [
        F.col("seq"), F.col("id"), F.col("type"),
        F.col("event.event_type").alias("event_type"), F.col("reason")])
    return kept, rejects


def state_changes(frames: DataFrame, database: str = "home",
                  absent_ts: str = "epoch") -> DataFrame:
    """The flagship operator: frames -> stored state changes."""
    return split_changes(frames, database, absent_ts)[0]


def wire_changes(frames: DataFrame) -> DataFrame:
    """Stored rows as they travel on the wire (``sinks.store.to_json_rows``):
    the state pair as normalised text, ``is_bool`` for the boolean domains,
    times with their whole fraction, an absent ``last_reported`` NULL."""
    ns = new_state()
    is_bool = F.col("_grp") == "bool"

    def text(bool_col: str, plain: str) -> Column:
        return F.when(is_bool, F.col(bool_col).cast("string")).otherwise(F.col(plain))

    cols = [F.col("seq"), F.col("_ent").alias("entity_id"), is_bool.alias("is_bool"),
            text("state_bool", "_new").alias("state"),
            text("old_state_bool", "_old_txt").alias("old_state"),
            ns.attributes.alias("attributes"),
            F.to_json(ns.context, {"ignoreNullFields": "false"}).alias("context"),
            *[F.try_to_timestamp(ns[c]).alias(c)
              for c in ("last_changed", "last_updated", "last_reported")]]
    return _rows_where(with_reason(frames), F.col("reason").isNull(), cols)


def rejects(frames: DataFrame, database: str = "home") -> DataFrame:
    """Frames that are not stored, with the first reason that applies."""
    return split_changes(frames, database)[1]


def normalize_state(df: DataFrame) -> DataFrame:
    """Normalised (text) new and old state: booleans for the boolean domains,
    blanked skipped old states otherwise."""
    ns, os_ = new_state(), old_state()
    domain = classify_domain(ns.entity_id, ns.state)
    is_bool = type_group(domain) == "bool"
    return df.select(
        "seq", domain.alias("domain"),
        F.when(is_bool, normalize_bool(ns.state).cast("string")).otherwise(ns.state).alias("state"),
        F.when(is_bool, normalize_bool(os_.state).cast("string"))
         .otherwise(blank_skipped(os_.state)).alias("old_state"))


def fill_defaults(changes: DataFrame, absent_ts: str = "epoch") -> DataFrame:
    """``received_at`` = now (ms); absent ``last_reported`` -> epoch or NULL."""
    out = changes.withColumn("received_at", F.date_trunc("millisecond", F.current_timestamp()))
    if absent_ts == "epoch":
        out = out.withColumn("last_reported", F.coalesce("last_reported", _epoch()))
    return out


def check_destination(batches: DataFrame, database: str, batch_cols=("domain", "batch_no")) -> DataFrame:
    """Batches that would name more than one table or another database.

    Empty result = every batch is consistent. Used as an assertion.
    """
    return (batches.groupBy(*batch_cols)
                   .agg(F.count_distinct("domain").alias("tables"),
                        F.count_if(F.col("database") != database).alias("foreign_rows"))
                   .where((F.col("tables") != 1) | (F.col("foreign_rows") > 0)))

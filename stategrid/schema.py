"""Fixed values and schemas of the event model.

Everything in the "fixed values" block must equal the source system's
constants for results to match; they are stated here once, in natural order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the source system; do not edit)
# ---------------------------------------------------------------------------

# Frame kinds.
FRAME_KINDS = ("result", "auth_required", "auth_ok", "auth_invalid", "event")

# The one event type that is stored.
STATE_CHANGED = "state_changed"

# Entity domains and the store type of their state column.
DOMAIN_TYPES = {
    "binary_sensor": "Bool",
    "switch": "Bool",
    "input_boolean": "Bool",
    "boolean_sensor": "Bool",
    "light": "LowCardinality(String)",
    "automation": "LowCardinality(String)",
    "scene": "LowCardinality(String)",
    "script": "LowCardinality(String)",
    "sun": "LowCardinality(String)",
    "device_tracker": "LowCardinality(String)",
    "person": "LowCardinality(String)",
    "zone": "LowCardinality(String)",
    "weather": "LowCardinality(String)",
    "climate": "LowCardinality(String)",
    "sensor": "String",
    "numeric_sensor": "Float64",
    "number": "Nullable(Float64)",
    "input_number": "Nullable(Float64)",
    "counter": "Int64",
    "input_datetime": "DateTime",
    "timer": "DateTime",
    "image": "DateTime",
}
DEFAULT_STORE_TYPE = "String"

# Texts a boolean domain maps to true; every other text maps to false.
TRUE_TEXTS = ("on", "true")
# Sensor states that reclassify a sensor as binary_sensor.
BOOLEAN_TEXTS = ("on", "true", "off", "false")
# New states that drop the event; old states that are blanked.
SKIPPED_STATES = ("", "unknown", "unavailable")

# Domain names allowed as table names (ours; the source pastes them unchecked).
DOMAIN_PATTERN = r"^[a-z0-9_]+$"

# Reject reasons, in the order they are tested.
REJECT_REASONS = (
    "bad_frame", "unknown_type", "not_event", "no_id", "event_type",
    "no_new_state", "no_entity_id", "no_old_state", "skipped_state",
    "bad_domain", "cast_failed",
)

# ---------------------------------------------------------------------------
# Derived: store type -> Spark type group (one output dataset per group)
# ---------------------------------------------------------------------------

STORE_TO_GROUP = {
    "Bool": "bool",
    "LowCardinality(String)": "string",
    "String": "string",
    "Float64": "double",
    "Nullable(Float64)": "double",
    "Int64": "bigint",
    "DateTime": "timestamp",
}
TYPE_GROUPS = ("bool", "string", "double", "bigint", "timestamp")
GROUP_SPARK_TYPE = {
    "bool": T.BooleanType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "timestamp": T.TimestampType(),
}


def domains_of_group(group: str) -> list[str]:
    return [d for d, t in DOMAIN_TYPES.items() if STORE_TO_GROUP[t] == group]


# ---------------------------------------------------------------------------
# Schemas
# ---------------------------------------------------------------------------

CONTEXT = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("user_id", T.StringType()),
])

# Timestamps stay text until parsed, so a bad one is a reject, not a NULL.
STATE = T.StructType([
    T.StructField("entity_id", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("attributes", T.StringType()),   # JSON text
    T.StructField("last_changed", T.StringType()),
    T.StructField("last_updated", T.StringType()),
    T.StructField("last_reported", T.StringType()),
    T.StructField("context", CONTEXT),
])

EVENT = T.StructType([
    T.StructField("event_type", T.StringType()),
    T.StructField("time_fired", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("context", CONTEXT),
    T.StructField("data", T.StructType([
        T.StructField("entity_id", T.StringType()),
        T.StructField("old_state", STATE),
        T.StructField("new_state", STATE),
    ])),
])

ERROR = T.StructType([
    T.StructField("code", T.StringType()),
    T.StructField("message", T.StringType()),
])

# Output of ``decode_frames`` (and of the driver-table fixture).
FRAME = T.StructType([
    T.StructField("seq", T.LongType()),          # arrival order
    T.StructField("valid", T.BooleanType()),     # decodes like the source would
    T.StructField("type", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("success", T.BooleanType()),
    T.StructField("result", T.StringType()),     # JSON text of the payload
    T.StructField("error", ERROR),
    T.StructField("event", EVENT),
])

# Metric samples: one row per (series, scrape time).
METRIC_SAMPLES = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("metric", T.StringType()),
    T.StructField("labels", T.MapType(T.StringType(), T.StringType())),
    T.StructField("value", T.DoubleType()),
])

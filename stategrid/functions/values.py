"""Column -> Column helpers for entity ids, state texts and timestamps.

All are built-in Spark expressions (JVM side, whole-stage codegen); none is a
Python UDF.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from stategrid.schema import (
    BOOLEAN_TEXTS, DEFAULT_STORE_TYPE, DOMAIN_TYPES, SKIPPED_STATES,
    STORE_TO_GROUP, TRUE_TEXTS,
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def entity_domain(entity_id) -> Column:
    """Text before the first '.', the whole id when there is no dot."""
    return F.substring_index(_c(entity_id), ".", 1)


# Number grammar of a strict float parser: decimal with optional exponent,
# hex mantissa with a mandatory binary exponent, '_' only between digits,
# signed inf / infinity, unsigned nan; no blanks and no type suffix.
_D = r"[0-9]+(_[0-9]+)*"
_H = r"[0-9a-fA-F]+(_[0-9a-fA-F]+)*"
FLOAT_GRAMMAR = (
    r"^("
    rf"[+-]?({_D}(\.({_D})?)?|\.{_D})([eE][+-]?{_D})?"
    rf"|[+-]?0[xX]_?({_H}(\.({_H})?)?|\.{_H})[pP][+-]?{_D}"
    r"|[+-]?(?i:inf|infinity)"
    r"|(?i:nan)"
    r")\z"
)
_INF_TEXT = r"^[+-]?(?i:inf|infinity)\z"
_INT_GRAMMAR = r"^[+-]?[0-9]+\z"


def float_value(text) -> Column:
    """The double a strict float parser gives, NULL when it refuses the text.

    Out-of-range text (e.g. ``1e400``) is refused: the cast is infinite while
    the text does not spell infinity.
    """
    t = _c(text)
    cast = F.regexp_replace(t, "_", "").try_cast("double")
    overflow = (F.abs(cast) == F.lit(float("inf"))) & ~t.rlike(_INF_TEXT)
    return F.when(t.rlike(FLOAT_GRAMMAR) & ~overflow, cast)


def is_float_text(text) -> Column:
    """True when a strict float parser accepts the text (see ``float_value``)."""
    return float_value(text).isNotNull()


def classify_domain(entity_id, state) -> Column:
    """Domain of the new state; a ``sensor`` becomes ``binary_sensor`` for
    on/true/off/false and ``numeric_sensor`` for float text."""
    dom = entity_domain(entity_id)
    s = _c(state)
    return (F.when((dom == "sensor") & s.isin(*BOOLEAN_TEXTS), F.lit("binary_sensor"))
             .when((dom == "sensor") & is_float_text(s), F.lit("numeric_sensor"))
             .otherwise(dom))


def _sql_str(v: str) -> str:
    return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _case_of(mapping: dict, default: str):
    """``CASE <arg> WHEN k THEN v ... ELSE default END`` over one argument,
    built as one SQL expression (one JVM call instead of one per literal)."""
    arms = " ".join(f"WHEN {_sql_str(k)} THEN {_sql_str(v)}" for k, v in mapping.items())

    def apply(arg) -> Column:
        if isinstance(arg, str) and re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", arg):
            return F.expr(f"CASE `{arg}` {arms} ELSE {_sql_str(default)} END")
        # A Column: compare it against each key (one call per literal).
        c = _c(arg)
        return F.coalesce(*[F.when(c == F.lit(k), F.lit(v)) for k, v in mapping.items()],
                          F.lit(default))
    return apply


_STATE_TYPE = _case_of(DOMAIN_TYPES, DEFAULT_STORE_TYPE)
_TYPE_GROUP = _case_of({d: STORE_TO_GROUP[t] for d, t in DOMAIN_TYPES.items()},
                       STORE_TO_GROUP[DEFAULT_STORE_TYPE])


def state_type(domain) -> Column:
    """Store type name of a domain's state column; unlisted -> String."""
    return _STATE_TYPE(domain)


def type_group(domain) -> Column:
    """Spark type group of a domain: bool, string, double, bigint, timestamp."""
    return _TYPE_GROUP(domain)


def normalize_bool(state) -> Column:
    """on/true -> true; anything else, NULL included -> false."""
    return F.coalesce(_c(state).isin(*TRUE_TEXTS), F.lit(False))


def is_skipped(state) -> Column:
    """Missing, empty, unknown or unavailable (case-sensitive)."""
    return F.coalesce(_c(state), F.lit("")).isin(*SKIPPED_STATES)


def blank_skipped(state) -> Column:
    """Skipped old states become ''."""
    return F.when(is_skipped(state), F.lit("")).otherwise(_c(state))


def parse_ts(text) -> Column:
    """RFC 3339 text -> UTC timestamp cut to milliseconds; NULL if unparsable."""
    return F.date_trunc("millisecond", F.try_to_timestamp(_c(text)))


def parse_datetime_state(text) -> Column:
    """A date-time *state* -> timestamp cut to seconds.

    Text must start with a calendar date; time-only text would otherwise be
    read as today's date and is refused.
    """
    t = _c(text)
    return F.when(t.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"),
                  F.date_trunc("second", F.try_to_timestamp(t)))


def parse_int_state(text) -> Column:
    """Integer text -> bigint (no blanks, no fraction); NULL otherwise."""
    t = _c(text)
    return F.when(t.rlike(_INT_GRAMMAR), t.try_cast("bigint"))


def format_rfc3339(ts) -> Column:
    """Timestamp -> RFC 3339 text with fractional zeros trimmed and 'Z' for UTC."""
    full = F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    trimmed = F.regexp_replace(F.regexp_replace(full, "0+$", ""), r"\.$", "")
    return F.concat(trimmed, F.lit("Z"))


def month_of(ts) -> Column:
    """YYYYMM of a UTC timestamp, as int (the partition value)."""
    return (F.year(_c(ts)) * 100 + F.month(_c(ts))).cast("int")


def attribute(json_text, path: str, type_: str = "string") -> Column:
    """Typed value at a JSON path of an attributes / context text column."""
    return F.try_variant_get(F.try_parse_json(_c(json_text)), path, type_)


def read_loose_json(c: Column, schema: str) -> Column:
    """JSON objects read leniently by ``schema`` (DDL): fields it lacks are
    skipped; bools, numbers, arrays and objects read into string fields are
    their JSON text; a value that does not fit its field is NULL there alone.
    Text that is no JSON object is NULL."""
    parsed = F.from_json(c, schema, {"mode": "PERMISSIVE"})
    return F.when(F.try_parse_json(c).isNotNull() & F.ltrim(c).startswith("{"), parsed)

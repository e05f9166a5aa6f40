"""DuckDB SQL for each registered query (the correctness oracle).

The SQL restates the fixture mapping and every rule independently of the Spark
code; only fixed values (domain lists, the number grammar) are shared.
"""

from __future__ import annotations

from stategrid.functions.values import FLOAT_GRAMMAR
from stategrid.schema import DOMAIN_TYPES, STORE_TO_GROUP
from stategrid.sources.fixture import KIND_PREFIX

ORACLE: dict[str, str] = {}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


_PREFIX_CASE = "CASE user_id % 12 " + " ".join(
    f"WHEN {i} THEN {_q(p)}" for i, p in enumerate(KIND_PREFIX)) + " END"

_GROUP_CASE = "CASE " + " ".join(
    f"WHEN {{d}} IN {_in([d for d, t in DOMAIN_TYPES.items() if STORE_TO_GROUP[t] == g])} THEN {_q(g)}"
    for g in ("bool", "double", "bigint", "timestamp")) + " ELSE 'string' END"

_TYPE_CASE = "CASE {d} " + " ".join(
    f"WHEN {_q(d)} THEN {_q(t)}" for d, t in DOMAIN_TYPES.items()) + " ELSE 'String' END"


def group_of(d: str) -> str:
    return _GROUP_CASE.replace("{d}", d)


def float_of(t: str) -> str:
    """Strict float value of text t, NULL when refused."""
    cast = f"TRY_CAST(replace({t}, '_', '') AS DOUBLE)"
    return (f"CASE WHEN regexp_matches({t}, {_q(FLOAT_GRAMMAR)}) AND NOT (isinf({cast}) AND NOT "
            f"regexp_matches({t}, '^[+-]?(?i:inf|infinity)\\z')) THEN {cast} END")


def int_of(t: str) -> str:
    return f"CASE WHEN regexp_matches({t}, '^[+-]?[0-9]+\\z') THEN TRY_CAST({t} AS BIGINT) END"


def ts_state_of(t: str) -> str:
    return (f"CASE WHEN regexp_matches({t}, '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') "
            f"THEN date_trunc('second', TRY_CAST({t} AS TIMESTAMP)) END")


def blank(t: str) -> str:
    return f"CASE WHEN coalesce({t}, '') IN ('', 'unknown', 'unavailable') THEN '' ELSE {t} END"


# Frames from events, then the validation chain; one row per event.
FRAMES = f"""
base AS (
  SELECT event_id, ts, user_id, event_type, value, props,
    {_PREFIX_CASE} || '.u' || CAST(user_id AS VARCHAR) AS entity,
    CASE WHEN event_id % 23 = 0 THEN 'unknown'
         WHEN event_id % 29 = 0 THEN 'unavailable'
         WHEN event_id % 31 = 0 THEN ''
         ELSE CASE
           WHEN user_id % 12 IN (0, 2) THEN CASE WHEN value < 20 THEN 'on' ELSE 'off' END
           WHEN user_id % 12 = 1 THEN CASE WHEN value < 20 THEN 'true' ELSE 'open' END
           WHEN user_id % 12 = 3 THEN CASE WHEN value < 20 THEN 'heat' ELSE 'cool' END
           WHEN user_id % 12 = 4 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
           WHEN user_id % 12 IN (5, 8) THEN CAST(value AS VARCHAR)
           WHEN user_id % 12 = 6 THEN '2024-01-02 03:04:05'
           WHEN user_id % 12 = 7 THEN CASE WHEN value < 20 THEN 'locked' ELSE 'unlocked' END
           WHEN user_id % 12 = 9 THEN CASE WHEN value < 20 THEN 'on' ELSE 'false' END
           WHEN user_id % 12 = 10 THEN 'mode_' || event_type
           ELSE CASE WHEN event_id % 3 = 0 THEN CAST(value AS VARCHAR)
                     WHEN event_id % 3 = 1 THEN 'on' ELSE 'idle' END
         END END AS new_raw,
    event_id % 97 = 0 AS removed,
    CASE WHEN event_type = 'error' THEN 'call_service' ELSE 'state_changed' END AS ha_type
  FROM events),
fr AS (
  SELECT *, lag(CASE WHEN NOT removed THEN new_raw END)
              OVER (PARTITION BY entity ORDER BY ts, event_id) AS old_raw
  FROM base),
cl AS (
  SELECT *,
    CASE WHEN split_part(entity, '.', 1) = 'sensor' AND new_raw IN ('on', 'true', 'off', 'false')
           THEN 'binary_sensor'
         WHEN split_part(entity, '.', 1) = 'sensor' AND {float_of('new_raw')} IS NOT NULL
           THEN 'numeric_sensor'
         ELSE split_part(entity, '.', 1) END AS domain
  FROM fr),
ty AS (
  SELECT *, {group_of('domain')} AS grp,
    {blank('old_raw')} AS old_txt
  FROM cl),
rs AS (
  SELECT *, CASE
    WHEN ha_type <> 'state_changed' THEN 'event_type'
    WHEN removed THEN 'no_new_state'
    WHEN old_raw IS NULL THEN 'no_old_state'
    WHEN coalesce(new_raw, '') IN ('', 'unknown', 'unavailable') THEN 'skipped_state'
    WHEN NOT regexp_matches(domain, '^[a-z0-9_]+$') THEN 'bad_domain'
    WHEN grp = 'double' AND {float_of('new_raw')} IS NULL THEN 'cast_failed'
    WHEN grp = 'bigint' AND {int_of('new_raw')} IS NULL THEN 'cast_failed'
    WHEN grp = 'timestamp' AND {ts_state_of('new_raw')} IS NULL THEN 'cast_failed'
  END AS reason
  FROM ty),
chg AS (
  SELECT domain, {_TYPE_CASE.replace('{d}', 'domain')} AS state_type, grp AS type_group,
    entity AS entity_id,
    CASE WHEN grp = 'bool' THEN coalesce(new_raw IN ('on', 'true'), false) END AS state_bool,
    CASE WHEN grp = 'bool' THEN coalesce(old_raw IN ('on', 'true'), false) END AS old_state_bool,
    CASE WHEN grp = 'string' THEN new_raw END AS state_text,
    CASE WHEN grp = 'string' THEN old_txt END AS old_state_text,
    CASE WHEN grp = 'double' THEN {float_of('new_raw')} END AS state_double,
    CASE WHEN grp = 'double' THEN {float_of('old_txt')} END AS old_state_double,
    CASE WHEN grp = 'bigint' THEN {int_of('new_raw')} END AS state_long,
    CASE WHEN grp = 'bigint' THEN {int_of('old_txt')} END AS old_state_long,
    CASE WHEN grp = 'timestamp' THEN {ts_state_of('new_raw')} END AS state_time,
    CASE WHEN grp = 'timestamp' THEN {ts_state_of('old_txt')} END AS old_state_time,
    props AS attributes,
    CAST(json_object('id', CAST(event_id AS VARCHAR), 'parent_id', NULL, 'user_id', NULL) AS VARCHAR)
      AS context,
    date_trunc('millisecond', ts) AS last_changed,
    date_trunc('millisecond', ts) AS last_updated,
    CASE WHEN event_id % 2 = 0 THEN date_trunc('millisecond', ts)
         ELSE TIMESTAMP '1970-01-01 00:00:00' END AS last_reported,
    CAST(year(ts) * 100 + month(ts) AS INTEGER) AS month,
    event_id AS seq
  FROM rs WHERE reason IS NULL)
"""


def with_frames(body: str) -> str:
    return "WITH " + FRAMES.strip() + "\n" + body


ORACLE["state_changes"] = with_frames("SELECT * FROM chg")
# Through JSON text, attributes come back minified (compared by value).
ORACLE["state_changes_from_text"] = with_frames(
    "SELECT * REPLACE (CAST(json(attributes) AS VARCHAR) AS attributes) FROM chg")
ORACLE["rejects"] = with_frames("SELECT event_id AS seq, reason FROM rs WHERE reason IS NOT NULL")
# Each damage of the fixture, with the rules that come before the one it breaks.
ORACLE["rejects_all_reasons"] = with_frames("""
, dm AS (SELECT event_id AS seq, CASE event_id % 13
    WHEN 1 THEN 'bad_frame'
    WHEN 2 THEN CASE WHEN removed AND old_raw IS NULL THEN reason ELSE 'bad_frame' END
    WHEN 9 THEN CASE WHEN removed AND old_raw IS NULL THEN reason ELSE 'bad_frame' END
    WHEN 3 THEN 'unknown_type' WHEN 4 THEN 'not_event' WHEN 5 THEN 'no_id'
    WHEN 6 THEN CASE WHEN reason IN ('event_type', 'no_new_state') THEN reason ELSE 'no_entity_id' END
    WHEN 7 THEN CASE WHEN reason IN ('event_type', 'no_new_state', 'no_old_state', 'skipped_state')
                     THEN reason ELSE 'bad_domain' END
    WHEN 8 THEN CASE WHEN reason IN ('event_type', 'no_new_state', 'no_old_state') THEN reason
                     WHEN split_part(entity, '.', 1) IN ('counter', 'input_number', 'input_datetime')
                     THEN 'cast_failed' END
    ELSE reason END AS reason FROM rs)
SELECT seq, reason FROM dm WHERE reason IS NOT NULL""".replace("\n, dm", ", dm", 1))
ORACLE["read_states"] = with_frames("""
, sn AS (SELECT *, event_id // 20 AS n FROM base)
SELECT n + 1 AS id, CAST(row_number() OVER (PARTITION BY n ORDER BY event_id) - 1 AS INTEGER) AS pos,
  entity AS entity_id, new_raw AS state, CAST(json(props) AS VARCHAR) AS attributes,
  date_trunc('millisecond', ts) AS last_updated,
  CASE WHEN event_id % 2 = 0 THEN date_trunc('millisecond', ts) END AS last_reported,
  CAST(NULL AS VARCHAR) AS code, CAST(NULL AS VARCHAR) AS message
FROM sn WHERE n % 7 <> 3
UNION ALL
SELECT DISTINCT n + 1, NULL, NULL, NULL, NULL, NULL, NULL, 'busy_' || (n % 3),
  'snapshot ' || n || ' refused' FROM sn WHERE n % 7 = 3""".replace("\n, sn", ", sn", 1))
ORACLE["require_supported_event"] = with_frames(
    "SELECT event_id AS seq, event_id + 1 AS id FROM rs WHERE ha_type = 'state_changed'")
ORACLE["fill_defaults"] = with_frames("SELECT seq, last_reported, true AS received FROM chg")
ORACLE["split_by_key"] = with_frames(
    "SELECT event_id AS seq, CASE WHEN NOT removed THEN split_part(entity, '.', 1) END AS key, "
    "CASE WHEN removed THEN 'no_key' END AS reason FROM rs")
ORACLE["select_events"] = with_frames(
    "SELECT event_id AS seq, event_id + 1 AS id, entity AS entity_id FROM rs "
    "WHERE ha_type = 'state_changed'")
ORACLE["filter_state_changed"] = with_frames(
    "SELECT event_id AS seq, ha_type AS event_type FROM rs WHERE ha_type = 'state_changed'")
ORACLE["filter_rows"] = with_frames(
    "SELECT event_id AS seq, entity AS entity_id FROM rs "
    "WHERE split_part(entity, '.', 1) IN ('light', 'switch', 'lock')")
ORACLE["drop_skipped"] = with_frames(
    "SELECT event_id AS seq, new_raw AS state FROM rs "
    "WHERE NOT removed AND coalesce(new_raw, '') NOT IN ('', 'unknown', 'unavailable')")
ORACLE["entity_domain"] = with_frames(
    "SELECT event_id AS seq, entity AS entity_id, split_part(entity, '.', 1) AS domain "
    "FROM rs WHERE NOT removed")
ORACLE["is_float_text"] = with_frames(
    f"SELECT event_id AS seq, new_raw AS state, {float_of('new_raw')} IS NOT NULL AS is_float "
    "FROM rs WHERE NOT removed")
ORACLE["classify_domain"] = with_frames(
    "SELECT event_id AS seq, domain FROM rs WHERE NOT removed")
ORACLE["state_type"] = with_frames(
    f"SELECT domain, {_TYPE_CASE.replace('{d}', 'domain')} AS state_type, count(*) AS rows "
    "FROM rs WHERE NOT removed GROUP BY domain")
ORACLE["normalize_bool"] = with_frames(
    "SELECT event_id AS seq, coalesce(new_raw IN ('on', 'true'), false) AS state_bool "
    "FROM rs WHERE NOT removed")
ORACLE["normalize_state"] = with_frames(
    "SELECT event_id AS seq, domain, "
    "CASE WHEN grp = 'bool' THEN CAST(coalesce(new_raw IN ('on', 'true'), false) AS VARCHAR) "
    "     ELSE new_raw END AS state, "
    "CASE WHEN grp = 'bool' THEN CAST(coalesce(old_raw IN ('on', 'true'), false) AS VARCHAR) "
    "     ELSE old_txt END AS old_state "
    "FROM rs WHERE NOT removed AND old_raw IS NOT NULL")
ORACLE["to_change"] = with_frames(
    "SELECT event_id AS seq, entity AS entity_id, props AS attributes, "
    "CAST(json_object('id', CAST(event_id AS VARCHAR), 'parent_id', NULL, 'user_id', NULL) AS VARCHAR)"
    " AS context, date_trunc('millisecond', ts) AS last_changed, "
    "date_trunc('millisecond', ts) AS last_updated, "
    "CASE WHEN event_id % 2 = 0 THEN date_trunc('millisecond', ts) "
    "     ELSE TIMESTAMP '1970-01-01 00:00:00' END AS last_reported "
    "FROM rs WHERE NOT removed AND old_raw IS NOT NULL")
ORACLE["format_rfc3339"] = with_frames(
    "SELECT seq, regexp_replace(regexp_replace(strftime(last_updated, '%Y-%m-%dT%H:%M:%S.%f'), "
    "'0+$', ''), '\\.$', '') || 'Z' AS text FROM chg")
ORACLE["parse_ts"] = with_frames(
    "SELECT event_id AS seq, date_trunc('millisecond', ts) AS last_updated FROM rs WHERE NOT removed")
ORACLE["cast_state_double"] = with_frames(
    "SELECT seq, domain, state_double, old_state_double FROM chg WHERE type_group = 'double'")
ORACLE["cast_state_bigint"] = with_frames(
    "SELECT seq, domain, state_long, old_state_long FROM chg WHERE type_group = 'bigint'")
ORACLE["cast_state_ts"] = with_frames(
    "SELECT seq, domain, state_time, old_state_time FROM chg WHERE type_group = 'timestamp'")
ORACLE["cast_state_bool"] = with_frames(
    "SELECT seq, domain, state_bool, old_state_bool FROM chg WHERE type_group = 'bool'")
ORACLE["attribute"] = (
    "SELECT event_id AS seq, TRY_CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
ORACLE["month_partition"] = with_frames(
    "SELECT domain, month, count(*) AS rows FROM chg GROUP BY domain, month")
ORACLE["latest_states"] = with_frames(
    "SELECT entity_id, domain, state_bool, state_text, state_double, state_long, state_time, "
    "last_updated, seq FROM chg QUALIFY row_number() OVER "
    "(PARTITION BY entity_id ORDER BY last_updated DESC, seq DESC) = 1")


# -- counters and time series ---------------------------------------------------------
H = 3600
W6 = 6 * H


def _step(ts: str = "ts", s: int = H) -> str:
    return f"(((epoch_us({ts}) + {s * 1000000 - 1}) // {s * 1000000}) * {s})"


def _tstamp(sec: str) -> str:
    return f"make_timestamp(({sec}) * 1000000)"


# Events per (event_type, step bucket) and the 6 h slide.
RATE_CTE = f"""
b AS (SELECT event_type, {_step()} AS tb, count(*) AS n FROM events GROUP BY ALL),
sl AS (SELECT event_type, tb + k * {H} AS t_sec, sum(n) AS n
       FROM b, range(0, 6) r(k) GROUP BY ALL)
"""

ORACLE["rate_events"] = "WITH " + RATE_CTE.strip() + f"""
SELECT event_type, {_tstamp('t_sec')} AS t, n / {float(W6)} AS value FROM sl"""

SAMPLES_CTE = f"""
b AS (SELECT event_type, {_step()} AS t_sec, count(*) AS n FROM events GROUP BY ALL),
b2 AS (SELECT *, CAST(floor((t_sec - 1) / 86400) AS BIGINT) AS ep FROM b),
span AS (SELECT event_type, ep, unnest(range(lo, hi + {H}, {H})) AS t_sec
         FROM (SELECT event_type, ep, min(t_sec) AS lo, max(t_sec) AS hi FROM b2 GROUP BY ALL)),
dense AS (SELECT s.event_type, s.ep, s.t_sec, coalesce(b2.n, 0) AS n
          FROM span s LEFT JOIN b2 USING (event_type, ep, t_sec)),
samp AS (SELECT event_type, t_sec, CAST(sum(n) OVER (PARTITION BY event_type, ep ORDER BY t_sec
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS value FROM dense),
pairs AS (SELECT event_type, t_sec AS cur, lag(t_sec) OVER w AS prev,
            CASE WHEN value >= lag(value) OVER w THEN value - lag(value) OVER w ELSE value END AS d
          FROM samp WINDOW w AS (PARTITION BY event_type ORDER BY t_sec)),
cand AS (SELECT DISTINCT event_type, cur + k * {H} AS t FROM pairs, range(0, 7) r(k)
         WHERE prev IS NOT NULL),
inc AS (SELECT c.event_type, c.t, sum(p.d) AS value FROM cand c JOIN pairs p
          ON p.event_type = c.event_type AND p.prev IS NOT NULL
         AND p.prev > c.t - {W6} AND p.cur <= c.t GROUP BY ALL)
"""

ORACLE["counter_samples"] = "WITH " + SAMPLES_CTE.strip() + f"""
SELECT event_type, {_tstamp('t_sec')} AS t, value FROM samp"""
ORACLE["increase"] = "WITH " + SAMPLES_CTE.strip() + f"""
SELECT event_type, {_tstamp('t')} AS t, value FROM inc"""
ORACLE["rate_samples"] = "WITH " + SAMPLES_CTE.strip() + f"""
SELECT event_type, {_tstamp('t')} AS t, value / {float(W6)} AS value FROM inc"""
ORACLE["sum_by"] = "WITH " + SAMPLES_CTE.strip() + f"""
SELECT {_tstamp('t_sec')} AS t, sum(value) AS value FROM samp GROUP BY t_sec"""
ORACLE["max_by_label"] = "WITH " + SAMPLES_CTE.strip() + f"""
SELECT 'events_total' AS metric, {_tstamp('t_sec')} AS t, max(value) AS value FROM samp GROUP BY t_sec"""
ORACLE["select_series"] = "WITH " + SAMPLES_CTE.strip() + f"""
SELECT {_tstamp('t_sec')} AS t, value FROM samp WHERE event_type = 'click'"""



def _stretched(key: str, samp: str, window: int, step: int, p: str = "") -> str:
    """CTEs whose last, ``{p}ex``, holds per step the increase ``x`` of the samples
    (key, us, value): the samples of its window by a plain join, resets by each
    sample's predecessor in the same window, then the stretch to the edges."""
    w, s = window * 1_000_000, step * 1_000_000
    return f"""
{p}sm AS (SELECT {key}, us, max(value) AS v FROM ({samp}) WHERE value IS NOT NULL GROUP BY ALL),
{p}pv AS (SELECT *, lag(us) OVER w AS pus, lag(v) OVER w AS pvl FROM {p}sm
       WINDOW w AS (PARTITION BY {key} ORDER BY us)),
{p}st AS (SELECT {key}, us, v, pus, pvl, (((us + {s - 1}) // {s}) + k) * {s} AS t
       FROM {p}pv, range(0, {window // step}) r(k)),
{p}wn AS (SELECT {key}, t, count(*) AS n, min(us) AS f_us, max(us) AS l_us,
         arg_min(v, us) AS f_v, arg_max(v, us) AS l_v,
         coalesce(sum(pvl) FILTER (WHERE pus > t - {w} AND v < pvl), 0.0) AS lost
       FROM {p}st WHERE us > t - {w} GROUP BY ALL HAVING count(*) > 1),
{p}ic AS (SELECT *, l_v - f_v + lost AS inc, CAST(l_us - f_us AS DOUBLE) AS span,
         (l_us - f_us) / (n - 1) AS gap,
         CAST(f_us - (t - {w}) AS DOUBLE) AS at_start, CAST(t - l_us AS DOUBLE) AS at_end
       FROM {p}wn),
{p}ed AS (SELECT *, CASE WHEN at_start >= gap * CAST(1.1 AS DOUBLE) THEN gap / 2 ELSE at_start END AS s0,
         CASE WHEN at_end >= gap * CAST(1.1 AS DOUBLE) THEN gap / 2 ELSE at_end END AS e0 FROM {p}ic),
{p}ex AS (SELECT {key}, t, inc * ((span + CASE WHEN inc > 0 AND f_v >= 0 AND span * (f_v / inc) < s0
                      THEN span * (f_v / inc) ELSE s0 END + e0) / span) AS x FROM {p}ed)"""


ORACLE["rate_extrapolated"] = "WITH " + SAMPLES_CTE.strip() + "," + _stretched(
    "event_type", "SELECT event_type, t_sec * 1000000 AS us, value FROM samp", W6, H) + f"""
SELECT event_type, make_timestamp(t) AS t, x / {float(W6)} AS value FROM ex"""
ORACLE["increase_extrapolated"] = "WITH " + _stretched(
    "event_type", "SELECT event_type, epoch_us(ts) AS us, floor(value) AS value FROM events",
    W6, H).strip() + """
SELECT event_type, make_timestamp(t) AS t, x AS value FROM ex"""

_BOUNDS = [10.0 + 100.0 * i for i in range(10)]


def _hist_sql(by: str) -> str:
    sel = f"{by}, " if by else ""
    grp = f"GROUP BY {by}" if by else ""
    cols = ", ".join(f"count(*) FILTER (WHERE value <= {b}) AS b{i}" for i, b in enumerate(_BOUNDS))
    arms = " UNION ALL ".join(
        f"SELECT {sel}{b} AS le, b{i} AS bucket, sum, count FROM a" for i, b in enumerate(_BOUNDS))
    return (f"WITH a AS (SELECT {sel}{cols}, count(value) AS count, sum(value) AS sum FROM events {grp}) "
            f"{arms} UNION ALL SELECT {sel}'inf'::DOUBLE AS le, count AS bucket, sum, count FROM a")


ORACLE["histogram"] = _hist_sql("")
ORACLE["histogram_by"] = _hist_sql("event_type")


def _quantile_sql(q: float) -> str:
    idx = "CASE " + " ".join(f"WHEN value <= {b} THEN {i}" for i, b in enumerate(_BOUNDS)) + \
          f" ELSE {len(_BOUNDS)} END"
    le = "CASE " + " ".join(f"WHEN j = {i} THEN {b}" for i, b in enumerate(_BOUNDS)) + \
         " ELSE 'inf'::DOUBLE END"
    return f"""
SELECT * FROM (
WITH e AS (SELECT {_step()} AS tb, {idx} AS i FROM events),
bk AS (SELECT tb, i, count(*) AS n FROM e GROUP BY ALL),
sl AS (SELECT tb + k * {H} AS t_sec, i, sum(n) AS n FROM bk, range(0, 6) r(k) GROUP BY ALL),
steps AS (SELECT DISTINCT t_sec FROM sl),
grid AS (SELECT t_sec, j FROM steps, range(0, {len(_BOUNDS) + 1}) r(j)),
cum AS (SELECT g.t_sec, g.j, coalesce(sum(sl.n), 0) AS c FROM grid g
        LEFT JOIN sl ON sl.t_sec = g.t_sec AND sl.i <= g.j GROUP BY ALL),
h AS (SELECT t_sec, {le} AS le, c / {float(W6)} AS c FROM cum),
h2 AS (SELECT *, lag(le) OVER w AS ple, coalesce(lag(c) OVER w, 0.0) AS pc,
         max(CASE WHEN le = 'inf'::DOUBLE THEN c END) OVER (PARTITION BY t_sec) AS total
       FROM h WINDOW w AS (PARTITION BY t_sec ORDER BY le)),
hit AS (SELECT *, row_number() OVER (PARTITION BY t_sec ORDER BY le) AS rn FROM h2
        WHERE c >= {q} * total AND total > 0)
SELECT {_tstamp('t_sec')} AS t,
  CASE WHEN le = 'inf'::DOUBLE THEN {_BOUNDS[-1]}
       WHEN ple IS NULL AND le <= 0 THEN le
       ELSE coalesce(ple, CASE WHEN le > 0 THEN 0.0 ELSE le END)
            + (le - coalesce(ple, CASE WHEN le > 0 THEN 0.0 ELSE le END))
            * CASE WHEN c - pc > 0 THEN ({q} * total - pc) / (c - pc) ELSE 0.0 END END AS value,
  CAST({q} AS DOUBLE) AS q
FROM hit WHERE rn = 1)"""


ORACLE["bucket_quantile"] = _quantile_sql(0.95) + " UNION ALL " + _quantile_sql(0.5)

_ALL_ERR = f"""
a AS (SELECT tb + k * {H} AS t_sec, sum(n) AS n FROM
        (SELECT {_step()} AS tb, count(*) AS n FROM events GROUP BY ALL), range(0, 6) r(k) GROUP BY ALL),
e AS (SELECT tb + k * {H} AS t_sec, sum(n) AS n FROM
        (SELECT {_step()} AS tb, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY ALL),
        range(0, 6) r(k) GROUP BY ALL),
ar AS (SELECT t_sec, n / {float(W6)} AS v FROM a),
er AS (SELECT t_sec, n / {float(W6)} AS v FROM e)
"""

ORACLE["vector_ratio"] = "WITH " + _ALL_ERR.strip() + f"""
SELECT {_tstamp('t_sec')} AS t, CASE WHEN ar.v <> 0 THEN er.v / ar.v END AS value
FROM er JOIN ar USING (t_sec)"""
ORACLE["vector_diff"] = "WITH " + _ALL_ERR.strip() + f"""
SELECT {_tstamp('t_sec')} AS t, ar.v - er.v AS value FROM ar JOIN er USING (t_sec)"""
ORACLE["band"] = "WITH " + _ALL_ERR.strip() + f""",
ok AS (SELECT t_sec, ar.v - er.v AS v FROM ar JOIN er USING (t_sec)),
sh AS (SELECT t_sec, CASE WHEN ar.v <> 0 THEN ok.v / ar.v END AS value FROM ok JOIN ar USING (t_sec))
SELECT {_tstamp('t_sec')} AS t, value,
  CASE WHEN value < 0.5 THEN 'red' WHEN value < 0.8 THEN 'yellow' ELSE 'green' END AS band FROM sh"""

ORACLE["vector_or"] = "WITH " + RATE_CTE.strip() + f""",
a AS (SELECT event_type, t_sec, n / {float(W6)} AS value FROM sl WHERE event_type IN ('click', 'view')),
bb AS (SELECT event_type, t_sec, CAST(n AS DOUBLE) AS value FROM sl)
SELECT event_type, {_tstamp('t_sec')} AS t, value FROM a
UNION ALL
SELECT event_type, {_tstamp('t_sec')} AS t, value FROM bb
WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.event_type = bb.event_type AND a.t_sec = bb.t_sec)"""

_LIMIT = 3 / 3600
ORACLE["compare"] = "WITH " + RATE_CTE.strip() + f"""
SELECT event_type, {_tstamp('t_sec')} AS t, n / {float(W6)} AS value FROM sl
WHERE n / {float(W6)} > {_LIMIT!r}"""
ORACLE["alert"] = "WITH " + RATE_CTE.strip() + f""",
c AS (SELECT event_type, t_sec FROM sl WHERE n / {float(W6)} > {_LIMIT!r}),
i AS (SELECT *, t_sec // {H} - row_number() OVER (PARTITION BY event_type ORDER BY t_sec) AS isl
      FROM c),
j AS (SELECT *, min(t_sec) OVER (PARTITION BY event_type, isl) AS since FROM i)
SELECT event_type, {_tstamp('t_sec')} AS t,
  CASE WHEN t_sec - since >= {3 * H} THEN 'firing' ELSE 'pending' END AS state,
  {_tstamp('since')} AS active_since FROM j"""

ORACLE["value_text"] = """
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'Disconnected' WHEN 1 THEN 'Connected' END AS text
FROM events"""

ORACLE["time_range"] = """
SELECT event_id, ts FROM events
WHERE epoch_us(ts) > (SELECT max(epoch_us(ts)) FROM events) - 21600000000"""

ORACLE["ingest_counters"] = with_frames("""
SELECT 'received' AS counter, count(*) AS value FROM rs
UNION ALL SELECT 'filtered', count(*) FILTER (WHERE reason = 'event_type') FROM rs
UNION ALL SELECT 'processed', count(*) FILTER (WHERE reason IS NULL) FROM rs
""" + "".join(f"UNION ALL SELECT 'rejected_{r}', count(*) FILTER (WHERE reason = '{r}') FROM rs\n"
             for r in ("bad_frame", "unknown_type", "not_event", "no_id", "event_type",
                       "no_new_state", "no_entity_id", "no_old_state", "skipped_state",
                       "bad_domain", "cast_failed")))
ORACLE["labelled_counter"] = with_frames("""
SELECT ha_type AS event_type, CASE WHEN reason IS NULL THEN 'success' ELSE 'error' END AS status,
  count(*) AS value FROM rs GROUP BY ALL""")
ORACLE["route_counts"] = with_frames("SELECT domain, count(*) AS rows FROM chg GROUP BY domain")


# -- batching ------------------------------------------------------------------------------
ORACLE["batch_by_count"] = with_frames(
    "SELECT seq, domain, CAST(floor((row_number() OVER (PARTITION BY domain "
    "ORDER BY last_updated, seq) - 1) / 100) AS BIGINT) AS batch_no FROM chg")
ORACLE["batch_counters"] = with_frames("""
, bb AS (SELECT domain, floor((row_number() OVER (PARTITION BY domain ORDER BY last_updated, seq) - 1)
           / 100) AS b FROM chg),
sz AS (SELECT domain, b, count(*) AS n FROM bb GROUP BY ALL)
SELECT domain, count(*) AS batches, sum(n) AS rows, min(n) AS min_size, max(n) AS max_size
FROM sz GROUP BY domain""".replace("\n, bb AS", ", bb AS", 1))
ORACLE["check_destination"] = with_frames("""
, bb AS (SELECT domain, seq, CAST((row_number() OVER (PARTITION BY domain ORDER BY last_updated, seq) - 1)
           // 100 AS BIGINT) AS batch_no FROM chg),
cd AS (SELECT batch_no, count(DISTINCT domain) AS tables,
         count(*) FILTER (WHERE seq % 1000 = 0) AS foreign_rows FROM bb GROUP BY batch_no)
SELECT * FROM cd WHERE tables <> 1 OR foreign_rows > 0""".replace("\n, bb", ", bb", 1))
# Anchored wait batches: each batch opens at the first row at or after the
# previous open + 2 h (recursive), rows take the latest open at or before them.
ORACLE["batch_by_wait"] = """
WITH RECURSIVE opens(event_type, t, k) AS (
  SELECT event_type, min(ts), 0 FROM events GROUP BY event_type
  UNION ALL
  SELECT o.event_type,
         (SELECT min(e.ts) FROM events e
           WHERE e.event_type = o.event_type AND e.ts >= o.t + INTERVAL 2 HOUR), o.k + 1
  FROM opens o WHERE o.t IS NOT NULL)
SELECT e.event_id, e.event_type, CAST(o.k AS BIGINT) AS batch_no, o.t AS batch_start
FROM events e ASOF JOIN (SELECT * FROM opens WHERE t IS NOT NULL) o
  ON e.event_type = o.event_type AND e.ts >= o.t"""

# Size or wait: each row's next opening row is the nearer of 20 rows on and the
# first row 2 h on; the batches are the chain of those from each first row.
ORACLE["batch_rows"] = """
WITH RECURSIVE r AS (
  SELECT event_id, event_type, ts,
         row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS pos FROM events),
firsts AS (SELECT event_type, ts, min(pos) AS pos FROM r GROUP BY event_type, ts),
n AS (
  SELECT r.event_type, r.pos, r.ts, least(r.pos + 20, coalesce(x.pos, r.pos + 20)) AS nxt
  FROM r ASOF LEFT JOIN firsts x
    ON r.event_type = x.event_type AND r.ts + INTERVAL 2 HOUR <= x.ts),
opens(event_type, pos, t, nxt, k) AS (
  SELECT event_type, pos, ts, nxt, 0 FROM n WHERE pos = 1
  UNION ALL
  SELECT n.event_type, n.pos, n.ts, n.nxt, o.k + 1
  FROM opens o JOIN n ON n.event_type = o.event_type AND n.pos = o.nxt)
SELECT r.event_id, r.event_type, CAST(o.k AS BIGINT) AS batch_no, o.t AS batch_start
FROM r ASOF JOIN opens o ON r.event_type = o.event_type AND r.pos >= o.pos"""


#: A stream in which nothing is late gives the same batches.
ORACLE["batch_stream"] = ORACLE["batch_rows"]

ORACLE["read_loose_json"] = """
SELECT event_id,
       CASE WHEN event_id % 7 = 0 THEN NULL ELSE CASE event_id % 5
         WHEN 0 THEN CAST(event_id AS VARCHAR) WHEN 1 THEN 'true'
         WHEN 2 THEN '[' || event_id || ',2]' WHEN 3 THEN 't' || event_id END END AS loose,
       CASE WHEN event_id % 7 = 0 OR event_id % 5 = 3 THEN NULL ELSE CAST(event_id AS BIGINT) END
         AS number
FROM events"""

# Every known domain, with or without rows.
ORACLE["store_read_back"] = with_frames(
    "SELECT d.domain, count(c.seq) AS rows, count(DISTINCT c.entity_id) AS entities, "
    "min(CASE c.type_group WHEN 'bool' THEN CAST(c.state_bool AS VARCHAR) "
    "WHEN 'string' THEN c.state_text WHEN 'bigint' THEN CAST(c.state_long AS VARCHAR) END) "
    "AS least_state, max(c.last_updated) AS last_updated "
    "FROM (SELECT unnest([" + ", ".join(f"'{d}'" for d in [*DOMAIN_TYPES, "lock"]) + "]) AS domain) d "
    "LEFT JOIN chg c ON c.domain = d.domain GROUP BY d.domain")

ORACLE["stream_counters"] = with_frames("""
SELECT 'events_received_total' AS metric, count(*) AS value FROM rs
UNION ALL SELECT 'events_filtered_total', count(*) FILTER (WHERE reason = 'event_type') FROM rs
UNION ALL SELECT 'events_processed_total', count(*) FILTER (WHERE reason IS NULL) FROM rs""")


def _rfc(c: str) -> str:
    return (f"regexp_replace(regexp_replace(strftime({c}, '%Y-%m-%dT%H:%M:%S.%f'), '0+$', ''), "
            "'\\.$', '') || 'Z'")


def _wire(raw: str, text: str) -> str:
    return (f"CASE WHEN grp = 'bool' THEN CAST(coalesce({raw} IN ('on', 'true'), false) AS VARCHAR) "
            f"ELSE CAST(to_json({text}) AS VARCHAR) END")


ORACLE["json_rows"] = with_frames(
    "SELECT event_id AS seq, '{\"entity_id\":' || CAST(to_json(entity) AS VARCHAR) || "
    f"',\"state\":' || {_wire('new_raw', 'new_raw')} || ',\"old_state\":' || {_wire('old_raw', 'old_txt')} "
    "|| ',\"attributes\":' || props || ',\"context\":' || CAST(json_object('id', CAST(event_id AS "
    "VARCHAR), 'parent_id', NULL, 'user_id', NULL) AS VARCHAR) "
    f"|| ',\"last_changed\":\"' || {_rfc('ts')} || '\",\"last_updated\":\"' || {_rfc('ts')} || '\"' "
    f"|| CASE WHEN event_id % 2 = 0 THEN ',\"last_reported\":\"' || {_rfc('ts')} || '\"' ELSE '' END "
    "|| '}' AS value FROM rs WHERE reason IS NULL")


# -- the pipeline's own metrics -------------------------------------------------------
# Every counted happening as (time, metric, labels); batches are the chains of events
# 1 s or 100,000 rows apart per domain. A counter has a sample at every 30 s step from
# its first to its last happening.
_SIZES = [10 + 100 * i for i in range(10)]
_S = 30
_HAPPENINGS = with_frames(f"""
, r AS (SELECT split_part(entity, '.', 1) AS d, date_trunc('millisecond', ts) AS ts, event_id, ts AS fired,
         row_number() OVER (PARTITION BY split_part(entity, '.', 1) ORDER BY ts, event_id) AS pos
       FROM rs WHERE ha_type = 'state_changed' AND NOT removed),
firsts AS (SELECT d, ts, min(pos) AS pos FROM r GROUP BY ALL),
n AS (SELECT r.d, r.pos, r.ts, least(r.pos + 100000, coalesce(x.pos, r.pos + 100000)) AS nxt
      FROM r ASOF LEFT JOIN firsts x ON r.d = x.d AND r.ts + INTERVAL 1 SECOND <= x.ts),
opens(d, pos, t, nxt) AS (
  SELECT d, pos, ts, nxt FROM n WHERE pos = 1
  UNION ALL
  SELECT n.d, n.pos, n.ts, n.nxt FROM opens o JOIN n ON n.d = o.d AND n.pos = o.nxt),
bt AS (SELECT t, least(nxt, (SELECT max(pos) + 1 FROM r WHERE r.d = opens.d)) - pos AS size FROM opens),
hp AS (
  SELECT date_trunc('millisecond', ts) AS t, 'ingest_events_received_total' AS metric, '[]' AS labels FROM rs
  UNION ALL SELECT date_trunc('millisecond', ts), 'ingest_events_filtered_total', '[]' FROM rs
    WHERE reason = 'event_type'
  UNION ALL SELECT date_trunc('millisecond', ts), 'ingest_events_processed_total', '[]' FROM rs
    WHERE reason IS NULL
  UNION ALL SELECT t, 'ingest_batches_processed_total', '[]' FROM bt
  UNION ALL SELECT t, 'ingest_database_operations_total',
    '[{{"key":"operation","value":"insert"}},{{"key":"status","value":"success"}}]' FROM bt
  UNION ALL SELECT t, 'ingest_batch_size_bucket', '[{{"key":"le","value":"' || le || '"}}]'
    FROM bt, (SELECT unnest({_SIZES}) AS b, unnest({[str(b) for b in _SIZES]}) AS le) WHERE size <= b
  UNION ALL SELECT t, 'ingest_batch_size_bucket', '[{{"key":"le","value":"+Inf"}}]' FROM bt)""".replace("\n, r AS", ", r AS", 1)).replace("WITH base", "WITH RECURSIVE base", 1)
ORACLE["pipeline_metrics"] = _HAPPENINGS + f"""
SELECT metric, labels, (max({_step('t', _S)}) - min({_step('t', _S)})) // {_S} + 1 AS samples,
  {_tstamp(f"min({_step('t', _S)})")} AS first_ts, {_tstamp(f"max({_step('t', _S)})")} AS last_ts,
  CAST(count(*) AS DOUBLE) AS last_value
FROM hp GROUP BY metric, labels"""

# The counters' samples every 30 s, and their rates. Of the rules, two can be active in
# a run that reads and writes without a fault: no events, and a large filtered share.
_RATES = _HAPPENINGS + f""",
pb AS (SELECT metric, labels, {_step('t', _S)} AS t, count(*) AS n FROM hp GROUP BY ALL),
pg AS (SELECT metric, labels, unnest(range(lo, hi + {_S}, {_S})) AS t
       FROM (SELECT metric, labels, min(t) AS lo, max(t) AS hi FROM pb GROUP BY ALL)),
ps AS (SELECT metric || labels AS id, t * 1000000 AS us, CAST(sum(coalesce(n, 0)) OVER (
         PARTITION BY metric, labels ORDER BY t) AS DOUBLE) AS value
       FROM pg LEFT JOIN pb USING (metric, labels, t)),""" + _stretched(
    "id", "SELECT * FROM ps", 300, _S)
_RATE = {k: f"(SELECT t, x / 300.0 AS v FROM ex WHERE id = 'ingest_events_{k}_total[]')"
         for k in ("received", "filtered", "processed")}


def _alert(name: str, severity: str, hold: int, active: str) -> str:
    """Rows of a rule, given the steps (t, microseconds) at which it holds true."""
    s = _S * 1_000_000
    return f"""SELECT '{name}' AS alertname, '{severity}' AS severity, '[]' AS sk, make_timestamp(t) AS t,
  CASE WHEN t - since >= {hold * 1_000_000} THEN 'firing' ELSE 'pending' END AS state,
  make_timestamp(since) AS active_since
FROM (SELECT t, min(t) OVER (PARTITION BY island) AS since FROM (
  SELECT t, t // {s} - row_number() OVER (ORDER BY t) AS island FROM ({active})))"""


ORACLE["alert_rules"] = _RATES + "," + _stretched(
    "id", "SELECT * FROM ps WHERE id = 'ingest_events_received_total[]'", 1800, _S, "q") + f"""
{_alert('NoEventsReceived', 'warning', 1800, 'SELECT t FROM qex WHERE x / 1800.0 = 0')}
UNION ALL
{_alert('HighEventFilterRate', 'warning', 900, f"SELECT t FROM {_RATE['filtered']} f JOIN "
        f"{_RATE['received']} r USING (t) WHERE r.v <> 0 AND f.v / r.v > 0.5")}"""


def _panel(panel: str, series: str, rows: str, sk: str = "[]") -> str:
    return (f"SELECT '{panel}' AS panel, '{series}' AS series, '{sk}' AS sk, make_timestamp(t) AS t, "
            f"v AS value FROM ({rows})")


def _size_quantile(q: float) -> str:
    """The first bucket that reaches the rank, cut linearly; no batches: NULL."""
    return f"""
SELECT t, CASE WHEN any_value(total) > 0 THEN arg_min(CASE WHEN le = 'inf'::DOUBLE THEN finite
    ELSE ple + (le - ple) * (CASE WHEN c > pc THEN ({q} * total - pc) / (c - pc) ELSE 0.0 END) END, le)
    FILTER (WHERE c >= {q} * total) END AS v
FROM (SELECT t, le, c, coalesce(lag(le) OVER w, 0.0) AS ple, coalesce(lag(c) OVER w, 0.0) AS pc,
        max(c) FILTER (WHERE le = 'inf'::DOUBLE) OVER (PARTITION BY t) AS total,
        max(le) FILTER (WHERE le <> 'inf'::DOUBLE) OVER (PARTITION BY t) AS finite
      FROM sz WINDOW w AS (PARTITION BY t ORDER BY le))
GROUP BY t"""


#: Gauges, durations and retries have no samples in this run, so their panels are empty.
ORACLE["panels"] = _RATES + """,
sz AS (SELECT t, x / 300.0 AS c, CASE WHEN id LIKE '%"+Inf"%' THEN 'inf'::DOUBLE
         ELSE CAST(regexp_extract(id, '"value":"([0-9]+)"', 1) AS DOUBLE) END AS le
       FROM ex WHERE id LIKE 'ingest_batch_size_bucket%')
""" + "\nUNION ALL ".join([
    _panel("Event Rates", "Receive Rate", _RATE["received"]),
    _panel("Event Rates", "Process Rate", f"SELECT t, r.v - f.v AS v FROM {_RATE['received']} r "
           f"JOIN {_RATE['filtered']} f USING (t)"),
    _panel("Event Rates", "Filter Rate", _RATE["filtered"]),
    _panel("Event Processing Rate", "Events Received", _RATE["received"]),
    _panel("Event Processing Rate", "Events Processed", _RATE["processed"]),
    _panel("Batch Processing Rate", "Batches Processed",
           "SELECT t, x / 300.0 AS v FROM ex WHERE id = 'ingest_batches_processed_total[]'"),
    _panel("Batch Size", "Batch Size (p95)", _size_quantile(0.95)),
    _panel("Batch Size", "Batch Size (p50)", _size_quantile(0.5)),
    _panel("Database Operations", "insert - success",
           "SELECT t, x / 300.0 AS v FROM ex WHERE id LIKE 'ingest_database_operations_total%'",
           '[{"key":"operation","value":"insert"}]'),
])

"""Time-series operators over events and metric samples (dashboard / alert
expressions).

Times on the evaluation grid are epoch seconds (``t_sec``, bigint) inside the
plans and TIMESTAMP (``t``) in results. A step ``t`` covers the bucket
``(t - step, t]``; a trailing window ``w`` at ``t`` covers ``(t - w, t]``,
i.e. the ``w / step`` buckets ending at ``t``.

Scale notes:

* raw rows are first reduced to one row per (series, step bucket) - a hash
  aggregate with partial aggregation - so everything after that is sized by
  series x steps, not by rows;
* a trailing window over events is a slide: each bucket row is repeated onto
  the ``w / step`` steps it belongs to (``explode(sequence)``) and summed by
  (series, step). This spreads a hot series over its steps instead of putting
  it into one task as ``rangeBetween`` over a series partition would, and
  needs no cross join with a step grid;
* ``rate`` and ``increase`` on counter samples are differences between the
  first and the last sample of a window, found in chunks of time
  (``_window_ends``), so a long series is spread over its chunks.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_UNITS = {"s": 1, "m": 60, "h": 3600, "d": 86400, "w": 604800}


def seconds(d) -> int:
    """'30s', '5m', '1h', '6 hours', 300 -> seconds."""
    if isinstance(d, (int, float)):
        return int(d)
    m = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]+)\s*", d)
    if not m:
        raise ValueError(f"bad duration {d!r}")
    n, u = int(m.group(1)), m.group(2).lower()
    u = {"sec": "s", "second": "s", "seconds": "s", "min": "m", "minute": "m", "minutes": "m",
         "hour": "h", "hours": "h", "day": "d", "days": "d"}.get(u, u)
    return n * _UNITS[u[0]]


def micros(d) -> int:
    """Like ``seconds`` but in microseconds, and also accepts 'ms' / 'us'."""
    if isinstance(d, str):
        m = re.fullmatch(r"\s*(\d+)\s*(ms|us)\s*", d)
        if m:
            return int(m.group(1)) * (1000 if m.group(2) == "ms" else 1)
    return seconds(d) * 1_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def step_of(ts, step) -> Column:
    """Epoch second of the grid step whose bucket (t - step, t] holds ts."""
    s_us = seconds(step) * 1_000_000
    up = F.unix_micros(_c(ts).cast("timestamp")) + F.lit(s_us - 1)
    return ((up - F.pmod(up, F.lit(s_us))) / F.lit(1_000_000)).cast("long")


def _t(col: str = "t_sec") -> Column:
    return F.timestamp_seconds(F.col(col)).alias("t")


def _slide(buckets: DataFrame, by: Sequence[str], window, step, aggs: dict[str, Column]) -> DataFrame:
    """Repeat each (series, bucket) row onto the steps whose window holds it,
    then aggregate per (series, step)."""
    w, s = seconds(window), seconds(step)
    if w % s:
        raise ValueError("window must be a multiple of step")
    n = w // s
    spread = buckets.withColumn(
        "t_sec", F.explode(F.sequence(F.col("t_sec"), F.col("t_sec") + F.lit((n - 1) * s),
                                      F.lit(s))))
    return spread.groupBy(*by, "t_sec").agg(*[c.alias(k) for k, c in aggs.items()])


# -- events -> rates ---------------------------------------------------------------

def bucket_counts(df: DataFrame, ts: str, by: Sequence[str], step) -> DataFrame:
    """Rows per (series, step bucket): ``by..., t_sec, n``."""
    return (df.select(*by, step_of(ts, step).alias("t_sec"))
              .groupBy(*by, "t_sec").agg(F.count(F.lit(1)).alias("n")))


def increase_events(df: DataFrame, ts: str = "ts", by: Sequence[str] = (),
                    window="5m", step="30s") -> DataFrame:
    """Rows in (t - w, t] per series and step (steps with at least one row)."""
    b = bucket_counts(df, ts, by, step)
    out = _slide(b, by, window, step, {"value": F.sum("n").cast("double")})
    return out.select(*by, _t(), "value")


def rate_events(df: DataFrame, ts: str = "ts", by: Sequence[str] = (),
                window="5m", step="30s") -> DataFrame:
    """Per-second rate of rows over the trailing window."""
    inc = increase_events(df, ts, by, window, step)
    return inc.withColumn("value", F.col("value") / F.lit(float(seconds(window))))


# -- counters as samples ---------------------------------------------------------------

def counter_samples(df: DataFrame, ts: str, by: Sequence[str], step,
                    metric: str | None = None, restart_every=None) -> DataFrame:
    """Cumulative count per series, sampled at every step from the series'
    first to its last bucket (a scraped counter): ``by..., t, value``.

    ``restart_every`` (e.g. '1d') restarts the counter at each period, as a
    process restart would (the first step of a period is the first sample
    after the restart).

    The dense steps of a series come from ``sequence(first, last)`` of that
    series (no cross join); the running sum is a window over the per-series
    step rows, which are few (time range / step).
    """
    s = seconds(step)
    b = bucket_counts(df, ts, by, step)
    keys = list(by)
    if restart_every is not None:
        p = seconds(restart_every)
        b = b.withColumn("_epoch", F.floor((F.col("t_sec") - 1) / F.lit(p)).cast("long"))
        keys.append("_epoch")
    span = (b.groupBy(*keys).agg(F.min("t_sec").alias("lo"), F.max("t_sec").alias("hi"))
              .select(*keys, F.explode(F.sequence("lo", "hi", F.lit(s))).alias("t_sec")))
    dense = span.join(b, [*keys, "t_sec"], "left")
    w = Window.partitionBy(*keys).orderBy("t_sec").rowsBetween(Window.unboundedPreceding, 0)
    out = dense.select(*by, "t_sec", F.sum(F.coalesce("n", F.lit(0))).over(w)
                       .cast("double").alias("value"))
    if metric is not None:
        out = out.withColumn("metric", F.lit(metric))
    return out.select(*(["metric"] if metric is not None else []), *by, _t(), "value")


def _window_ends(samples: DataFrame, by: Sequence[str], window, step,
                 ts: str, value: str) -> DataFrame:
    """Per series and step whose window (t - w, t] holds two samples or more:
    ``by..., t_sec, pairs, first_us, last_us, first, inc``, where ``inc`` is the
    last value less the first plus what each reset inside the window lost.

    Time is cut into chunks of many windows; a sample goes to the chunks of the
    steps that see it (two at most, if a chunk is longer than a window), so a
    chunk knows all it needs and no series lies in one task. There a sample is
    the last one of the steps up to its successor and the first one of the
    steps that its predecessor has left: about two rows a sample, however many
    steps a window holds. Grouping by (series, chunk, step) reuses the shuffle
    by (series, chunk). Samples without a time or a value are none; of several
    at one time the largest counts."""
    w, s = seconds(window), seconds(step)
    if w <= 0 or s <= 0:
        raise ValueError("window and step must be positive")
    chunk = s * max(-(-10 * w // s), -(-86_400 // s))
    us, lo, hi = F.col("_us"), F.col("_lo"), F.col("_hi")

    def grid_from(c: Column) -> Column:
        """First step (seconds) at or after a time in microseconds."""
        up = c + F.lit(s * 1_000_000 - 1)
        return ((up - F.pmod(up, F.lit(s * 1_000_000))) / F.lit(1_000_000)).cast("long")

    def grid_before(c: Column) -> Column:
        """Last step before a time in microseconds."""
        return grid_from(c) - F.lit(s)

    def chunk_of(c: Column) -> Column:
        return F.floor(c / F.lit(chunk)).cast("long")

    seen = (samples.select(*by, F.unix_micros(_c(ts).cast("timestamp")).alias("_us"),
                           F.col(value).cast("double").alias("_v"))
            .where(us.isNotNull() & F.col("_v").isNotNull())
            .select("*", grid_from(us).alias("_lo"),
                    grid_before(us + F.lit(w * 1_000_000)).alias("_hi"))
            .where(lo <= hi)
            .withColumn("_chunk", F.explode(F.sequence(chunk_of(lo), chunk_of(hi)))))
    order = Window.partitionBy(*by, "_chunk").orderBy("_us", "_v")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    prev_v, start = F.col("_pv"), F.col("_chunk") * F.lit(chunk)
    placed = (seen.withColumn("_nus", F.lead("_us").over(order))
              .where(F.col("_nus").isNull() | (F.col("_nus") > us))
              .select("*", F.lag("_us").over(order).alias("_pus"), F.lag("_v").over(order).alias("_pv"))
              .select("*", F.row_number().over(order).alias("_i"),
                      F.sum(F.when(F.col("_v") < prev_v, prev_v).otherwise(F.lit(0.0)))
                      .over(upto).alias("_lost"))
              .withColumn("_lo", F.greatest(lo, start))
              .withColumn("_hi", F.least(hi, start + F.lit(chunk - s))))

    def steps(a: Column, b: Column, last: bool) -> Column:
        role = F.transform(F.sequence(a, b, F.lit(s)), lambda t: F.struct(
            t.alias("t_sec"), F.lit(last).alias("_last")))
        return F.when(a <= b, role).otherwise(F.array().cast("array<struct<t_sec:bigint,_last:boolean>>"))

    last_to = F.least(hi, F.coalesce(grid_before(F.col("_nus")), hi))
    first_from = F.greatest(lo, F.coalesce(grid_from(F.col("_pus") + F.lit(w * 1_000_000)), lo))
    roles = placed.select(*by, "_chunk", F.struct("_i", "_us", "_v", "_lost").alias("_s"),
                          F.inline(F.concat(steps(lo, last_to, True), steps(first_from, hi, False))))
    ends = roles.groupBy(*by, "_chunk", "t_sec").agg(
        F.max(F.when(F.col("_last"), F.col("_s"))).alias("_e"),
        F.max(F.when(~F.col("_last"), F.col("_s"))).alias("_b"))
    e, f = F.col("_e"), F.col("_b")
    return ends.where(e["_i"] > f["_i"]).select(
        *by, "t_sec", (e["_i"] - f["_i"]).alias("pairs"), f["_us"].alias("first_us"),
        e["_us"].alias("last_us"), f["_v"].alias("first"),
        (e["_v"] - f["_v"] + (e["_lost"] - f["_lost"])).alias("inc"))


#: Fixed value: a window's edge further from its nearest sample than this many
#: mean distances is taken as an end of the series.
EDGE_DISTANCES = 1.1


def increase_samples(samples: DataFrame, by: Sequence[str], window, step,
                     ts: str = "t", value: str = "value", extrapolate: bool = False) -> DataFrame:
    """Counter increase over (t - w, t] from samples: sum of deltas between
    consecutive samples inside the window; a drop is a reset (the new value
    counts from 0). Steps need two samples in the window.

    With ``extrapolate`` the increase is stretched from the samples' span to
    the window's edges, as the rules' evaluator does: to an edge nearer than
    ``EDGE_DISTANCES`` mean sample distances in full, else by half a distance;
    at the start never beyond the time at which the counter would have been 0."""
    ends = _window_ends(samples, by, window, step, ts, value)
    if not extrapolate:
        return ends.select(*by, _t(), F.col("inc").alias("value"))
    w_us = float(seconds(window) * 1_000_000)
    first, last, inc = F.col("first_us"), F.col("last_us"), F.col("inc")
    end = F.col("t_sec") * F.lit(1_000_000)
    span = (last - first).cast("double")
    mean = span / F.col("pairs")

    def reach(gap: Column) -> Column:
        return F.when(gap >= mean * F.lit(EDGE_DISTANCES), mean / F.lit(2.0)).otherwise(gap)

    before = reach((first - end).cast("double") + F.lit(w_us))
    zero = F.when((inc > 0) & (F.col("first") >= 0), span * (F.col("first") / inc))
    before = F.when(zero < before, zero).otherwise(before)
    after = reach((end - last).cast("double"))
    return ends.select(*by, _t(), (inc * ((span + before + after) / span)).alias("value"))


def rate_samples(samples: DataFrame, by: Sequence[str], window, step,
                 ts: str = "t", value: str = "value", extrapolate: bool = False) -> DataFrame:
    """``increase_samples`` per second of the window."""
    inc = increase_samples(samples, by, window, step, ts, value, extrapolate)
    return inc.withColumn("value", F.col("value") / F.lit(float(seconds(window))))


# -- histograms --------------------------------------------------------------------------

def linear_bounds(start: float, width: float, count: int) -> list[float]:
    return [start + i * width for i in range(count)]


def exponential_bounds(start: float, factor: float, count: int) -> list[float]:
    return [start * factor ** i for i in range(count)]


# The default duration buckets of the metrics library (seconds).
DEFAULT_DURATION_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10]


def histogram(df: DataFrame, value: str, bounds: Sequence[float],
              by: Sequence[str] = ()) -> DataFrame:
    """Cumulative bucket counts (``le`` ascending, last +Inf) with the sum and
    count of the observations: ``by..., le, bucket, sum, count``.

    One pass: a ``count_if(v <= b)`` per bound inside one aggregate (partial
    aggregation before the shuffle), then an explode of the bucket array.
    """
    bounds = sorted(float(b) for b in bounds)
    v = F.col(value)
    aggs = [F.count_if(v <= F.lit(b)).alias(f"_b{i}") for i, b in enumerate(bounds)]
    agg = df.groupBy(*by).agg(*aggs, F.count(v).alias("count"), F.sum(v).alias("sum"))
    arr = F.array(*[F.struct(F.lit(b).alias("le"), F.col(f"_b{i}").alias("bucket"))
                    for i, b in enumerate(bounds)],
                  F.struct(F.lit(float("inf")).alias("le"), F.col("count").alias("bucket")))
    return agg.select(*by, F.inline(arr), "sum", "count")


def bucket_rates(df: DataFrame, ts: str, value: str, bounds: Sequence[float],
                 by: Sequence[str] = (), window="5m", step="30s",
                 per_second: bool = True) -> DataFrame:
    """``rate(x_bucket[w])`` summed by (by, le): per step, the cumulative count
    of observations <= le in the trailing window: ``by..., t, le, value``."""
    bounds = sorted(float(b) for b in bounds)
    v = F.col(value)
    # Index of the first bound >= v (len(bounds) = +Inf bucket).
    idx = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        idx = F.when(v <= F.lit(bounds[i]), F.lit(i)).otherwise(idx)
    b = (df.select(*by, step_of(ts, step).alias("t_sec"), idx.alias("_i"))
           .groupBy(*by, "t_sec", "_i").agg(F.count(F.lit(1)).alias("n")))
    slid = _slide(b, [*by, "_i"], window, step, {"n": F.sum("n")})
    # Per (series, step): non-cumulative counts -> cumulative over le.
    les = F.array(*[F.lit(x) for x in bounds], F.lit(float("inf")))
    per = slid.groupBy(*by, "t_sec").agg(F.map_from_entries(
        F.collect_list(F.struct("_i", "n"))).alias("_m"))
    cum = F.transform(F.sequence(F.lit(0), F.lit(len(bounds))), lambda k: F.struct(
        F.element_at(les, k + 1).alias("le"),
        F.aggregate(F.sequence(F.lit(0), k), F.lit(0).cast("long"),
                    lambda acc, j: acc + F.coalesce(F.col("_m")[j], F.lit(0).cast("long")))
        .alias("value")))
    out = per.select(*by, "t_sec", F.inline(cum))
    div = float(seconds(window)) if per_second else 1.0
    return out.select(*by, _t(), "le", (F.col("value") / F.lit(div)).alias("value"))


def bucket_quantile(hist: DataFrame, q, by: Sequence[str] = (), le: str = "le",
                    value: str = "value") -> DataFrame:
    """Quantile(s) from cumulative buckets (one row per ``le`` incl. +Inf).

    rank = q * total; the first bucket whose count reaches rank is
    interpolated linearly between its lower bound (0 for the first bucket)
    and its upper bound; a rank in the +Inf bucket gives the last finite
    bound; an empty histogram gives NULL. ``q`` may be a list: the
    histogram rows are repeated per q, so every quantile comes from one pass.
    Output: ``by..., q, value`` (``q`` only when a list is given).
    Groups are one histogram each (a dozen rows), so the windows are small.
    """
    qs = list(q) if isinstance(q, (list, tuple)) else [q]
    keys = [*by, "_q"]
    w = Window.partitionBy(*keys).orderBy("_le")
    w_all = Window.partitionBy(*keys)
    h = (hist.select(*by, F.col(le).alias("_le"), F.col(value).cast("double").alias("_c"),
                     F.explode(F.array(*[F.lit(float(x)) for x in qs])).alias("_q"))
             .select("*", F.lag("_le").over(w).alias("_prev_le"),
                     F.coalesce(F.lag("_c").over(w), F.lit(0.0)).alias("_prev_c"),
                     F.max(F.when(F.col("_le") == float("inf"), F.col("_c"))).over(w_all)
                     .alias("_total"),
                     F.max(F.when(F.col("_le") != float("inf"), F.col("_le"))).over(w_all)
                     .alias("_last_finite")))
    hit = (F.col("_c") >= F.col("_q") * F.col("_total")) & (F.col("_total") > 0)
    # One aggregate per histogram: the first bucket reaching the rank (NULL
    # ordering for the others, so an empty histogram gets NULL).
    first = h.groupBy(*keys).agg(F.min_by(
        F.struct("_le", "_prev_le", "_c", "_prev_c", "_total", "_last_finite"),
        F.when(hit, F.col("_le"))).alias("b"))
    lower = F.when(F.col("b._prev_le").isNull(),
                   F.when(F.col("b._le") > 0, F.lit(0.0)).otherwise(F.col("b._le"))) \
             .otherwise(F.col("b._prev_le"))
    width = F.col("b._c") - F.col("b._prev_c")
    frac = F.when(width > 0, (F.col("_q") * F.col("b._total") - F.col("b._prev_c")) / width) \
            .otherwise(F.lit(0.0))
    qv = (F.when(F.col("b._le") == float("inf"), F.col("b._last_finite"))
           .when(F.col("b._prev_le").isNull() & (F.col("b._le") <= 0), F.col("b._le"))
           .otherwise(lower + (F.col("b._le") - lower) * frac))
    cols = [*by, F.col("_q").alias("q")] if isinstance(q, (list, tuple)) else list(by)
    return first.select(*cols, qv.alias("value"))


# -- vector matching ------------------------------------------------------------------

def vector_binary(a: DataFrame, b: DataFrame, on: Sequence[str], op: str,
                  value: str = "value") -> DataFrame:
    """a <op> b for samples with equal labels and time; x / 0 -> NULL."""
    l = a.select(*on, F.col(value).alias("_a"))
    r = b.select(*on, F.col(value).alias("_b"))
    j = l.join(r, list(on), "inner")
    ops = {"/": F.try_divide(F.col("_a"), F.col("_b")),
           "-": F.col("_a") - F.col("_b"), "+": F.col("_a") + F.col("_b"),
           "*": F.col("_a") * F.col("_b")}
    res = ops[op]
    if op == "/":
        res = F.when(F.col("_b") != 0, res)
    return j.select(*on, res.alias(value))


def vector_or(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """All of a, plus the samples of b whose labels (at that time) are not in a."""
    return a.unionByName(b.join(a.select(*on), list(on), "left_anti"))


def compare(df: DataFrame, op: str, threshold: float, value: str = "value") -> DataFrame:
    """Keep samples passing ``value <op> threshold`` (==, !=, <, <=, >, >=)."""
    v, t = F.col(value), F.lit(threshold)
    cond = {"==": v == t, "!=": v != t, "<": v < t, "<=": v <= t, ">": v > t, ">=": v >= t}[op]
    return df.where(cond)


def alert(cond_true: DataFrame, hold, step, by: Sequence[str] = (), t: str = "t") -> DataFrame:
    """Alert state per step from the steps where the condition holds.

    ``cond_true`` has one row per (series, step) where the condition is true;
    rows that repeat one count once; a missing step is false and resets the
    hold. Consecutive true steps form
    an island (gaps-and-islands: step index minus row number is constant);
    a step is ``firing`` once ``t - island start >= hold``, else ``pending``.
    Output: ``by..., t, state, active_since``.
    """
    s, h = seconds(step), seconds(hold)
    w = Window.partitionBy(*by).orderBy("_ts")
    x = (cond_true.select(*by, F.unix_seconds(F.col(t).cast("timestamp")).alias("_ts")).distinct()
                  .withColumn("_isl", (F.col("_ts") / F.lit(s)).cast("long") - F.row_number().over(w)))
    x = x.withColumn("_since", F.min("_ts").over(Window.partitionBy(*by, "_isl")))
    state = F.when(F.col("_ts") - F.col("_since") >= F.lit(h), "firing").otherwise("pending")
    return x.select(*by, F.timestamp_seconds("_ts").alias("t"), state.alias("state"),
                    F.timestamp_seconds("_since").alias("active_since"))


# -- small helpers -------------------------------------------------------------------------

def band(value, steps: Sequence[tuple[float, str]] = ((0.5, "red"), (0.8, "yellow")),
         otherwise: str = "green") -> Column:
    """Threshold band: first (limit, name) with value < limit, else ``otherwise``."""
    v = _c(value)
    out = None
    for lim, name in steps:
        out = F.when(v < F.lit(lim), F.lit(name)) if out is None else out.when(v < F.lit(lim), F.lit(name))
    return out.otherwise(F.lit(otherwise)) if out is not None else F.lit(otherwise)


def value_text(value, mapping: dict = {0: "Disconnected", 1: "Connected"}) -> Column:  # noqa: B006
    v = _c(value)
    out = None
    for k, name in mapping.items():
        out = F.when(v == F.lit(k), F.lit(name)) if out is None else out.when(v == F.lit(k), F.lit(name))
    return out


def time_range(df: DataFrame, ts: str, last="6h", now=None) -> DataFrame:
    """Rows with ts in (now - last, now]; ``now`` defaults to the latest ts
    (a scalar subquery: one value, evaluated once, no join). The bare column
    is compared in its own type, so the filter reaches the scan."""
    span = F.expr(f"INTERVAL {seconds(last)} SECONDS")
    if now is not None:
        end = F.lit(now).cast("timestamp")
        return df.where((F.col(ts) > end - span) & (F.col(ts) <= end))
    return df.where(F.col(ts) > df.select(F.max(ts) - span).scalar())


def select_series(samples: DataFrame, metric: str, **labels: str) -> DataFrame:
    """Samples of one metric whose labels equal the given values; the label
    values used become columns."""
    out = samples.where(F.col("metric") == metric)
    for k, v in labels.items():
        out = out.where(F.col("labels")[k] == v)
    return out


def sum_by(df: DataFrame, by: Sequence[str], t: str = "t", value: str = "value") -> DataFrame:
    return df.groupBy(*by, t).agg(F.sum(value).alias(value))


def max_by_label(df: DataFrame, by: Sequence[str], t: str = "t", value: str = "value") -> DataFrame:
    return df.groupBy(*by, t).agg(F.max(value).alias(value))

"""Time-series edge cases on literal samples."""

import datetime as dt
import random

import pytest

from stategrid.operators import series as ts

T0 = dt.datetime(2024, 1, 1)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def samples(spark, rows):
    return spark.createDataFrame([(s, at(m), float(v)) for s, m, v in rows],
                                 "series string, t timestamp, value double")


def test_counter_reset(spark):
    # 1-minute scrapes: 0, 5, 10, reset to 2, 4 -> increases 5, 5, 2, 2
    df = samples(spark, [("a", 0, 0), ("a", 1, 5), ("a", 2, 10), ("a", 3, 2), ("a", 4, 4)])
    out = {r.t: r.value for r in ts.increase_samples(df, ["series"], "5m", "1m").collect()}
    assert out[at(4)] == 14.0          # window (t-5m, t] holds all five samples
    assert out[at(1)] == 5.0 and out[at(3)] == 12.0
    # the pair (t=0, t=1) leaves the window once t - 5m >= 0
    assert out[at(5)] == 9.0 and at(9) not in out


def test_rate_needs_two_samples(spark):
    df = samples(spark, [("a", 0, 3)])
    assert ts.rate_samples(df, ["series"], "5m", "1m").count() == 0


def by_the_book(rows, window, step):
    """The stretched increase step by step, from all samples of each window."""
    out = {}
    for s in {r[0] for r in rows}:
        mine = {}
        for _, sec, v in (r for r in rows if r[0] == s and r[2] is not None):
            mine[sec] = max(v, mine.get(sec, v))
        mine = sorted(mine.items())
        for t in range(0, 3 * 86_400, step):
            win = [(a, v) for a, v in mine if t - window < a <= t]
            if len(win) < 2:
                continue
            inc = sum(v - u if v >= u else v for (_, u), (_, v) in zip(win, win[1:]))
            span = win[-1][0] - win[0][0]
            mean = span / (len(win) - 1)
            gaps = [win[0][0] - (t - window), t - win[-1][0]]
            start, end = (mean / 2 if g >= 1.1 * mean else g for g in gaps)
            if inc > 0 and win[0][1] >= 0:
                start = min(start, span * win[0][1] / inc)
            out[s, t] = (inc, inc * (span + start + end) / span)
    return out


@pytest.mark.parametrize("window,step", [(300, 60), (300, 30), (3600, 3600), (5400, 60)])
def test_windows_of_samples_by_the_book(spark, window, step):
    """Regular and irregular scrapes, resets, gaps, repeated times, absent values and
    windows across the chunks' borders at midnight."""
    rnd = random.Random(7)
    rows = [("even", 86_000 + 30 * i, float(i % 17)) for i in range(60)]
    rows += [("odd", rnd.randrange(80_000, 180_000), float(rnd.randrange(50))) for _ in range(250)]
    rows += [r for r in rows[60:70]] + [("odd", rows[80][1], 99.0), ("odd", 90_000, None), ("one", 500, 3.0)]
    df = spark.createDataFrame([(s, T0 + dt.timedelta(seconds=x), v) for s, x, v in rows],
                               "series string, t timestamp, value double")
    want = by_the_book(rows, window, step)
    assert want
    for extrapolate in (False, True):
        got = {(r.series, int((r.t - T0).total_seconds())): r.value for r in ts.increase_samples(
            df, ["series"], f"{window}s", f"{step}s", extrapolate=extrapolate).collect()}
        assert got.keys() == want.keys()
        for k, v in got.items():
            assert v == pytest.approx(want[k][extrapolate], abs=1e-9)


def test_windows_of_samples_shuffle_once(spark):
    df = samples(spark, [("a", m, m) for m in range(10)]).repartition(3)
    plan = ts.rate_samples(df, ["series"], "5m", "1m", extrapolate=True) \
        ._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_missing_steps_reset_alert(spark):
    cond = samples(spark, [("a", m, 1) for m in (0, 1, 2, 3, 5, 6)])
    out = {r.t: r.state for r in ts.alert(cond, "3m", "1m", ["series"]).collect()}
    assert [out[at(m)] for m in (0, 1, 2, 3)] == ["pending", "pending", "pending", "firing"]
    assert out[at(5)] == "pending" and out[at(6)] == "pending"      # gap at 4 reset it


def test_alert_hold_minus_one_step(spark):
    cond = samples(spark, [("a", m, 1) for m in (0, 1, 2)])
    states = {r.state for r in ts.alert(cond, "3m", "1m", ["series"]).collect()}
    assert states == {"pending"}


def histo(spark, rows):
    return spark.createDataFrame(rows, "g string, le double, value double")


def test_quantile_interpolates(spark):
    h = histo(spark, [("x", 1.0, 10.0), ("x", 2.0, 20.0), ("x", float("inf"), 20.0)])
    (r,) = ts.bucket_quantile(h, 0.5, ["g"]).collect()
    assert r.value == pytest.approx(1.0)         # rank 10 -> top of the first bucket
    (r,) = ts.bucket_quantile(h, 0.75, ["g"]).collect()
    assert r.value == pytest.approx(1.5)


def test_quantile_all_mass_in_inf_and_empty(spark):
    h = histo(spark, [("x", 1.0, 0.0), ("x", 5.0, 0.0), ("x", float("inf"), 4.0),
                      ("y", 1.0, 0.0), ("y", float("inf"), 0.0)])
    got = {r.g: r.value for r in ts.bucket_quantile(h, 0.9, ["g"]).collect()}
    assert got == {"x": 5.0, "y": None}


def test_ratio_zero_denominator_is_null(spark):
    a = samples(spark, [("a", 0, 0.0), ("a", 1, 2.0)])
    b = samples(spark, [("a", 0, 0.0), ("a", 1, 4.0)])
    got = {r.t: r.value for r in ts.vector_binary(a, b, ["series", "t"], "/").collect()}
    assert got == {at(0): None, at(1): 0.5}


def test_vector_or_one_sided(spark):
    a = samples(spark, [("a", 0, 1.0)])
    b = samples(spark, [("a", 0, 9.0), ("b", 0, 2.0)])
    got = sorted((r.series, r.value) for r in ts.vector_or(a, b, ["series", "t"]).collect())
    assert got == [("a", 1.0), ("b", 2.0)]


def test_rate_events_window_is_open_below(spark):
    ev = spark.createDataFrame([(at(0),), (at(1),), (at(1),)], "ts timestamp")
    got = {r.t: r.value for r in ts.increase_events(ev, "ts", [], "2m", "1m").collect()}
    assert got == {at(0): 1.0, at(1): 3.0, at(2): 2.0}


def test_band_and_text(spark):
    df = spark.createDataFrame([(0.2,), (0.6,), (0.9,)], "v double")
    assert [r[0] for r in df.select(ts.band("v")).collect()] == ["red", "yellow", "green"]
    df = spark.createDataFrame([(0.0,), (1.0,)], "v double")
    assert [r[0] for r in df.select(ts.value_text("v")).collect()] == ["Disconnected", "Connected"]

"""Batching against hand-made cases and a row-by-row walk. Rows are strings,
the key is the first letter; times are given in milliseconds."""

import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from stategrid.operators import batching
from stategrid.operators.batching import batch_by_count, batch_rows, split_by_key

T0 = dt.datetime(2024, 1, 1)


def rows_df(spark, names):
    return spark.createDataFrame(
        [(n, i, T0 + dt.timedelta(milliseconds=10 * i)) for i, n in enumerate(names)],
        "name string, i long, ts timestamp")


def batches(df, col="name"):
    got = {}
    for r in df.collect():
        got.setdefault((r["_g"], r.batch_no), []).append(r[col])
    return sorted("".join(sorted(v)) for v in got.values())


def run(spark, names, key, size, wait):
    df = rows_df(spark, names)
    if key:
        df = df.withColumn("k", F.substring("name", 1, 1))
    out = batch_rows(df, "k" if key else None, "ts", ["ts", "i"], size, wait)
    return batches(out.withColumn("_g", F.col("k") if key else F.lit("")))


def test_none(spark):
    assert run(spark, [], False, 100, "60s") == []


def test_size_leaves_a_short_last_batch(spark):
    assert run(spark, list("pqrstuvw"), False, 5, "5m") == ["pqrst", "uvw"]


def test_keys_are_batched_apart(spark):
    # keys take turns; each fills its own batches
    names = ["m1", "n1", "m2", "m3", "n2", "m4", "n3", "o1"]
    assert run(spark, names, True, 2, "5m") == ["m1m2", "m3m4", "n1n2", "n3", "o1"]


def test_wait_closes_before_size(spark):
    # 10 ms apart, 45 ms from the first row: five rows a batch
    assert run(spark, list("pqrstuvwxyza"), False, 9, "45ms") == ["az", "pqrst", "uvwxy"]


def test_size_one(spark):
    # a size of one flushes every row
    assert run(spark, list("gh"), False, 1, "60s") == ["g", "h"]


def test_rows_without_a_key_go_to_the_errors(spark):
    df = rows_df(spark, ["k1", "?", "l1", "k2", "??", "k3"])
    df = df.withColumn("k", F.when(F.col("name").startswith("?"), None)
                       .otherwise(F.substring("name", 1, 1)))
    ok, err = split_by_key(df, "k")
    out = batch_rows(ok.drop("_key"), "k", "ts", ["ts", "i"], 2, "60s")
    assert batches(out.withColumn("_g", F.col("k"))) == ["k1k2", "k3", "l1"]
    assert {(r.name, r.reason) for r in err.collect()} == {("?", "no_key"), ("??", "no_key")}
    none, all_of = split_by_key(df.withColumn("k", F.lit(None).cast("string")), "k")
    assert none.count() == 0 and all_of.count() == 6


def test_count_batches_numbered_in_order(spark):
    df = rows_df(spark, [f"x{i}" for i in range(7)]).withColumn("k", F.lit("x"))
    out = batch_by_count(df, "k", ["ts", "i"], 3)
    assert [r.batch_no for r in out.orderBy("i").collect()] == [0, 0, 0, 1, 1, 1, 2]


def test_wait_boundary_opens_next_batch(spark):
    # a row at exactly open + wait starts the next batch
    df = spark.createDataFrame([(0, T0), (1, T0 + dt.timedelta(seconds=1)),
                                (2, T0 + dt.timedelta(seconds=2))], "i long, ts timestamp")
    out = batch_rows(df, None, "ts", ["ts", "i"], None, "1s")
    assert [r.batch_no for r in out.orderBy("i").collect()] == [0, 1, 2]


def test_size_cut_restarts_wait(spark):
    # size 2, wait 25 ms: rows at 0,10 | 20,30 | 40 (size cut at 20 restarts the anchor)
    df = rows_df(spark, list("abcde"))
    out = batch_rows(df, None, "ts", ["ts", "i"], 2, "25ms")
    assert [r.batch_no for r in out.orderBy("i").collect()] == [0, 0, 1, 1, 2]


def _walk(rows, size, wait_us):
    """Reference batcher: rows sorted by (ts, id); returns id -> batch number."""
    out, anchor, count, b = {}, None, 0, -1
    for t, i in rows:
        if anchor is None or (size and count >= size) or (wait_us and t >= anchor + wait_us):
            anchor, count, b = t, 0, b + 1
        count += 1
        out[i] = b
    return out


@pytest.mark.parametrize("key,size,wait,chunk", [
    (None, 25, "2h", 1 << 16), ("event_type", None, "2h", 1 << 16),
    ("event_type", 7, "30m", 13), (None, None, "10m", 5), (None, 25, "2h", 64)])
def test_batch_rows_equals_walk_on_events(spark, key, size, wait, chunk):
    import os
    from conftest import SF
    from stategrid.operators.series import micros
    ev = spark.read.parquet(os.path.join(SF["0.01"], "events.parquet"))
    got = {(r.event_type if key else "", r.event_id): (r.batch_no, r.batch_start) for r in
           batch_rows(ev, key, "ts", ["ts", "event_id"], size, wait, chunk).collect()}
    rows = sorted((r.event_type if key else "", r.ts, r.event_id) for r in
                  ev.select("event_type", "ts", "event_id").collect())
    exp = {}
    for k in sorted({k for k, _, _ in rows}):
        own = [(t, i) for kk, t, i in rows if kk == k]
        walked = _walk([(int(t.timestamp() * 1e6), i) for t, i in own], size, micros(wait))
        start = {}
        for t, i in own:
            start.setdefault(walked[i], t)
        exp.update({(k, i): (b, start[b]) for i, b in walked.items()})
    assert got == exp


def test_ties_nulls_and_repeated_rows(spark):
    rows = [("a", T0), ("a", T0), (None, T0), ("a", None), (None, None), ("a", T0)] * 5
    df = spark.createDataFrame(rows, "k string, ts timestamp")
    for chunk in (2, 1 << 16):
        got = batch_rows(df, "k", "ts", None, 4, "1s", chunk)
        sizes = sorted((r.k or "", r.batch_no, r.n) for r in got.groupBy("k", "batch_no").agg(
            F.count("*").alias("n")).collect())
        assert sizes == [("", 0, 4), ("", 1, 1), ("", 2, 4), ("", 3, 1),
                         ("a", 0, 4), ("a", 1, 1), ("a", 2, 4), ("a", 3, 4), ("a", 4, 4), ("a", 5, 3)]
    assert sorted(r.batch_no for r in batch_by_count(df, "k", ["ts"], 15).where(
        "k IS NULL").collect()) == [0] * 10


STEPS = st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 9)), min_size=1, max_size=40)


@settings(max_examples=300, deadline=None)
@given(STEPS, st.one_of(st.none(), st.integers(1, 5)), st.integers(1, 12), st.data())
def test_chunk_functions_compose(steps, size, wait, data):
    """Any chunks of any keys, folded, give the batches of a walk of each key."""
    clock, rows = 0, {"a": [], "b": []}
    for i, (k, gap) in enumerate(steps):
        clock += gap
        rows[k].append((clock, i))
    order = [(k, t, i) for k in "ab" for t, i in rows[k]]
    want = {i: b for k in "ab" for i, b in _walk(rows[k], size, wait).items()}
    cuts = sorted(data.draw(st.sets(st.integers(1, max(1, len(order) - 1)), max_size=6)))
    chunks = [order[a:b] for a, b in zip([0, *cuts], [*cuts, len(order)]) if a < b]
    pdf, arrays = [], []
    for c, chunk in enumerate(chunks):
        us = np.array([t for _, t, _ in chunk], np.int64)
        runs = batching._runs(np.array([k for k, *_ in chunk], object))
        arrays.append((us, runs))
        pdf += [(chunk[-1][0] if r[0] < 0 else chunk[0][0], c, *r)
                for r in batching.tabulate(us, runs, size, wait)]
    import pandas as pd
    table = pd.DataFrame(pdf, columns=["_k", "_chunk", "row", "until_row", "until_us", "exit_us",
                                       "exit_rows", "begun"]).sort_values(["_k", "_chunk", "row"])
    half = len(table) // 2
    entry = pd.concat(batching._fold(size, wait)(iter([table[:half], table[half:]])))
    at = {int(r[0]): tuple(map(int, r[1:])) for r in entry.itertuples(index=False)}
    got = {}
    for c, (chunk, (us, runs)) in enumerate(zip(chunks, arrays)):
        no, start = batching.cut(us, runs, size, wait, at.get(c))
        got.update({i: int(b) for (_, _, i), b in zip(chunk, no)})
    assert got == want


def test_tables_stay_small():
    """A chunk's function has at most as many entries as a batch has rows."""
    rng = random.Random(3)
    us = np.cumsum([rng.randrange(1, 20) for _ in range(20_000)])
    for size, wait in ((None, 500), (7, 500), (100, None)):
        table = batching.tabulate(us, np.array([0]), size, wait)
        nxt = batching.next_starts(us, np.array([0]), size, wait)
        assert len(table) <= (nxt - np.arange(len(us))).max() + 1


def test_no_group_is_larger_than_a_chunk(spark, monkeypatch):
    seen = []
    df = rows_df(spark, [f"a{i}" for i in range(300)])
    stored = []
    write = batching.materialize
    monkeypatch.setattr(batching, "materialize", lambda d, n: stored.append(write(d, n)) or stored[-1])
    for size, wait in ((None, "60s"), (7, "60s"), (7, "1s")):
        out = batch_rows(df, None, "ts", ["ts", "i"], size, wait, 10)
        got = [(r.i, r.batch_no) for r in out.collect()]
        assert sorted(got) == [(i, i // size if size else 0) for i in range(300)]
        ids = [r["_id"] for r in stored[-1].collect()]
        seen.append(max(np.unique([(i >> 33, (i & (1 << 33) - 1) // 10) for i in ids], axis=0,
                                  return_counts=True)[1]))
    assert max(seen) <= 10

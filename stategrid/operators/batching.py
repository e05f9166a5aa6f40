"""Count-or-wait batching per key, as an operator on any table.

A batch of a key opens at its first row and closes when it holds
``max_size`` rows or when a row arrives at or after ``open + max_wait``
(that row opens the next batch). Batches are numbered per key from 0 in
row order (``batch_no``); ``batch_start`` is the time of the batch's first
row.

The rows are range-partitioned and sorted once by (key, order), so that any
stretch of a busy key is spread over tasks, and written with an id that counts
up in that order. Ids make *chunks*: at most ``CHUNK_ROWS`` neighbouring rows,
whatever keys they belong to. All later work is per chunk or on a few rows per
chunk:

* count only (``batch_by_count``): the position of a row in its key is its id
  minus the key's first id in the partition, plus the rows of the key in the
  partitions before (a prefix sum over one row per key and partition).
* size or wait (``batch_rows``, ``batch_by_wait``): where a batch ends depends
  on where it opened, so a key's cuts are one chain. For a chunk, that chain is
  a function *open batch on entry -> open batch on exit, batches begun*: it
  depends only on the first row that opens a batch, which lies within one batch
  of the chunk's start. ``tabulate`` gets the chain's end from every such row by
  pointer jumping and writes one entry for each different end - a handful of
  rows, at most the rows of a batch. ``fold`` applies the functions of a key in
  order (one streaming pass over those entries) and gives each chunk its entry
  state; ``walk`` cuts each chunk from it. No group holds more than a chunk, and
  no step repeats until something converges.
* no key: all rows form one stream (constant key '').
* a row whose key is NULL cannot be routed: ``split_by_key`` returns it as an
  error row, the other rows go on. Here NULL is a key of its own.
* a NULL time counts as 1970-01-01.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from stategrid.operators.series import micros
from stategrid.session import materialize

DEFAULT_MAX_SIZE = 100
DEFAULT_MAX_WAIT = "60s"
CHUNK_ROWS = 1 << 16
_FAR = 1 << 62


def split_by_key(df: DataFrame, key: Column | str) -> tuple[DataFrame, DataFrame]:
    """(rows with a key in column ``_key``, rows whose key is NULL)."""
    k = F.col(key) if isinstance(key, str) else key
    staged = df.withColumn("_key", k)
    return staged.where(F.col("_key").isNotNull()), \
        staged.where(F.col("_key").isNull()).drop("_key").withColumn("reason", F.lit("no_key"))


def _in_order(df: DataFrame, key: str | None, order: Sequence[str], name: str) -> DataFrame:
    """The rows with ``_k`` (the key) and ``_id``, written in (key, order):
    ids count up along a partition, and partitions follow each other."""
    src = df.withColumn("_k", F.col(key).cast("string") if key else F.lit(""))
    by = ["_k", *order]
    return materialize(src.repartitionByRange(*by).sortWithinPartitions(*by)
                       .withColumn("_id", F.monotonically_increasing_id()), name)


def batch_by_count(df: DataFrame, key: str | None, order: Sequence[str],
                   max_size: int = DEFAULT_MAX_SIZE) -> DataFrame:
    """``batch_no`` = (position of the row in its key - 1) div max_size."""
    if max_size < 1:
        raise ValueError("max_size must be >= 1")
    rows = _in_order(df, key, order, "batch-positions").withColumn(
        "_part", F.shiftright("_id", 33))
    before = Window.partitionBy("_k").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_k", "_part").agg(F.min("_id").alias("_first"),
                                             F.count(F.lit(1)).alias("_n")).select(
        F.col("_k").alias("_sk"), F.col("_part").alias("_sp"),
        (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift"))
    on = F.col("_k").eqNullSafe(F.col("_sk")) & (F.col("_part") == F.col("_sp"))
    return (rows.join(starts, on)
            .withColumn("batch_no", F.floor((F.col("_id") + F.col("_shift")) / F.lit(max_size))
                        .cast("long"))
            .drop("_k", "_id", "_part", "_sk", "_sp", "_shift"))


# -- chunks as functions ---------------------------------------------------------------

def _runs(keys: np.ndarray) -> np.ndarray:
    """The first row of each key in a chunk."""
    codes = pd.factorize(keys, use_na_sentinel=False)[0]
    return np.concatenate(([0], np.flatnonzero(np.diff(codes)) + 1))


def next_starts(us: np.ndarray, runs: np.ndarray, size: int | None, wait: int | None) -> np.ndarray:
    """For each row: the row that opens the next batch if this one opens one;
    the end of its key's run at the latest. Gaps count up to the wait and keys
    lie one wait apart, so one search serves all keys."""
    n, far = len(us), wait or 1
    gap = np.minimum(np.diff(us, prepend=us[:1]), far) if wait else np.zeros(n, np.int64)
    gap[runs] = far
    t = np.cumsum(gap)
    nxt = np.searchsorted(t, t + far, side="left")
    return nxt if size is None else np.minimum(nxt, np.arange(n) + size)


def tabulate(us: np.ndarray, runs: np.ndarray, size: int | None, wait: int | None) -> list[tuple]:
    """(row, until_row, until_us, exit_us, exit_rows, begun) of the first key's
    function, by entry: it applies if the first opening row is at most
    ``until_row``. ``exit_us`` is None if no batch begins. The last entry,
    with row -1, is what the last key is left with, if it is another one."""
    nxt = next_starts(us, runs, size, wait)
    n = int(runs[1]) if len(runs) > 1 else len(us)
    jump = np.append(np.minimum(nxt[:n], n), n)
    last, begun = np.arange(n + 1), np.append(np.ones(n, np.int64), 0)
    while (on := jump < n).any():
        last = np.where(on, last[jump], last)
        begun, jump = begun + begun[jump], jump[jump]
    first = np.arange(min(int(nxt[0]), n - 1) + 1)      # where the first batch can begin
    ends = np.append(np.flatnonzero(np.diff(last[first]) | np.diff(begun[first])), first[-1])
    out = [(i, int(s), int(us[s]), int(us[last[s]]), n - int(last[s]), int(begun[s]))
           for i, s in enumerate(ends)]
    if nxt[0] >= n:
        out.append((len(out), _FAR, _FAR, None, n, 0))
    if len(runs) > 1:
        i, b = int(runs[-1]), 1
        while nxt[i] < len(us):
            i, b = int(nxt[i]), b + 1
        out.append((-1, _FAR, _FAR, int(us[i]), len(us) - i, b))
    return out


def cut(us: np.ndarray, runs: np.ndarray, size: int | None, wait: int | None,
        entry: tuple[int, int, int] | None) -> tuple[np.ndarray, np.ndarray]:
    """(batch number, batch start) of each row of a chunk; ``entry``: start,
    rows and number of batches of the open batch of the first key."""
    n, nxt = len(us), next_starts(us, runs, size, wait).tolist()
    end = int(runs[1]) if len(runs) > 1 else n
    i, start, before = 0, 0, 0
    if entry is not None:
        start, held, before = entry
        i = end if wait is None else int(np.searchsorted(us[:end], start + wait))
        i = i if size is None else min(i, size - held)
    opens = np.zeros(n, bool)
    while i < n:
        opens[i] = True
        i = nxt[i]
    count = np.cumsum(opens)
    base = np.repeat(count[runs], np.diff(np.append(runs, n)))
    base[:end] = 1 - before
    at = np.flatnonzero(opens)
    starts = np.where(count > 0, us[at[count - 1]] if len(at) else start, start)
    return count - base, starts


_TABLE = "_k string, _chunk long, row long, until_row long, until_us long, exit_us long, " \
         "exit_rows long, begun long"
_ENTRY = "_chunk long, _entry_us long, _entry_rows long, _entry_no long"


def _tabulate(size: int | None, wait: int | None):
    def run(chunk: pd.DataFrame) -> pd.DataFrame:
        chunk = chunk.sort_values("_id")
        keys = chunk["_k"].to_numpy()
        rows = tabulate(chunk["_us"].to_numpy(np.int64), _runs(keys), size, wait)
        out = pd.DataFrame(rows, columns=["row", "until_row", "until_us", "exit_us", "exit_rows",
                                          "begun"]).astype({"exit_us": "Int64"})
        out.insert(0, "_k", [keys[-1] if r[0] < 0 else keys[0] for r in rows])
        out.insert(1, "_chunk", chunk["_chunk"].iloc[0])
        return out
    return run


def _fold(size: int | None, wait: int | None):
    """The entry state of every chunk whose first key began before it, from the
    functions of all chunks in (key, chunk, row) order."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, chunk, state, applied = None, None, None, True
        for b in batches:
            out = []
            cols = [b["_k"].tolist(), *(b[c].tolist() for c in (
                "_chunk", "until_row", "until_us", "exit_us", "exit_rows", "begun"))]
            for k, c, until_row, until_us, exit_us, exit_rows, begun in zip(*cols):
                if chunk is None or k != key:
                    key, state, chunk = k, None, None
                if c != chunk:
                    chunk, applied = c, False
                    if state is not None:
                        out.append((c, *state))
                if applied or not (
                        state is None or (size is not None and until_row >= size - state[1])
                        or until_us >= (_FAR if wait is None else state[0] + wait)):
                    continue
                applied = True
                if pd.isna(exit_us):
                    state = (state[0], state[1] + exit_rows, state[2])
                else:
                    state = (int(exit_us), exit_rows, (state[2] if state else 0) + begun)
            yield pd.DataFrame(out, columns=["_chunk", "_entry_us", "_entry_rows", "_entry_no"])
    return run


def _walk(size: int | None, wait: int | None):
    def run(chunk: pa.Table) -> pa.Table:
        chunk = chunk.sort_by("_id")
        entry = [chunk[c][0].as_py() for c in ("_entry_us", "_entry_rows", "_entry_no")]
        no, start = cut(chunk["_us"].to_numpy(), _runs(chunk["_k"].to_pandas().to_numpy()), size,
                        wait, None if entry[0] is None else tuple(entry))
        return chunk.append_column("batch_no", pa.array(no, pa.int64())).append_column(
            "_start_us", pa.array(start, pa.int64()))
    return run


def batch_rows(df: DataFrame, key: str | None, ts: str, order: Sequence[str] | None = None,
               max_size: int | None = DEFAULT_MAX_SIZE, max_wait=DEFAULT_MAX_WAIT,
               chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Batches closed by size or by wait, whichever comes first.

    ``order`` (default: ``ts``) orders the rows of equal time in a key. Adds
    ``batch_no`` (per key, from 0) and ``batch_start``.
    """
    if max_size is not None and max_size < 1:
        raise ValueError("max_size must be >= 1")
    wait = micros(max_wait) if max_wait is not None else None
    src = df.withColumn("_us", F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(0)))
    rows = _in_order(src, key, ["_us", *[c for c in order or [] if c != ts]], "batch-rows")
    rows = rows.withColumn("_chunk", F.col("_id") - F.pmod(
        F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)), F.lit(chunk_rows)))
    functions = rows.select("_k", "_us", "_id", "_chunk").groupBy("_chunk").applyInPandas(
        _tabulate(max_size, wait), _TABLE)
    entries = functions.repartition("_k").sortWithinPartitions("_k", "_chunk", "row").mapInPandas(
        _fold(max_size, wait), _ENTRY)
    whole = rows.join(entries, "_chunk", "left")
    schema = T.StructType([*whole.schema.fields, T.StructField("batch_no", T.LongType()),
                           T.StructField("_start_us", T.LongType())])
    out = whole.groupBy("_chunk").applyInArrow(_walk(max_size, wait), schema)
    return out.withColumn("batch_start", F.timestamp_micros("_start_us")).drop(
        "_k", "_us", "_id", "_chunk", "_entry_us", "_entry_rows", "_entry_no", "_start_us")


def batch_by_wait(df: DataFrame, key: str | None, ts: str, max_wait=DEFAULT_MAX_WAIT,
                  order: Sequence[str] | None = None) -> DataFrame:
    """Batches anchored at their first row, closed ``max_wait`` later."""
    return batch_rows(df, key, ts, order, None, max_wait)

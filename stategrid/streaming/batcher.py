"""Count-or-wait batching on a stream (stateful, per key).

Rows of a key may arrive in any order within ``lateness`` of the newest one.
State per key: an ordered buffer of rows that may still get predecessors, and
the open batch with the time up to which the key is *sealed*. A row is sealed once the key's newest time is more than ``lateness``
past it; sealed rows are cut in (time, seq) order with the cut of the batch
operator and given out once, with their batch (``kind = 'row'``). A batch's
``close`` record (with its size) follows when a later batch opens, when it is
full, or when the sealed time reaches its start plus ``max_wait``.

Nothing is lost: a row older than the sealed time of its key comes out as
``late`` (the error output) and changes no batch. The watermark is kept per key
in the state because Spark's own leaves late rows out before they can be seen.

Open batches end in two ways. A processing-time timer ``idle`` after a key's
last row seals and closes all it holds. When the input has ended, ``drain``
reads what the stopped query's state still holds and gives out the same records
for it, so that the two outputs together hold every row exactly once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from stategrid.operators.batching import cut
from stategrid.operators.series import micros

OUTPUT = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("kind", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("batch_no", T.LongType()),
    T.StructField("batch_start", T.TimestampType()),
    T.StructField("size", T.LongType()),
])
#: The open batch (held 0: none open), batches so far, the key's sealed and newest times, and the
#: ordered buffer.
STATE = T.StructType([T.StructField(n, T.LongType()) for n in (
    "anchor", "held", "batch_no", "sealed", "newest")]
    + [T.StructField(n, T.ArrayType(T.LongType())) for n in ("us", "seq")])
_NEVER = -(1 << 62)


def _records(key, kind: str, seq, us, no, start, size) -> pd.DataFrame:
    n = len(no)
    time = lambda x: pd.to_datetime(pd.Series(x, dtype="Int64"), unit="us")
    return pd.DataFrame({"key": [key] * n, "kind": kind, "seq": pd.Series(seq, dtype="Int64"),
                         "ts": time(us), "batch_no": pd.Series(no, dtype="Int64"),
                         "batch_start": time(start), "size": pd.Series(size, dtype="Int64")})


def seal(key, us: np.ndarray, seq: np.ndarray, state: tuple, size: int | None, wait: int | None,
         upto: int) -> tuple[list[pd.DataFrame], tuple]:
    """The records of rows that are sealed, in order, and the open batch then;
    ``upto``: the key's sealed time."""
    anchor, held, no = state
    none = [None]
    out = []
    if len(us):
        nos, starts = cut(us, np.array([0]), size, wait, (anchor, held, no + 1) if held else None)
        if not held:
            nos = nos + no + 1
        out.append(_records(key, "row", seq, us, nos, starts, none * len(us)))
        ids, first, count = np.unique(nos, return_index=True, return_counts=True)
        count[0] += held if held and ids[0] == no else 0
        done = [(int(i), int(starts[f]), int(c)) for i, f, c in zip(ids, first, count)]
        if held and ids[0] != no:
            done.insert(0, (no, anchor, held))
        *done, (no, anchor, held) = done
    else:
        done = []
    if held and (held == size or (wait is not None and upto >= anchor + wait)):
        done.append((no, anchor, held))
        held = 0
    if done:
        n = len(done)
        i, a, c = zip(*done)
        out.append(_records(key, "close", none * n, none * n, i, a, c))
    return out, (anchor, held, no)


def _processor(size: int | None, wait: int | None, lateness: int, idle_ms: int | None):
    def fn(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        at, sealed, newest, old_us, old_seq = (0, 0, -1), _NEVER, _NEVER, [], []
        if state.exists:
            *at, sealed, newest, old_us, old_seq = state.get
        us, seq = np.array(old_us, np.int64), np.array(old_seq, np.int64)
        if state.hasTimedOut:
            sealed = newest + max(1, wait or 0)
        else:
            new = pd.concat(list(parts))
            new_us, new_seq = new["us"].to_numpy(np.int64), new["seq"].to_numpy(np.int64)
            late = new_us < sealed
            if late.any():
                none = [None] * int(late.sum())
                yield _records(key[0], "late", new_seq[late], new_us[late], none, none, none)
            us, seq = np.append(us, new_us[~late]), np.append(seq, new_seq[~late])
            newest = max(newest, int(us.max()) if len(us) else _NEVER)
            sealed = max(sealed, newest - lateness)
        order = np.lexsort((seq, us))
        us, seq = us[order], seq[order]
        n = int(np.searchsorted(us, sealed))
        out, at = seal(key[0], us[:n], seq[:n], tuple(at), size, wait, sealed)
        state.update((*map(int, at), int(sealed), int(newest), us[n:].tolist(), seq[n:].tolist()))
        if idle_ms is not None and not state.hasTimedOut:
            state.setTimeoutDuration(idle_ms)
        yield from out
    return fn


def batch_stream(sdf: DataFrame, key: str | None, ts: str, seq: str, *, lateness: str,
                 max_size: int | None = 100, max_wait="60s", idle: str | None = None) -> DataFrame:
    """Stream of rows with their batch, close records and late rows (schema
    ``OUTPUT``). ``seq`` identifies a row and orders rows of equal time. There
    is no default for ``lateness``: the caller states how far rows of a key may
    be out of order. ``idle`` closes keys that get no rows for so long."""
    wait = micros(max_wait) if max_wait is not None else None
    src = sdf.select(F.col(key).cast("string").alias("batch_key") if key else F.lit("").alias("batch_key"),
                     F.col(seq).cast("long").alias("seq"),
                     F.coalesce(F.unix_micros(F.col(ts).cast("timestamp")), F.lit(0)).alias("us"))
    return src.groupBy("batch_key").applyInPandasWithState(
        _processor(max_size, wait, micros(lateness), micros(idle) // 1000 if idle else None),
        OUTPUT, STATE, "append",
        GroupStateTimeout.ProcessingTimeTimeout if idle else GroupStateTimeout.NoTimeout)


def drain(spark: SparkSession, checkpoint: str, *, max_size: int | None = 100,
          max_wait="60s") -> DataFrame:
    """What a stopped query's state still holds, sealed and closed (schema
    ``OUTPUT``): the flush at the end of the input."""
    wait = micros(max_wait) if max_wait is not None else None

    held = spark.read.format("statestore").load(checkpoint).select(
        F.col("key.batch_key").alias("batch_key"), "value.groupState.*")

    def flush(key: tuple, opened: pd.DataFrame) -> pd.DataFrame:
        k = None if pd.isna(key[0]) else key[0]
        anchor, held, no, _, _, us, seq = opened[STATE.names].iloc[0]
        out, (anchor, held, no) = seal(k, np.array(us, np.int64), np.array(seq, np.int64),
                                       (int(anchor), int(held), int(no)), max_size, wait, _NEVER)
        if held:
            out.append(_records(k, "close", [None], [None], [no], [anchor], [held]))
        return pd.concat(out) if out else pd.DataFrame(columns=OUTPUT.names)

    return held.groupBy("batch_key").applyInPandas(flush, OUTPUT)

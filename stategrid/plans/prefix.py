"""Ordered-per-key computations that do not put a whole key in one task.

A plain ``Window.partitionBy(key).orderBy(...)`` sends every row of a key to
one task; one hot key holding a third of the data then serialises the job.
Both helpers here work in two levels instead:

1. rows are windowed per ``(key, bucket)`` where ``bucket`` is a coarse
   ordering column (e.g. the day of the timestamp), so a hot key is spread
   over as many tasks as it has buckets;
2. the last row of each ``(key, bucket)`` (found by ``lead`` in the same
   window, so the shuffled rows are reused, not re-read) forms a summary of
   one row per bucket; it is windowed per key to carry values / offsets
   across bucket edges and joined back on ``(key, bucket)`` (AQE broadcasts
   it when its measured size is small).

The bucket must be monotone in the order: every row of bucket b sorts before
every row of bucket b' > b inside a key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def _cols(cs) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _two_level(df: DataFrame, keys: list[str], order, bucket: Column, inner: dict,
               carry: dict, out: Column, out_name: str, drop: list[str]) -> DataFrame:
    """Shared plan: window per (key, bucket) computing ``inner`` columns, a
    summary of each bucket's last row carrying ``carry`` columns to later
    buckets of the key, and a join back."""
    w_in = Window.partitionBy(*keys, "_bkt").orderBy(*_cols(order))
    staged = df.withColumn("_bkt", bucket)
    staged = staged.select("*", *[c.over(w_in).alias(n) for n, c in inner.items()],
                           F.lead(F.lit(1)).over(w_in).isNull().alias("_is_last"))
    w_key = Window.partitionBy(*keys).orderBy("_bkt")
    summary = (staged.where(F.col("_is_last"))
                     .select(*keys, "_bkt", *[c(w_key).alias(n) for n, c in carry.items()]))
    return (staged.join(summary, [*keys, "_bkt"], "left")
                  .withColumn(out_name, out)
                  .drop("_bkt", "_is_last", *inner, *carry, *drop))


def lag_across(df: DataFrame, keys: Sequence[str], order: Sequence[str],
               value: Column, bucket: Column, out: str) -> DataFrame:
    """``out`` = ``value`` of the previous row of the same key (NULL for the
    first row), like ``lag(value) over (partition by keys order by order)``."""
    staged = df.withColumn("_val", value)
    return _two_level(
        staged, list(keys), order, bucket,
        inner={"_lag_in": F.lag("_val"), "_rn_in": F.row_number()},
        carry={"_carry": lambda w: F.lag("_val").over(w)},
        out=F.when(F.col("_rn_in") == 1, F.col("_carry")).otherwise(F.col("_lag_in")),
        out_name=out, drop=["_val"])


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                value: Column, bucket: Column, out: str) -> DataFrame:
    """``out`` = sum of ``value`` over the key's rows up to and including this
    one, like ``sum(value) over (partition by keys order by order rows
    unbounded preceding)``."""
    staged = df.withColumn("_x", value)
    return _two_level(
        staged, list(keys), order, bucket,
        inner={"_rs_in": F.sum("_x")},
        carry={"_off": lambda w: F.coalesce(F.sum("_rs_in").over(
            w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))},
        out=F.coalesce(F.col("_off"), F.lit(0)) + F.col("_rs_in"),
        out_name=out, drop=["_x"])


def index_across(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 bucket: Column, out: str) -> DataFrame:
    """``out`` = 1-based position of the row inside its key, like
    ``row_number() over (partition by keys order by order)``."""
    return _two_level(
        df, list(keys), order, bucket,
        inner={"_rn_in": F.row_number()},
        carry={"_off": lambda w: F.coalesce(F.sum("_rn_in").over(
            w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))},
        out=F.coalesce(F.col("_off"), F.lit(0)) + F.col("_rn_in"),
        out_name=out, drop=[])

"""Pipeline counters as queries: what the ingest job counts, computed from
its inputs and outputs with aggregates (partial aggregation before any
shuffle; a hot key costs one row per task).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stategrid.operators.series import histogram
from stategrid.schema import REJECT_REASONS


#: Reasons of frames that never reach the received counter.
NOT_RECEIVED = ["bad_frame", "unknown_type", "not_event", "no_id"]


def is_received() -> Column:
    """Event frames that decode and carry an id (columns ``type``, ``reason``)."""
    return (F.col("type") == "event") & ~F.coalesce(F.col("reason").isin(NOT_RECEIVED),
                                                    F.lit(False))


def ingest_counters(staged: DataFrame) -> DataFrame:
    """received, filtered, processed and rejected-by-reason from frames that
    carry ``reason`` (``operators.states.with_reason``): one aggregate pass,
    long output ``(counter, value)``."""
    is_event = is_received()
    r = F.col("reason")
    aggs = [F.count_if(is_event).alias("received"),
            F.count_if(is_event & (r == "event_type")).alias("filtered"),
            F.count_if(r.isNull()).alias("processed")]
    aggs += [F.count_if(r == name).alias(f"rejected_{name}") for name in REJECT_REASONS]
    wide = staged.agg(*aggs)
    names = [a for a in ["received", "filtered", "processed"]] + [f"rejected_{n}" for n in REJECT_REASONS]
    stack = F.array(*[F.struct(F.lit(n).alias("counter"), F.col(n).alias("value")) for n in names])
    return wide.select(F.inline(stack))


def batch_counters(batches: DataFrame, key: Sequence[str] = ("domain",),
                   batch: str = "batch_no") -> DataFrame:
    """Number of batches and batch sizes per key."""
    sizes = batches.groupBy(*key, batch).agg(F.count(F.lit(1)).alias("_size"))
    return sizes.groupBy(*key).agg(
        F.count(F.lit(1)).alias("batches"), F.sum("_size").alias("rows"),
        F.min("_size").alias("min_size"), F.max("_size").alias("max_size"))


def labelled_counter(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Count per label set."""
    return df.groupBy(*labels).agg(F.count(F.lit(1)).alias("value"))


def histogram_by_label(df: DataFrame, value: str, bounds: Sequence[float],
                       label: str) -> DataFrame:
    return histogram(df, value, bounds, by=[label])


def sum_by(df: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    return df.groupBy(*by).agg(F.sum(value).alias(value))


def max_by_label(df: DataFrame, by: Sequence[str], value: str = "value") -> DataFrame:
    return df.groupBy(*by).agg(F.max(value).alias(value))

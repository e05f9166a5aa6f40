"""Two-level per-key computations equal the plain windows, also when one key
holds every row (the hot-key case they exist for)."""

import os

import pytest
from pyspark.sql import Window, functions as F

from stategrid.plans.prefix import index_across, lag_across, running_sum

from conftest import SF


@pytest.fixture(scope="module")
def events(spark):
    return spark.read.parquet(os.path.join(SF["0.01"], "events.parquet"))


@pytest.mark.parametrize("key", ["hot", "event_type", "user_id"])
def test_two_level_equals_plain_window(spark, events, key):
    df = events.withColumn("hot", F.lit("all"))
    order = ["ts", "event_id"]
    day = F.date_trunc("day", F.col("ts"))
    w = Window.partitionBy(key).orderBy(*order)
    plain = df.select("event_id", F.lag("value").over(w).alias("lag"),
                      F.row_number().over(w).alias("idx"),
                      F.sum(F.floor("value")).over(w.rowsBetween(Window.unboundedPreceding, 0))
                      .alias("rs"))
    two = lag_across(df, [key], order, F.col("value"), day, "lag")
    two = index_across(two, [key], order, day, "idx")
    two = running_sum(two, [key], order, F.floor("value"), day, "rs")
    got = {r.event_id: (r.lag, r.idx, r.rs) for r in two.select("event_id", "lag", "idx", "rs").collect()}
    exp = {r.event_id: (r.lag, r.idx, r.rs) for r in plain.collect()}
    assert got == exp

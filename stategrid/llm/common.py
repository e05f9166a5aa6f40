"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stategrid.session import checkpoint_dir

#: ASCII white space, and the ASCII case mapping.
WHITE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder's path under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def release_memory() -> None:
    """Gives back what a Python worker has freed but still holds: Spark keeps
    workers for later tasks, and theirs is an executor's memory."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):     # of glibc
        trim(0)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places starts[i] to starts[i] + sizes[i], one range after another."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)


def key128(c: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of one value: together a 128-bit key, so
    that distinct values of even 10^12 rows do not meet by chance."""
    return F.xxhash64(c), F.xxhash64(F.lit(1), c)


def let(value: Column, body):
    """``body(value)`` with the value evaluated once per row, also where the
    body uses it inside the lambda of another array function."""
    return F.transform(F.array(value), body).getItem(0)


def set_aside(docs: DataFrame, keep: tuple[str, ...] = ("doc_id", "text")) -> DataFrame:
    """``docs`` with all columns but ``keep`` in one struct ``rest``: whatever
    they are called, they meet no column of an operator. An input column
    ``rest`` is in the struct as well."""
    others = [F.col("`" + c.replace("`", "``") + "`").alias(c) for c in docs.columns if c not in keep]
    return docs.select(*[c for c in docs.columns if c in keep],
                       F.struct(*(others or [F.lit(0).alias("none")])).alias("rest"))


def put_back(columns: list[str], keep: tuple[str, ...] = ("doc_id", "text")) -> list[Column]:
    """Columns as they were before ``set_aside``."""
    return [F.col(c) if c in keep else F.col("rest").getField(c).alias(c) for c in columns]


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, keys: list[str], order: list, name: str, buckets: int,
           salt: Column) -> DataFrame:
    """Adds ``name``: a gapless position from 0 among the rows of equal
    ``keys`` (null keys are equal), any number of rows to a key. Rows are
    numbered within (keys, salt bucket); the buckets of a key start where the
    buckets before them end, from a table of one count per (keys, bucket)."""
    from pyspark.sql import Window
    df = df.withColumn("_salt", F.pmod(F.xxhash64(salt), F.lit(buckets)).cast("int"))
    counts = df.groupBy(*keys, "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_salt").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = counts.select(*[F.col(k).alias(f"_k_{k}") for k in keys],
                           F.col("_salt").alias("_s"),
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    local = df.withColumn("_local", F.row_number().over(
        Window.partitionBy(*keys, "_salt").orderBy(*order)) - 1)
    on = F.col("_salt") == F.col("_s")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    return (local.join(starts, on, "inner")
            .withColumn(name, (F.col("_start") + F.col("_local")).cast("long"))
            .drop("_salt", "_s", "_start", "_local", *[f"_k_{k}" for k in keys]))

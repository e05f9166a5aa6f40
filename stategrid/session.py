"""Session helpers.

The library needs the session time zone pinned to UTC (every stored time is a
UTC instant, and ``timestamp -> timestamp_ntz`` casts must give UTC wall time).
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "stategrid",
                shuffle_partitions: int | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings the library relies on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
          .config("spark.driver.memory", os.environ.get("STATEGRID_DRIVER_MEMORY", "8g"))
          .config("spark.sql.session.timeZone", "UTC")
          .config("spark.sql.adaptive.enabled", "true")
          .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
          .config("spark.sql.adaptive.skewJoin.enabled", "true")
          .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_utc(spark)
    ensure_small_methods(spark)
    return spark


def ensure_utc(spark: SparkSession) -> None:
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


#: Fixed value: the bytecode of a method up to which the JVM compiles it.
METHOD_BYTES = "8000"


def ensure_small_methods(spark: SparkSession) -> None:
    """Plans whose fused code would hold a longer method run operator by
    operator, in methods that the JVM compiles; a longer one stays interpreted
    for all rows (the frames' rules with their decoding are 17,596 bytes)."""
    key = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(key)) > int(METHOD_BYTES):
        spark.conf.set(key, METHOD_BYTES)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set (a shared file system). Only when it is
    unset - local runs and tests - a scratch folder is made and registered.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master or ""
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder of the cluster")
        d = tempfile.mkdtemp(prefix="stategrid-ckpt-")      # local runs and tests only
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path under the shared checkpoint dir."""
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


def materialize(df, name: str):
    """Write ``df`` as a Parquet table under the shared checkpoint folder and
    read it back: cuts the lineage (a lost executor re-reads the table
    instead of recomputing the plan), and later narrow reads prune columns.
    Used where one intermediate feeds several branches of a plan."""
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.parquet(path)


def session_cached(fn):
    """Cache a Column-building function per Spark application.

    Column expressions that refer to columns by name do not depend on a
    DataFrame; building them costs one JVM round trip per literal and
    operator, so rule sets are built once per application and reused."""
    import functools

    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args):
        from pyspark import SparkContext
        sc = SparkContext._active_spark_context
        key = (sc.applicationId if sc is not None else None, args)
        if key not in cache:
            cache[key] = fn(*args)
        return cache[key]
    return wrapper

"""Metrics of a running ingest stream, as samples for the rules and panels.

What happens is kept as *observations* beside the store, one row per counter
or measured duration (``OBSERVATION``):

* ``<root>/_observations/batch=N``: what micro-batch N counted and how long
  its inserts took, overwritten with the batch, so a replay replaces its own
  counts. The counts are an aggregate over the persisted batch: a stream-level
  ``observe`` runs once per action on the batch frame and would count a row
  as often as the batch is read.
* ``<root>/_operations``: operations that belong to no finished batch - table
  creations and failed inserts - and the duration of every micro-batch, which
  ``BatchDurations`` (a query listener) reads from the stream's progress.

``metric_samples`` turns them into scraped counters: each series starts with a
zero one step before its first observation and has a sample at every step up
to the run's last one.
"""

from __future__ import annotations

import datetime as dt
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from stategrid.operators.series import seconds, step_of
from stategrid.plans.alerts import BATCH_SIZE_BOUNDS, PREFIX

OBSERVATION = ("at timestamp, kind string, metric string, operation string, status string, "
               "query_type string, value double")
_LABELS = ("operation", "status", "query_type", "le")

# Duration buckets (seconds) of the source system's histograms.
DURATION_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1.0, 2.5, 5.0, 10.0]

#: Histogram metrics (without prefix) and their bounds.
HISTOGRAMS = {"batch_size": BATCH_SIZE_BOUNDS,
              "batch_processing_duration_seconds": DURATION_BOUNDS,
              "store_query_duration_seconds": DURATION_BOUNDS}


def now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def counted(metric: str, value: float, operation: str = "", status: str = "") -> tuple:
    """A counter's increment."""
    return (now(), "counter", metric, operation, status, "", float(value))


def measured(metric: str, value: float, query_type: str = "") -> tuple:
    """One observation of a histogram."""
    return (now(), "histogram", metric, "", "", query_type, float(value))


def write_observations(spark: SparkSession, root: str, rows: list[tuple],
                       batch_id: int | None = None) -> None:
    """Keep observations (a handful per call): with ``batch_id`` as those of
    that micro-batch, in place of what an earlier try of it left; else added."""
    if not rows:
        return
    df = spark.createDataFrame(rows, OBSERVATION).coalesce(1)
    if batch_id is None:
        df.write.mode("append").parquet(f"{root}/_operations")
    else:
        df.write.mode("overwrite").parquet(f"{root}/_observations/batch={int(batch_id)}")


def read_observations(spark: SparkSession, root: str) -> DataFrame:
    """All observations below ``root``. Either folder may be absent."""
    out = spark.createDataFrame([], OBSERVATION)
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in ("_observations", "_operations"):
        path = jvm.org.apache.hadoop.fs.Path(f"{root}/{folder}")
        if path.getFileSystem(conf).exists(path):
            out = out.unionByName(spark.read.schema(OBSERVATION).parquet(f"{root}/{folder}")
                                  .select(*out.columns))
    return out


def metric_samples(observations: DataFrame, step="30s", prefix: str = PREFIX) -> DataFrame:
    """``ts, metric, labels, value`` samples of the observed counters and
    histograms (``_bucket`` by ``le``, ``_sum``, ``_count``), every step.

    One aggregate to (series, step), then a running sum over the steps of a
    series; null values count as nothing, no observations give no samples."""
    s = seconds(step)
    value = F.coalesce(F.col("value"), F.lit(0.0))

    def series(metric, le, added):
        return F.struct(metric.alias("metric"), le.alias("le"), added.alias("added"))

    def buckets(metric: str, bounds: list[float]):
        name = F.lit(prefix + metric)
        edges = [(f"{b:g}", b) for b in bounds] + [("+Inf", float("inf"))]
        parts = [series(F.concat(name, F.lit("_bucket")), F.lit(text),
                        (value <= F.lit(b)).cast("double")) for text, b in edges]
        parts.append(series(F.concat(name, F.lit("_sum")), F.lit(""), value))
        parts.append(series(F.concat(name, F.lit("_count")), F.lit(""), F.lit(1.0)))
        return F.array(*parts)

    expanded = F.array(series(F.concat(F.lit(prefix), "metric"), F.lit(""), value))
    for metric, bounds in HISTOGRAMS.items():
        expanded = F.when((F.col("kind") == "histogram") & (F.col("metric") == metric),
                          buckets(metric, bounds)).otherwise(expanded)
    keys = ["metric", *_LABELS]
    b = (observations.where(F.col("at").isNotNull())
         .select(step_of(F.col("at"), step).alias("t_sec"),
                 *[F.coalesce(c, F.lit("")).alias(c) for c in ("operation", "status", "query_type")],
                 F.inline(expanded))
         .groupBy(*keys, "t_sec").agg(F.sum("added").alias("added")))
    ends = b.groupBy(*keys).agg(F.min("t_sec").alias("lo"))
    last = b.agg(F.max("t_sec").alias("hi"))                # one row
    span = ends.join(F.broadcast(last)).select(
        *keys, F.explode(F.sequence(F.col("lo") - s, "hi", F.lit(s))).alias("t_sec"))
    w = Window.partitionBy(*keys).orderBy("t_sec").rowsBetween(Window.unboundedPreceding, 0)
    dense = span.join(b, [*keys, "t_sec"], "left").withColumn(
        "value", F.sum(F.coalesce("added", F.lit(0.0))).over(w))
    labels = F.map_filter(F.create_map(*[x for k in _LABELS for x in (F.lit(k), F.col(k))]),
                          lambda k, v: v != "")
    return dense.select(F.timestamp_seconds("t_sec").alias("ts"), "metric",
                        labels.alias("labels"), "value")


class BatchDurations(StreamingQueryListener):
    """Writes the duration of every micro-batch of one stream to ``root``.

    ``name`` is the stream's query name; other streams of the session are not
    listened to. ``wait`` returns once the stream's end has been heard (events
    arrive after the query itself has stopped)."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        self.name = f"ingest-{uuid.uuid4().hex}"
        self._id = None
        self._ended = threading.Event()

    def onQueryStarted(self, event) -> None:
        if event.name == self.name:
            self._id = event.id

    def onQueryProgress(self, event) -> None:
        p = event.progress
        if p.name != self.name or not p.numInputRows:
            return
        took = p.durationMs.get("triggerExecution")
        if took is not None:
            write_observations(self.spark, self.root, [
                measured("batch_processing_duration_seconds", took / 1000.0)])

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if event.id == self._id:
            self._ended.set()

    def wait(self, timeout: float = 60.0) -> bool:
        return self._ended.wait(timeout)

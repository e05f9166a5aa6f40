"""The ingest pipeline as a Structured Streaming query.

``stream_changes`` reads text frames continuously, and for every micro-batch
decodes them once, splits stored changes from rejects by one reason column
(persisted once), writes the changes to the type-group datasets and the
rejects beside them. Both writes are keyed by the micro-batch id (dynamic
partition overwrite), so a batch replayed after a failure replaces its own
output instead of appending twice. What a batch counted is kept the same way
(``streaming.metrics``). Progress lives in the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from stategrid.operators.counters import ingest_counters
from stategrid.operators.states import change_or_null, with_reason
from stategrid.schema import TYPE_GROUPS
from stategrid.sinks.store import ensure_group_table, write_changes
from stategrid.sources.frames import decode_frames, event_log, read_frames
from stategrid.streaming.metrics import BatchDurations, counted, measured, write_observations


def process_batch(frames_text: DataFrame, batch_id: int, out_root: str,
                  database: str = "home", absent_ts: str = "epoch") -> None:
    """One micro-batch (also usable on a static DataFrame of text frames)."""
    # Arrival order: (batch, seq); both are stored, so they never collide.
    frames = decode_frames(frames_text.select(
        F.col("raw"), F.monotonically_increasing_id().alias("seq")))
    # kept for the writes: the record and what the rejects and counters need, not the frame
    staged = with_reason(frames, database).select(
        "seq", "id", "type", F.col("event.event_type").alias("event_type"), "reason",
        change_or_null(database, absent_ts).alias("change")).persist()
    spark = frames_text.sparkSession
    try:
        kept = staged.where(F.col("reason").isNull()).select("change.*")
        try:
            written = write_changes(kept, out_root, batch_id=batch_id)
        except Exception:
            write_observations(spark, out_root, [
                counted("database_operations_total", 1, "insert", "error")])
            raise
        rej = staged.where(F.col("reason").isNotNull()).select(
            "seq", "id", "type", "event_type", "reason",
            F.lit(int(batch_id)).cast("long").alias("batch"))
        (rej.write.partitionBy("batch").mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").parquet(f"{out_root}/_rejects"))
        seen = dict(ingest_counters(staged).collect())       # one row per counter
        write_observations(spark, out_root, [
            *[counted(f"events_{c}_total", seen[c]) for c in ("received", "filtered", "processed")],
            *[x for _, rows, took in written for x in (
                counted("batches_processed_total", 1),
                counted("database_operations_total", 1, "insert", "success"),
                measured("batch_size", rows),
                measured("store_query_duration_seconds", took, "insert"))]], batch_id)
    finally:
        staged.unpersist()


def ensure_tables(spark: SparkSession, database: str, out_root: str) -> None:
    """The tables of all type groups, each creation counted as an operation."""
    made = []
    for g in TYPE_GROUPS:
        try:
            _, created = ensure_group_table(spark, database, g, out_root)
        except Exception:
            write_observations(spark, out_root, [
                counted("database_operations_total", 1, "create_table", "error")])
            raise
        made += [counted("database_operations_total", 1, "create_table", "success")] * created
    write_observations(spark, out_root, made)


def stream_changes(spark: SparkSession, in_path: str, out_root: str, checkpoint: str,
                   trigger: str = "availableNow", database: str = "home",
                   max_files_per_trigger: int | None = None,
                   durations: BatchDurations | None = None) -> StreamingQuery:
    """Start the continuous pipeline. ``trigger`` is 'availableNow' (drain and
    stop) or a processing-time interval such as '1 second'. The store's tables
    are made first. ``durations``, a listener added to the session
    (``spark.streams.addListener``), keeps how long each micro-batch took."""
    ensure_tables(spark, database, out_root)
    raw = read_frames(spark, in_path, streaming=True, max_files_per_trigger=max_files_per_trigger)
    w = (raw.writeStream.foreachBatch(
            lambda df, bid: process_batch(df, bid, out_root, database))
         .option("checkpointLocation", checkpoint))
    if durations is not None:
        w = w.queryName(durations.name)
    w = w.trigger(availableNow=True) if trigger == "availableNow" else w.trigger(processingTime=trigger)
    return w.start()


def dump_events(spark: SparkSession, in_path: str, checkpoint: str | None = None,
                truncate: bool = False) -> StreamingQuery:
    """Debug listing of every event (type, entity, indented JSON) to the console."""
    raw = read_frames(spark, in_path, streaming=True)
    frames = decode_frames(raw.withColumn("seq", F.lit(0).cast("long")))
    w = event_log(frames).writeStream.format("console").option("truncate", str(truncate).lower())
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    return w.trigger(availableNow=True).start()

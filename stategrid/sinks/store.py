"""Parquet tables of state changes, partitioned by domain and month.

The state column has one of five Spark types, so instead of one table per
domain (one insert per domain) there is one dataset per *type group*
(bool, string, double, bigint, timestamp) under ``<root>/<group>``, each
``partitionBy("domain", "month", "batch")`` with a catalog table of fixed
columns, which exists before the first row (``ensure_table``); a per-domain
view filters its dataset (the filter prunes to the domain's directories). A
micro-batch is written with at most five writes, never a loop over domains.

Idempotence: with a ``batch_id`` the write uses dynamic partition overwrite,
so replaying a batch replaces exactly what it wrote before.
"""

from __future__ import annotations

import re
import time
import zlib

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stategrid.functions.values import format_rfc3339
from stategrid.schema import DOMAIN_PATTERN, GROUP_SPARK_TYPE, TYPE_GROUPS, domains_of_group

_GROUP_STATE = {
    "bool": ("state_bool", "old_state_bool"),
    "string": ("state_text", "old_state_text"),
    "double": ("state_double", "old_state_double"),
    "bigint": ("state_long", "old_state_long"),
    "timestamp": ("state_time", "old_state_time"),
}

STORED_COLUMNS = ["entity_id", "state", "old_state", "attributes", "context",
                  "last_changed", "last_updated", "last_reported", "seq", "received_at"]


#: Partition columns of every dataset, and the batch of rows written outside a stream.
PARTITIONS = ["domain", "month", "batch"]
NO_BATCH = -1


def with_month(df: DataFrame, ts: str = "last_updated") -> DataFrame:
    """Partition value YYYYMM of ``ts`` (UTC)."""
    c = F.col(ts)
    return df.withColumn("month", (F.year(c) * 100 + F.month(c)).cast("int"))


def cluster_changes(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned and sorted by (domain, month, entity_id,
    last_updated): each output file holds a sorted slice of the store's sort
    key, so Parquet min/max statistics skip well. Range bounds come from a
    sample, so a hot domain - or one hot entity - is split over many tasks
    instead of landing in one."""
    keys = ["domain", "month", "entity_id", "last_updated"]
    out = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    return out.sortWithinPartitions(*keys)


def group_rows(changes: DataFrame, group: str) -> DataFrame:
    """The rows of one type group with their pair renamed to state/old_state."""
    new, old = _GROUP_STATE[group]
    extra = ["batch"] if "batch" in changes.columns else []
    received = F.col("received_at") if "received_at" in changes.columns else \
        F.date_trunc("millisecond", F.current_timestamp())
    return changes.where(F.col("type_group") == group).select(
        "entity_id", F.col(new).alias("state"), F.col(old).alias("old_state"),
        "attributes", "context", "last_changed", "last_updated", "last_reported", "seq",
        received.alias("received_at"), "domain", "month", *extra)


def write_changes(changes: DataFrame, root: str, batch_id: int | None = None,
                  partitions: int | None = None,
                  max_records_per_file: int = 5_000_000) -> list[tuple[str, int, float]]:
    """Append stored changes to the type-group datasets under ``root``.

    Empty input writes nothing. The input is persisted once for the five
    filtered writes. Returns a (group, rows, seconds) for every write. Rows
    written without a ``batch_id`` are in batch ``NO_BATCH``."""
    df = changes
    if "received_at" not in df.columns:
        df = df.withColumn("received_at", F.date_trunc("millisecond", F.current_timestamp()))
    if batch_id is not None or "batch" not in df.columns:
        df = df.withColumn("batch", F.lit(NO_BATCH if batch_id is None else int(batch_id)).cast("long"))
    df = cluster_changes(df, partitions).persist()
    written = []
    try:
        rows = dict(df.groupBy("type_group").count().collect())   # <= 5 groups
        for g in TYPE_GROUPS:
            if g not in rows:
                continue
            w = (group_rows(df, g).write.partitionBy(*PARTITIONS)
                 .option("maxRecordsPerFile", max_records_per_file))
            start = time.monotonic()
            if batch_id is not None:
                w.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(f"{root}/{g}")
            else:
                w.mode("append").parquet(f"{root}/{g}")
            written.append((g, rows[g], time.monotonic() - start))
    finally:
        df.unpersist()
    return written


def read_group(spark: SparkSession, root: str, group: str, months: list[int] | None = None) -> DataFrame:
    """One type-group dataset; give ``months`` to prune partitions."""
    df = spark.read.parquet(f"{root}/{group}")
    if months:
        df = df.where(F.col("month").isin(*months))
    return df


def group_ddl(group: str) -> str:
    """The fixed columns of a type-group dataset, partition columns last."""
    state = GROUP_SPARK_TYPE[group].simpleString()
    return (f"entity_id string, state {state}, old_state {state}, attributes string, "
            "context string, last_changed timestamp, last_updated timestamp, "
            "last_reported timestamp, seq bigint, received_at timestamp, "
            "domain string, month int, batch bigint")


def ensure_group_table(spark: SparkSession, database: str, group: str, root: str) -> tuple[str, bool]:
    """Create (if absent) the catalog table over a type-group dataset, whether
    it has data yet or not. Returns its name and whether it was created.

    Columns are fixed by ``group_ddl``; partitions are found by listing at
    read time, not kept in the catalog, so rows that a stream writes by path
    need no registration (a session that has read the table calls this again,
    or ``REFRESH TABLE``, to see them). Tables of several roots in one
    database differ in the suffix."""
    if not re.fullmatch(r"[a-z0-9_]+", database) or group not in TYPE_GROUPS:
        raise ValueError(f"bad name {database}.{group}")
    db = f"{database}__store"
    name = f"{db}.{group}_{zlib.crc32(root.encode()):08x}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    created = not spark.catalog.tableExists(name)
    if created:
        key = "spark.sql.hive.manageFilesourcePartitions"
        before = spark.conf.get(key)
        spark.conf.set(key, "false")
        try:
            path = f"{root}/{group}".replace("\\", "\\\\").replace("'", "\\'")
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({group_ddl(group)}) USING parquet "
                      f"PARTITIONED BY ({', '.join(PARTITIONS)}) LOCATION '{path}'")
        finally:
            spark.conf.set(key, before)
    spark.catalog.refreshTable(name)
    return name, created


def ensure_table(spark: SparkSession, database: str, domain: str, root: str) -> str:
    """Create (if absent) the table of a domain's type group and a view of the
    domain's rows, before or after any are written. Returns the view's name,
    which stands for the latest ``root`` it was made for.

    Names are checked (no SQL pasted from data)."""
    if not re.fullmatch(DOMAIN_PATTERN.strip("^$"), domain) or not re.fullmatch(r"[a-z0-9_]+", database):
        raise ValueError(f"bad name {database}.{domain}")
    group = next((g for g in TYPE_GROUPS if domain in domains_of_group(g)), "string")
    table, _ = ensure_group_table(spark, database, group, root)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    spark.sql(f"CREATE OR REPLACE VIEW {database}.{domain} AS "
              f"SELECT * FROM {table} WHERE domain = '{domain}'")
    return f"{database}.{domain}"


def to_json_rows(changes: DataFrame) -> DataFrame:
    """One JSON object per row (column ``value``) of
    ``operators.states.wire_changes``, fields in the stored order; nulls are
    written, ``last_reported`` is left out when absent. Times are RFC 3339
    text; the state is a JSON bool in the boolean domains, else a string."""
    return changes.select(json_row_column().alias("value"))


def json_row_column() -> Column:
    """The JSON line of a wire row (see ``to_json_rows``)."""

    def state(c: str) -> Column:
        return F.when(F.col("is_bool"), js(c)).otherwise(q(F.col(c)))

    def q(c: Column) -> Column:
        # JSON string literal of c: to_json of a one-element array, brackets cut.
        arr = F.to_json(F.array(c))
        return F.when(c.isNull(), F.lit("null")).otherwise(
            F.regexp_extract(arr, r"^\[(.*)\]$", 1))

    def ts(c: str) -> Column:
        return q(format_rfc3339(F.col(c)))

    def js(c: str) -> Column:
        return F.coalesce(F.col(c), F.lit("null"))

    body = F.concat(
        F.lit('{"entity_id":'), q(F.col("entity_id")),
        F.lit(',"state":'), state("state"),
        F.lit(',"old_state":'), state("old_state"),
        F.lit(',"attributes":'), js("attributes"),
        F.lit(',"context":'), js("context"),
        F.lit(',"last_changed":'), ts("last_changed"),
        F.lit(',"last_updated":'), ts("last_updated"),
        F.when(F.col("last_reported").isNotNull(),
               F.concat(F.lit(',"last_reported":'), ts("last_reported"))).otherwise(F.lit("")),
        F.lit("}"))
    return body


def write_json_rows(changes: DataFrame, path: str) -> None:
    """JSON lines under ``path`` (one file per task)."""
    to_json_rows(changes).write.mode("append").text(path)

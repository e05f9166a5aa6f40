"""Line deduplication over levelled, sorted runs of line hashes.

The corpus goes through in batches, from the largest document ids down. A
batch's line keys are counted, merge-anti-joined with the runs written so far
(what no run holds is new: its largest document here is the keeper of the
whole corpus), and written as a run of its own, sorted by hash. When a level
has ``fanout`` runs they are merged into one run of the next level. What the
runs say of a line after the last batch - in how many documents, and which is
the largest - decides about every line; a second narrow join marks the lines
to drop per document.

Rules: a row is a document. Null and empty texts are one empty line. Rows
with a null id rank below every id; rows that share the largest id all keep
the line. A line repeated inside a document counts once and is dropped or
kept as a whole. An empty table gives an empty result. Further columns pass
through under any name; those called like a result (``_n_lines``,
``_n_dropped``, ``_kept``) give way to it.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stategrid.llm.common import LOWER, UPPER, WHITE, key128, put_back, set_aside
from stategrid.session import scratch_path

H = ["h1", "h2"]
RESULTS = ["_n_lines", "_n_dropped", "_kept"]


def line_key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(WHITE)), UPPER, LOWER)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


class LineRuns:
    """Levelled runs (h1, h2, docs, keeper), each sorted by hash and holding a
    line once. ``docs`` adds up over runs; ``keeper`` is set only in the run
    of the batch that held the line first."""

    def __init__(self, spark, fanout: int = 3):
        self.spark, self.fanout, self.levels = spark, fanout, [[]]
        self.path = scratch_path(spark, f"line-runs-{uuid.uuid4().hex}")
        self.written = 0

    def _write(self, df: DataFrame) -> DataFrame:
        self.written += 1
        path = f"{self.path}/run-{self.written}"
        df.sortWithinPartitions(*H).write.parquet(path)
        return self.spark.read.parquet(path)

    def all(self) -> DataFrame | None:
        runs = [r for level in self.levels for r in level]
        return reduce(DataFrame.unionByName, runs) if runs else None

    def merged(self, runs: DataFrame) -> DataFrame:
        return runs.groupBy(*H).agg(F.sum("docs").alias("docs"), F.max("keeper").alias("keeper"))

    def add(self, keys: DataFrame) -> None:
        """keys: (h1, h2, docs, keeper), a line once."""
        held = self.all()
        if held is not None:
            held = held.select(*H).hint("merge")
            fresh = keys.join(held, H, "left_anti")
            again = keys.join(held, H, "left_semi").withColumn(
                "keeper", F.lit(None).cast("long"))
            keys = fresh.unionByName(again)
        self.levels[0].append(self._write(keys.repartition(*H)))
        level = 0
        while len(self.levels[level]) >= self.fanout:       # compaction
            run = self._write(self.merged(reduce(DataFrame.unionByName, self.levels[level])))
            self.levels[level] = []
            level += 1
            if level == len(self.levels):
                self.levels.append([])
            self.levels[level].append(run)


def dedup_lines(docs: DataFrame, min_chars: int = 40, min_docs: int = 5,
                batches: int = 3, fanout: int = 3) -> DataFrame:
    """``docs`` with ``_n_lines``, ``_n_dropped`` and ``_kept`` (the text that
    stays). Lines whose key has ``min_chars`` code points and occurs in
    ``min_docs`` documents stay only in the largest doc_id."""
    spark = docs.sparkSession
    through = [c for c in docs.columns if c not in RESULTS]
    docs = set_aside(docs.select(*["`" + c.replace("`", "``") + "`" for c in through]))
    key = F.array_distinct(F.filter(F.transform(lines_of(F.col("text")), line_key),
                                    lambda k: F.length(k) >= min_chars))
    h1, h2 = key128(F.col("_key"))
    bounds = sorted(set(docs.select(F.col("doc_id").cast("long").alias("doc_id")).approxQuantile(
        "doc_id", [i / batches for i in range(1, batches)], 0.01)))
    batch = F.lit(0)
    for i, b in enumerate(bounds):
        batch = F.when(F.col("doc_id") > int(b), F.lit(i + 1)).otherwise(batch)
    path = scratch_path(spark, f"line-keys-{uuid.uuid4().hex}")
    (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode(key).alias("_key"))
     .select("doc_id", h1.alias("h1"), h2.alias("h2"),
             F.coalesce(batch, F.lit(0)).alias("batch"))
     .write.partitionBy("batch").parquet(path))
    keys = spark.read.schema("doc_id long, h1 long, h2 long, batch int").parquet(path)
    runs = LineRuns(spark, fanout)
    for i in range(len(bounds), -1, -1):
        runs.add(keys.where(F.col("batch") == i).groupBy(*H).agg(
            F.count("*").alias("docs"), F.max("doc_id").alias("keeper")))
    common = runs.merged(runs.all()).where(F.col("docs") >= min_docs)
    drop = (keys.join(common.select(*H, "keeper"), H)
            .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
            .groupBy(F.col("doc_id").alias("_id"))
            .agg(F.collect_set(F.struct(*H)).alias("_drop")))
    k1, k2 = (lambda k: key128(line_key(k))[0]), (lambda k: key128(line_key(k))[1])
    joined = docs.join(drop, docs["doc_id"].cast("long").eqNullSafe(drop["_id"]), "left")
    staying = F.filter(F.col("_lines"), lambda x: ~(
        (F.length(line_key(x)) >= min_chars)
        & F.array_contains(F.col("_drop"), F.struct(k1(x).alias("h1"), k2(x).alias("h2")))))
    return (joined.withColumn("_lines", lines_of(F.col("text")))
            .withColumn("_stay", F.when(F.col("_drop").isNull(), F.col("_lines"))
                        .otherwise(staying))
            .withColumn("_n_lines", F.size("_lines").cast("long"))
            .withColumn("_n_dropped", (F.size("_lines") - F.size("_stay")).cast("long"))
            .withColumn("_kept", F.array_join("_stay", "\n"))
            .select(*put_back(through), *RESULTS))

"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark
decontamination, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all that its
predecessor kept. All but the last return the columns of ``docs``; ``n_chars``
follows the text, other columns pass through under any name. Rows without text stay as they are (nothing in them is
toxic, repeated or leaked); rows with a null doc_id are kept like others.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stategrid.llm import decontaminate, line_dedup, packing, simhash, toxicity
from stategrid.llm.common import key128, put_back, read, set_aside
from stategrid.session import materialize


KEPT = ("doc_id", "text", "n_chars")


def any_columns(stage):
    """The stage with columns beyond ``KEPT`` set aside, so that their names
    meet none of its own; the result has the columns of ``docs``."""
    @functools.wraps(stage)
    def whole(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        return stage(spark, set_aside(docs, KEPT), sf_dir).select(*put_back(docs.columns, KEPT))
    return whole


@any_columns
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score 0.5 or more."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return (docs.withColumn("_toxic", toxicity.score(F.col("text"), model))
            .where(F.col("_toxic") < 0.5).drop("_toxic"))


@any_columns
def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of 40 or more code points that 5 documents hold stay in the
    largest doc_id only."""
    out = line_dedup.dedup_lines(docs)
    changed = F.col("_n_dropped") > 0
    out = out.withColumn("text", F.when(changed, F.col("_kept")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long"))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def with_key(docs: DataFrame) -> DataFrame:
    """``docs`` with the 128-bit key of the text: next to the doc_id, which may
    be null or repeated, it tells rows apart."""
    t1, t2 = key128(F.coalesce("text", F.lit("")))
    return docs.withColumn("_t1", t1).withColumn("_t2", t2)


def same_row() -> Column:
    """Joins ``with_key`` to ids and keys (_id, _k1, _k2)."""
    return (F.col("doc_id").cast("long").eqNullSafe(F.col("_id"))
            & (F.col("_t1") == F.col("_k1")) & (F.col("_t2") == F.col("_k2")))


@any_columns
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that SimHash links one row stays: the
    smallest doc_id (a null one if none there has an id), of different texts
    with that id the one with the smallest key, of equal rows any one."""
    keep = materialize(simhash.representatives(docs, shingle=3, max_bits=2).select(
        F.col("doc_id").alias("_id"), F.col("t1").alias("_k1"), F.col("t2").alias("_k2"),
        F.col("rows").alias("_rows")), "keep")
    out = with_key(docs).join(keep, same_row())
    if keep.where("_rows > 1").limit(1).count():
        out = out.where("_rows = 1").unionByName(
            out.where("_rows > 1").dropDuplicates(["_id", "_k1", "_k2"]))
    return out.select(*docs.columns)


@any_columns
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the rows that hold a benchmark item."""
    leaks = materialize(decontaminate.leaking_rows(docs, read(spark, sf_dir, "benchmark")).select(
        F.col("doc_id").alias("_id"), F.col("t1").alias("_k1"), F.col("t2").alias("_k2"))
        .distinct(), "leaks")
    return with_key(docs).join(leaks, same_row(), "left_anti").select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences, with their token ids."""
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)


STAGES = [("toxicity", drop_toxic), ("line dedup", drop_lines),
          ("near dedup", drop_near_duplicates), ("decontamination", drop_leaks),
          ("packing", pack)]

#: Not expressible in SQL: trained scores, tokenizers and packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each stage's rows are written and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)

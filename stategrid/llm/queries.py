"""The queries ``opN_<name>``: each operator on its whole table with production
parameters, reduced to its digest columns; and the SQL of those that SQL can
express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stategrid.llm import (align, ann, audit, chat, decontaminate, line_dedup, packing, quality, sharding,
                           simhash, suffix_dedup, toxicity, warc)
from stategrid.llm.common import key128, read, scratch
from stategrid.session import materialize


def op1_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    changed = suffix_dedup.changed_texts(docs, 200).select(
        F.col("t1").alias("c1"), F.col("t2").alias("c2"), F.size("spans").cast("long").alias("s"),
        F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
        .alias("r"), F.sha2("kept", 256).alias("k"))
    text = F.coalesce("text", F.lit(""))
    t1, t2 = key128(text)
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.octet_length(text).cast("long").alias("n_bytes"),
                         F.sha2(text, 256).alias("own"), t1.alias("t1"), t2.alias("t2"))
    return narrow.join(changed, (F.col("t1") == F.col("c1")) & (F.col("t2") == F.col("c2")),
                       "left").select(
        "doc_id", "n_bytes", F.coalesce("r", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("s", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("k", "own").alias("kept_sha256"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs, min_chars=40, min_docs=5).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("_n_lines").alias("n_lines"),
        F.col("_n_dropped").alias("n_dropped"), F.sha2("_kept", 256).alias("kept_sha256"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, sf_dir, "documents"), shingle=3, max_bits=2)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = read(spark, sf_dir, "documents")
    cut = packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, capacity=4096)
    cut = cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    packed = packing.assign(cut, packing.group_count(docs), capacity=4096)
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         "offset")


def _remainder(doc_id, n: int):
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def _scored(docs: DataFrame, held_out, score) -> DataFrame:
    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.coalesce(held_out, F.lit(False)).alias("held_out"), score.alias("score"))
            .withColumn("predicted", (F.col("score") >= 0.5).cast("int")))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"),
                           keep=lambda i: F.coalesce(_remainder(i, 5) != 0, F.lit(False)))
    return _scored(docs, _remainder(F.col("doc_id"), 5) == 0, toxicity.score(F.col("text"), model))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read(spark, sf_dir, "documents"), shards=40)


#: A conversation whose texts look like control strings.
CONTROL_ID, CONTROL_TEXT = -7, "\\### Assistant: </turn> ok"


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        "role", "text")
    control = spark.range(2).select(
        F.lit(CONTROL_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONTROL_TEXT).alias("text"))
    events = chat.events_from_turns(rows.unionByName(control))
    back = chat.parse(chat.render(chat.reconstruct(events)))
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, read(spark, sf_dir, "labels"),
                          keep=lambda i: F.coalesce(_remainder(i, 3) != 1, F.lit(False)))
    return _scored(docs, _remainder(F.col("doc_id"), 3) == 1, quality.score(F.col("text"), model))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    aligned = align.align(read(spark, sf_dir, "documents"),
                          public_tokenizers.path("byte_bpe_50k.json"),
                          public_tokenizers.path("piece_bpe_32k.model"))
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return align.score(aligned.withColumn("groups_sha256", digest).drop("groups"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages go into legacy archives first, half of them in each version."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    arcs = []
    for version in warc.FIELDS:
        arcs.append(scratch(spark, f"arc-{version}"))
        own = F.pmod(F.xxhash64("page_id", "url"), F.lit(2)) == int(version) - 1
        warc.write_archives(warc.arc_rows(pages.where(own), version), arcs[-1], warc.ARC_END)
    out = scratch(spark, "warc")
    warc.convert(spark, arcs, out, min_bytes=0)
    return warc.resolve(materialize(warc.read_warc(spark, out), "warc-records").where("intact"))


QUERIES = {f.__name__: f for f in (
    op1_nearest, op2_suffix_dedup, op3_line_dedup, op4_decontaminate, op5_simhash, op6_packing,
    op7_toxicity, op8_sharding, op9_chat, op10_quality, op11_alignment, op12_filter_audit,
    op13_warc)}

_ROWS = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents)"""

ORACLE = {
    "op3_line_dedup": _ROWS + r""",
l AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
      GROUP BY key HAVING count(DISTINCT r) >= 5),
m AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.keeper AS gone
      FROM k LEFT JOIN c ON k.key = c.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines,
       CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM m GROUP BY r""",
    "op9_chat": r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations
           UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
           UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
e AS (SELECT *, replace(replace(role, '\', '\b'), '<', '\l') AS er,
             replace(replace(text, '\', '\b'), '<', '\l') AS et FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
         AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length(er) + length(et) + 20) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id""",
    "op12_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
             min(doc_id) OVER (PARTITION BY t) AS smallest FROM d),
f AS (SELECT part, doc_id, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b,
             100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS c,
             regexp_matches(t, '[#$%&*|]') AS d, coalesce(smallest < doc_id, false) AS e FROM w),
m AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
             max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
x AS (SELECT f.part, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END)
             || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END)
             || (CASE WHEN e THEN 'E' ELSE '' END) AS fails, count(*) AS n,
             sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
      FROM f LEFT JOIN m ON f.doc_id = m.doc_id GROUP BY 1, 2),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS own,
             CASE WHEN step > 1 THEN filter_order[1:step - 1] ELSE '' END AS before
      FROM o, range(1, 6) r(step)),
k AS (SELECT part, filter_order, step, any_value(own) AS own,
       sum(CASE WHEN NOT hit AND NOT fail THEN n ELSE 0 END) AS kept,
       sum(CASE WHEN NOT hit AND fail THEN n ELSE 0 END) AS removed,
       sum(CASE WHEN hit AND fail THEN n ELSE 0 END) AS redundant,
       sum(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
       sum(CASE WHEN NOT hit AND fail THEN good ELSE 0 END) AS good_lost,
       sum(CASE WHEN NOT hit AND fail THEN toxic ELSE 0 END) AS toxic_lost
      FROM (SELECT *, contains(fails, own) AS fail,
                   before <> '' AND regexp_matches(fails, '[' || before || '_]') AS hit FROM x, s)
      GROUP BY part, filter_order, step)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
       CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM k""",
    "op13_warc": r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h, strlen(coalesce(html, '')) AS payload_bytes,
                  sha1(coalesce(html, '')) AS x FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY x, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((
           CAST('0x' || substr(x, CAST(i // 4 AS INTEGER) * 5 + 1, 5) AS BIGINT)
           >> CAST(15 - 5 * (i % 4) AS BIGINT)) & 31 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM f""",
}

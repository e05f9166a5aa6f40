"""Sharding by balanced label propagation under capacity quotas.

Documents of equal text are linked. The state of the propagation is the table
of cells ``(group, shard, documents)`` - members of a group in one shard are
alike - so a group of any size is at most one row per shard. It starts in
ranges: the linked documents one group after the other, an equal share to each
shard, so that fewer groups than shards are cut. In every round a cut group's
documents move from shards where it is weaker to the shard that can take in
most of them, as far as the quota allows: opposite flows between two shards go
in equal amounts, and of the rest what the capacity of a shard leaves free.
The quota is dealt to buckets of groups by what they ask for, remainders too,
so no task sees all movers. Rounds end when nothing moves. At
last the unlinked documents fill the shards up, so that shard counts differ by
one at most (law ``rows``).

Rules: size is the UTF-8 bytes of the text (null: none) plus 16; null texts
count as empty text. A row is a document. An empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stategrid.llm.common import key128, parallelism, ranked
from stategrid.session import materialize

G = ["g1", "g2"]


def _by_shard(values: dict[int, int], shards: int, shard: Column) -> Column:
    """The value of a shard from one number per shard."""
    return F.element_at(F.array(*[F.lit(int(values.get(s, 0))).cast("long")
                                  for s in range(shards)]), shard + 1)


def quotas(asked: dict[tuple[int, int], int], room: dict[int, int]) -> dict[tuple[int, int], int]:
    """How much of what is asked, by (from, to), may go: opposite flows in
    equal amounts, and of the rest what the room of each shard takes in."""
    quota = {(s, t): min(n, asked.get((t, s), 0)) for (s, t), n in asked.items()}
    left = dict(room)
    for s, t in sorted(asked, key=lambda k: (quota[k] - asked[k], k)):      # most left first
        more = max(0, min(asked[s, t] - quota[s, t], left[t]))
        quota[s, t] += more
        left[t] -= more
    return quota


def propagate(cells: DataFrame, room: dict[int, int], shards: int,
              rounds: int | None) -> DataFrame:
    """cells (g1, g2, members, shard, docs) after moves within the ``room`` of
    the shards, until nothing moves or after ``rounds``. A document only goes
    where its group is stronger, so the rounds end by themselves."""
    spark = cells.sparkSession
    buckets = parallelism(spark)
    room, done = dict(room), 0
    while rounds is None or done < rounds:
        done += 1
        # equal cells of a group are ranked by a hash, so that groups differ in where they go
        ranks = cells.withColumn("tie", F.xxhash64(*G, "shard"))
        # where a group wants to be: the shard that can take in most of its documents from
        # shards where it is weaker; without any room, its strongest shard
        weaker = Window.partitionBy(*G).orderBy("docs", "tie", "shard").rowsBetween(
            Window.unboundedPreceding, -1)
        able = ranks.withColumn("able", F.greatest(F.lit(0), F.least(
            _by_shard(room, shards, F.col("shard")), F.coalesce(F.sum("docs").over(weaker),
                                                                F.lit(0)))))
        best = (able.groupBy(*G).agg(F.max(F.struct("able", "docs", "tie", "shard")).alias("w"))
                .select(F.col("g1").alias("b1"), F.col("g2").alias("b2"),
                        F.col("w.shard").alias("want"), F.col("w.docs").alias("strong"),
                        F.col("w.tie").alias("strong_tie")))
        asks = materialize(
            ranks.join(best, (F.col("g1") == F.col("b1")) & (F.col("g2") == F.col("b2")))
            .withColumn("moves", F.struct("docs", "tie", "shard") < F.struct(
                F.col("strong").alias("docs"), F.col("strong_tie").alias("tie"),
                F.col("want").alias("shard")))
            .withColumn("bucket", F.pmod(F.xxhash64(*G), F.lit(buckets)).cast("int"))
            .drop("b1", "b2", "strong", "strong_tie", "tie"), "asks")
        asked = asks.where("moves").groupBy("shard", "want", "bucket").agg(F.sum("docs").alias("n"))
        pairs = {(r["shard"], r["want"]): r["n"] for r in asked.groupBy("shard", "want").agg(
            F.sum("n").alias("n")).collect()}                          # a row per two shards
        quota = quotas(pairs, room)
        if not sum(quota.values()):
            break
        for (s, t), n in quota.items():
            room[s], room[t] = room[s] + n, room[t] - n
        # dealt to buckets by what they ask for, remainders too: differences of rounded sums
        flow = F.col("shard") * shards + F.col("want")
        granted = F.element_at(F.create_map(*[F.lit(int(x)).cast("long") for (s, t), n in
                                              quota.items() for x in (s * shards + t, n)]),
                               flow.cast("long"))
        total = F.sum("n").over(Window.partitionBy("shard", "want"))
        upto = F.sum("n").over(Window.partitionBy("shard", "want").orderBy("bucket").rowsBetween(
            Window.unboundedPreceding, 0))
        part = lambda c: F.floor(granted.cast("decimal(19,0)") * c / F.col("total"))
        share = (asked.withColumn("total", total).withColumn("upto", upto).select(
            F.col("shard").alias("q_shard"), F.col("want").alias("q_want"),
            F.col("bucket").alias("q_bucket"),
            (part(F.col("upto")) - part(F.col("upto") - F.col("n"))).cast("long").alias("quota")))
        before = (Window.partitionBy("shard", "want", "bucket", "moves")
                  .orderBy(F.desc("docs"), *G).rowsBetween(Window.unboundedPreceding, -1))
        flows = (asks.join(share, (F.col("want") == F.col("q_want"))
                           & (F.col("shard") == F.col("q_shard"))
                           & (F.col("bucket") == F.col("q_bucket")) & F.col("moves"), "left")
                 .withColumn("earlier", F.coalesce(F.sum("docs").over(before), F.lit(0)))
                 .withColumn("go", F.when(F.col("moves"), F.greatest(F.lit(0), F.least(
                     F.col("docs"), F.coalesce("quota", F.lit(0)) - F.col("earlier"))))
                     .otherwise(0).cast("long")))
        parts = F.explode(F.array(
            F.struct(F.col("shard"), (F.col("docs") - F.col("go")).alias("docs")),
            F.struct(F.col("want").alias("shard"), F.col("go").alias("docs"))))
        cells = materialize(
            flows.select(*G, "members", parts.alias("p")).where("p.docs > 0")
            .groupBy(*G, "members", F.col("p.shard").alias("shard"))
            .agg(F.sum("p.docs").alias("docs")), "cells")
    return cells


def shard(docs: DataFrame, shards: int = 40, rounds: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), a row per
    document; law is ``rows``."""
    spark = docs.sparkSession
    buckets = parallelism(spark)
    text = F.coalesce("text", F.lit(""))
    g1, g2 = key128(text)
    base = materialize(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"), g1.alias("g1"), g2.alias("g2")), "rows")
    n = base.count()
    capacity = {s: n // shards + (s < n % shards) for s in range(shards)}
    groups = base.groupBy(*G).agg(F.count("*").alias("members"))
    linked = materialize(groups.where("members > 1"), "groups")
    # the even start: the linked documents one after the other, in ranges of equal share
    offset = ranked_sum(linked, buckets)
    n_linked = linked.agg(F.coalesce(F.sum("members"), F.lit(0))).first()[0]
    ends = [0]
    for s in range(shards):
        ends.append(ends[-1] + capacity[s])
    ends = [n_linked * e // max(n, 1) for e in ends]
    ranges = F.array(*[F.struct(F.lit(s).alias("shard"), F.lit(lo).cast("long").alias("lo"),
                                F.lit(hi).cast("long").alias("hi"))
                       for s, (lo, hi) in enumerate(zip(ends, ends[1:]))])
    inside = F.transform(ranges, lambda r: F.struct(r["shard"].alias("shard"), (
        F.least(r["hi"], F.col("start") + F.col("members")) - F.greatest(r["lo"], F.col("start")))
        .alias("docs")))
    cells = materialize(
        offset.withColumn("cells", F.filter(inside, lambda c: c["docs"] > 0))
        .withColumn("cut", F.size("cells") > 1).select(*G, "members", "cut", F.inline("cells")),
        "cells")
    held = {r["shard"]: r["n"] for r in
            cells.groupBy("shard").agg(F.sum("docs").alias("n")).collect()}      # a row per shard
    room = {s: capacity[s] - held.get(s, 0) for s in range(shards)}
    moved = propagate(cells.where("cut").drop("cut"), room, shards, rounds)
    cells = cells.where("not cut").drop("cut").unionByName(moved)
    held = {r["shard"]: r["n"] for r in
            cells.groupBy("shard").agg(F.sum("docs").alias("n")).collect()}
    # members of a group take its cells in order
    upto = F.transform("cs", lambda c, i: F.struct(c["shard"].alias("shard"), F.aggregate(
        F.slice("cs", 1, i + 1), F.lit(0).cast("long"), lambda a, x: a + x["docs"]).alias("upto")))
    plan = (cells.groupBy(*G).agg(F.array_sort(F.collect_list(F.struct("shard", "docs"))).alias("cs"))
            .select(F.col("g1").alias("p1"), F.col("g2").alias("p2"), upto.alias("cs")))
    placed = base.join(plan, (F.col("g1") == F.col("p1")) & (F.col("g2") == F.col("p2")), "left") \
        .drop("p1", "p2")
    placed = materialize(placed, "placed")
    order = ["doc_id", "text_crc32", "size"]
    inside = (ranked(placed.where("cs is not null"), G, order, "position", buckets, F.col("doc_id"))
              .withColumn("shard", F.filter("cs", lambda c: c["upto"] > F.col("position"))
                          .getItem(0)["shard"]))
    singles = ranked(placed.where("cs is null").withColumn("one", F.lit(0)), ["one"], [*order, *G],
                     "position", buckets, F.struct("doc_id", *G))
    ends, at = [], 0
    for s in range(shards):
        at += capacity[s] - held.get(s, 0)
        ends.append(at)
    fill = F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]),
                           lambda e: e <= F.col("position")))
    cols = ["doc_id", "size", "text_crc32", "g1", "g2", "shard"]
    both = inside.select(*cols).unionByName(singles.withColumn("shard", fill).select(*cols))
    slots = ranked(materialize(both, "shards"), ["shard"], [*order, *G], "slot", buckets,
                   F.struct("doc_id", *G))
    return slots.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
                        F.col("shard").cast("int").alias("shard"), "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def ranked_sum(groups: DataFrame, buckets: int) -> DataFrame:
    """groups with ``start``: the members of all groups before them."""
    g = groups.withColumn("bucket", F.pmod(F.xxhash64(*G), F.lit(buckets)).cast("int"))
    sums = g.groupBy("bucket").agg(F.sum("members").alias("n"))
    bases = sums.select(F.col("bucket").alias("b"), F.coalesce(F.sum("n").over(
        Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    local = F.coalesce(F.sum("members").over(Window.partitionBy("bucket").orderBy(*G).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    return (g.withColumn("local", local).join(bases, F.col("bucket") == F.col("b"))
            .withColumn("start", F.col("base") + F.col("local")).drop("bucket", "b", "base", "local"))

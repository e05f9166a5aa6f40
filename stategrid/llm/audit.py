"""Filter interaction audit: how five filters overlap, for every order in
which they can be applied, by contracting contingency tensors.

Each document fails some of the filters A to E. Documents are counted by part
(source) and by the five outcomes: 32 counts a part, a 2x2x2x2x2 tensor whose
axis per filter is (passes, fails). A step of an order is a contraction: the
filters before it select *passes* on their axes, its own selects *fails* (what
it removes) or *passes* (what it keeps), the later ones select *all*. The
tensors are the only thing that leaves the documents, so the work after one
pass over the texts depends on the number of parts alone.

Filters: A under ``min_words`` words, B under half of the words distinct, C
more than 2 upper-case letters in 100 code points, D any of ``#$%&*|``, E the
text of a smaller doc_id.

Rules: null text is empty (it fails A only, and E like any other text). A null
source is the part ''. A null doc_id is never smaller than another and has no
smaller one: it neither fails E nor makes others fail. Rows that share text
and doc_id count one by one. Several label rows of a doc_id count as one that
has each mark if any has it. Equal texts are told by 128-bit hashes. An empty
table gives an empty result. Only doc_id, text and source (and doc_id, quality
and toxic of the labels) are read, so other columns may have any names.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stategrid.llm.common import key128

FILTERS = "ABCDE"
#: The three tensors of a part: all documents, quality 1, toxic 1.
COUNTS = ("docs", "good", "toxic")
PASS, FAIL, ALL = np.array([[1, 0], [0, 1], [1, 1]], np.int64)
SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, "
          "unique_fails long, good_lost long, toxic_lost long, shapley long")


def text_fails(words: Column, text: Column, min_words: int = 200) -> list[Column]:
    """The failure conditions A to D, which a text and its words decide."""
    n = F.size(words)
    return [n < min_words,
            F.size(F.array_distinct(words)) * 100 < n * 50,
            F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 2,
            text.rlike(r"[#$%&*|]")]


def outcomes(docs: DataFrame, labels: DataFrame, min_words: int = 200) -> DataFrame:
    """(part, code, docs, good, toxic): documents by part and outcome; bit i
    of ``code`` is 1 if filter i fails."""
    text = F.coalesce("text", F.lit(""))
    t1, t2 = key128(text)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                      F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                      t1.alias("t1"), t2.alias("t2")).withColumn(
        "words", F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), ""))
    code = sum((c.cast("int") * (1 << i) for i, c in enumerate(
        text_fails(F.col("words"), F.col("text"), min_words))), F.lit(0))
    # rows without an id are told apart by text, so that they do not meet in one task
    rows = own.select("doc_id", "part", "t1", "t2", code.alias("code")).groupBy(
        "doc_id", "part", "t1", "t2", "code").agg(F.count("*").alias("n"))
    no_id = F.col("doc_id").isNull()
    rows = rows.withColumn("_id", F.coalesce("doc_id", F.lit(0))).withColumn(
        "_salt", F.when(no_id, F.pmod("t1", F.lit(1 << 20)) + 1).otherwise(0))
    marks = labels.where("doc_id IS NOT NULL").groupBy(
        F.col("doc_id").cast("long").alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("toxic")).withColumn(
        "_salt", F.lit(0).cast("long"))
    marked = rows.withColumn("_salt", F.col("_salt").cast("long")).join(
        marks, ["_id", "_salt"], "left")
    # one row for each text, part and label: what is at its smallest id, and the rest
    cells = marked.groupBy("t1", "t2", "part", "code",
                           F.coalesce("good", F.lit(0)).alias("good"),
                           F.coalesce("toxic", F.lit(0)).alias("toxic")).agg(
        F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("at_least"),
        F.sum(F.when(no_id, 0).otherwise(F.col("n"))).alias("with_id"),
        F.sum(F.when(no_id, F.col("n")).otherwise(0)).alias("no_id"))
    first = F.min("least").over(Window.partitionBy("t1", "t2"))
    cells = cells.withColumn("first", F.when(F.col("least") == first, F.col("at_least"))
                             .otherwise(0)).withColumn("first", F.coalesce("first", F.lit(0)))
    both = cells.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("code"), (F.col("first") + F.col("no_id")).alias("n")),
        F.struct((F.col("code") + (1 << FILTERS.index("E"))).alias("code"),
                 (F.col("with_id") - F.col("first")).alias("n")))).alias("c"))
    return both.where("c.n > 0").groupBy("part", F.col("c.code").alias("code")).agg(
        F.sum("c.n").alias("docs"), F.sum(F.col("c.n") * F.col("good")).alias("good"),
        F.sum(F.col("c.n") * F.col("toxic")).alias("toxic"))


def selections(orders: list[str]) -> np.ndarray:
    """For each (order, step): the vectors that select on the five axes, for
    what is kept, removed, redundant-or-removed (all that the filter fails)
    and failed by it alone: shape (rows, 4, 5, 2)."""
    out = []
    for order in orders:
        for step, f in enumerate(order):
            at = FILTERS.index(f)
            before = [PASS if g in order[:step] else ALL for g in FILTERS]
            only = [PASS] * len(FILTERS)
            every = [ALL] * len(FILTERS)
            put = lambda vs, v: [v if i == at else x for i, x in enumerate(vs)]
            out.append([put(before, PASS), put(before, FAIL), put(every, FAIL), put(only, FAIL)])
    return np.array(out)


def contract(tensors: np.ndarray, orders: list[str]) -> dict[str, np.ndarray]:
    """The measures of every step of ``orders`` from ``tensors``, shape (3, 2,
    2, 2, 2, 2): documents, good ones and toxic ones."""
    s = selections(orders)
    flat = s.reshape(-1, len(FILTERS), 2)
    got = np.einsum("kabcde,ra,rb,rc,rd,re->kr", tensors, *flat.transpose(1, 0, 2),
                    optimize=["einsum_path", (0, 5), (0, 4), (0, 3), (0, 2), (0, 1)])
    docs, good, toxic = got.reshape(len(COUNTS), -1, 4)
    kept, removed, failing, only = docs.T
    return {"kept": kept, "removed": removed, "redundant": failing - removed,
            "unique_fails": only, "good_lost": good[:, 1], "toxic_lost": toxic[:, 1]}


def audit(docs: DataFrame, labels: DataFrame, min_words: int = 200) -> DataFrame:
    """A row per part, order of the five filters and step, see the module."""
    counts = outcomes(docs, labels, min_words)
    cells = 1 << len(FILTERS)
    # one row a part; missing outcomes are zeros
    parts = counts.groupBy("part").agg(*[
        F.array(*[F.sum(F.when(F.col("code") == i, F.col(c)).otherwise(0)) for i in range(cells)])
        .alias(c) for c in COUNTS])

    def steps(batches):
        orders = ["".join(p) for p in permutations(FILTERS)]
        names = np.repeat(orders, len(FILTERS))
        step = np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(orders))
        own = np.array(["".join(o)[k] for o in orders for k in range(len(FILTERS))])
        for b in batches:
            for part, *arrays in zip(b["part"], *(b[c] for c in COUNTS)):
                # code's bit i is axis i, so the last filter is the slowest axis
                t = np.array([np.asarray(a, np.int64).reshape((2,) * len(FILTERS)).T
                              for a in arrays])
                m = contract(t, orders)
                total = {f: int(m["removed"][own == f].sum()) for f in FILTERS}
                yield pd.DataFrame({"part": part, "filter_order": names, "step": step, **m,
                                    "shapley": [total[f] for f in own]})

    return parts.mapInPandas(steps, SCHEMA)

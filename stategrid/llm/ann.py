"""Approximate nearest neighbours with a hash-prefix forest.

A vector has one long hash string per tree: bits of the signs of random
projections (fixed seed). A tree is a sorted array of hash strings. A query
descends in every tree to its longest matching prefixes, and then ascends in
all trees together, one bit at a time, until the rows that share the prefix
number ``want`` over all trees. The rows found are scored exactly.

Vectors are dealt to blocks of about ``block`` rows; a block has a forest of
its own, and every query searches every block in chunks of ``chunk`` queries,
so a task holds one block and one chunk at any size of the table. Every valid
row is indexed. Rows of equal prefix are taken as a whole, so a vector that is
repeated many times cuts nothing off.

Rules: null or zero vectors, and vectors with null or non-finite components,
take no part; nor do rows without id. Vectors of different length do not
meet. Rows that repeat an id count as one (the smallest vector). Ties go to
the smaller id. Without queries or candidates the result is empty.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TREES = 96
BITS = 24
RESULT = "query_id long, rank int, vec_id long, score double"
_PART = "query_id long, vec_id long, score double"


def valid(rows: DataFrame) -> DataFrame:
    """(vec_id, v array<double>, dim): the vectors that take part, each id once."""
    v = F.col("embedding").cast("array<double>")
    big = F.lit(float("inf"))
    fine = (F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < big))
            & F.exists(v, lambda x: x != 0))
    return (rows.where(F.col("vec_id").isNotNull() & F.coalesce(fine, F.lit(False)))
            .groupBy(F.col("vec_id").cast("long").alias("vec_id"))
            .agg(F.min(v).alias("v")).withColumn("dim", F.size("v")))


def planes(dim: int, trees: int, bits: int) -> np.ndarray:
    return np.random.default_rng([11, dim]).standard_normal((dim, trees * bits)).astype(np.float32)


def hash_strings(x: np.ndarray, trees: int, bits: int) -> np.ndarray:
    """(trees, rows) strings of ``bits`` bits, the first bit highest."""
    out = np.zeros((trees, len(x)), np.uint32)
    p = planes(x.shape[1], trees, bits)
    for at in range(0, len(x), 4096):
        sign = (x[at:at + 4096].astype(np.float32) @ p > 0).reshape(-1, trees, bits)
        out[:, at:at + 4096] = (sign * (1 << np.arange(bits - 1, -1, -1, dtype=np.uint32))).sum(
            2, dtype=np.uint32).T
    return out


class Forest:
    def __init__(self, x: np.ndarray, trees: int = TREES, bits: int = BITS):
        self.x, self.trees, self.bits = x, trees, bits
        codes = hash_strings(x, trees, bits)
        self.order = np.argsort(codes, axis=1, kind="stable").astype(np.int32)
        self.codes = np.take_along_axis(codes, self.order, 1)

    def ranges(self, q: np.ndarray, depth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each query and tree, the part of the sorted array that has the
        query's first ``depth`` bits."""
        shift = (self.bits - depth).astype(np.uint64)
        low = (q.astype(np.uint64) >> shift) << shift
        high = low + (np.uint64(1) << shift)
        a = np.stack([np.searchsorted(c, lo) for c, lo in zip(self.codes, low)])
        b = np.stack([np.searchsorted(c, hi) for c, hi in zip(self.codes, high)])
        return a, b

    def search(self, queries: np.ndarray, want: int):
        """Yields the found rows of each query."""
        q = hash_strings(queries, self.trees, self.bits)
        # ascending together: the deepest depth at which all trees hold ``want`` rows
        lo, hi = np.zeros(len(queries), np.int64), np.full(len(queries), self.bits + 1)
        while (hi - lo > 1).any():
            mid = (lo + hi) // 2
            a, b = self.ranges(q, mid)
            enough = (b - a).sum(0) >= want
            lo, hi = np.where(enough, mid, lo), np.where(enough, hi, mid)
        a, b = self.ranges(q, lo)
        for i in range(len(queries)):
            mark = np.zeros(len(self.x), bool)
            mark[np.concatenate([o[s:e] for o, s, e in zip(self.order, a[:, i], b[:, i])])] = True
            yield np.flatnonzero(mark)


def search(rows: DataFrame, is_query: Column, k: int = 20, want: float = 0.5,
           block: int = 16_384, chunk: int = 2048, trees: int = TREES,
           bits: int = BITS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest rows found for each
    query by inner product. ``want``: rows to find per block, counted over all
    trees with repeats, as a multiple of the block's rows."""
    from stategrid.session import materialize
    base = materialize(valid(rows).withColumn("is_query", F.coalesce(is_query, F.lit(False))),
                       "vectors")
    sizes = {r["dim"]: (r["n"], r["q"]) for r in base.groupBy("dim").agg(
        F.count("*").alias("n"), F.sum(F.col("is_query").cast("long")).alias("q")).collect()}
    # a row for each length that vectors have
    per_dim = lambda i, size: F.coalesce(F.create_map(*[
        x for d, n in sizes.items() for x in (F.lit(d), F.lit(max(1, -(-n[i] // size))))]
    )[F.col("dim")], F.lit(1)) if sizes else F.lit(1)
    blocks, chunks = per_dim(0, block), per_dim(1, chunk)
    mine = F.pmod(F.xxhash64("vec_id"), blocks)
    data = base.select("vec_id", "v", "dim", mine.alias("block"), F.explode(
        F.sequence(F.lit(0), chunks - 1)).alias("chunk"), F.lit(False).alias("asks"))
    asking = base.where("is_query").select(
        "vec_id", "v", "dim", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
        F.pmod(F.xxhash64(F.lit(3), "vec_id"), chunks).alias("chunk"), F.lit(True).alias("asks"))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        rows, asks = frame[~frame["asks"]], frame[frame["asks"]].sort_values("vec_id")
        if not len(rows) or not len(asks):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        rows = rows.sort_values("vec_id")
        ids, x = rows["vec_id"].to_numpy(), np.stack(rows["v"].to_numpy())
        qs = np.stack(asks["v"].to_numpy())
        forest = Forest(x, trees, bits)
        small = x.astype(np.float32)
        out = []
        need = int(max(want * len(x), min(len(x), 4 * k) * trees))
        for q, v, found in zip(asks["vec_id"].to_numpy(), qs, forest.search(qs, need)):
            found = found[ids[found] != q]
            if len(found) > 4 * k:      # single precision first; the doubt is far below the margin
                rough = small[found] @ v.astype(np.float32)
                slack = 1e-4 * np.abs(rough).max()
                found = found[rough >= np.partition(rough, -k)[-k] - slack]
            exact = (x[found] * v).sum(1)
            best = np.lexsort((ids[found], -exact))[:k]
            out.append(pd.DataFrame({"query_id": q, "vec_id": ids[found][best],
                                     "score": exact[best]}))
        return pd.concat(out)

    found = data.unionByName(asking).groupBy("dim", "block", "chunk").applyInPandas(run, _PART)
    # a block gives at most k rows of a query
    best = F.slice(F.array_sort(F.collect_list(F.struct(
        (-F.col("score")).alias("far"), "vec_id", "score"))), 1, k)
    return (found.groupBy("query_id").agg(best.alias("best"))
            .select("query_id", F.posexplode("best").alias("at", "b"))
            .select("query_id", (F.col("at") + 1).cast("int").alias("rank"), "b.vec_id", "b.score"))

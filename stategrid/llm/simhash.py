"""SimHash near-duplicates by balls of whole fingerprints.

A document's fingerprint is the bitwise majority of the 64-bit hashes of its
word shingles. Two fingerprints link if they differ in at most ``max_bits``
(0, 1 or 2) bits. A fingerprint is filed under itself and its 64 neighbours at
one flipped bit; an entry's key is all 64 bits, ``SEGMENTS`` only groups the
flips (the README says why no table is keyed by a segment). Two fingerprints
within two bits meet in an entry: each moves by one bit at most. An entry holds
at most 65 different fingerprints, whatever the size of a group of copies, so
nothing needs a cap; neighbours in an entry are verified by their complete
distance.
Only different fingerprints are indexed, copies are collapsed before.

Rules: null text is empty; a text without words has fingerprint zero and is
linked like any other. A row is a document; the component is the smallest
doc_id reachable (null if none there has an id). Empty table: empty result.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from stategrid.llm.common import LOWER, UPPER, key128, release_memory
from stategrid.llm.graph import components
from stategrid.session import materialize

SEED = 42
SEGMENTS = 4
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_CASE = bytes.maketrans(UPPER.encode(), LOWER.encode())
_CHUNK = 1 << 16


def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = _WORD.findall((text or "").encode("utf-8", "surrogatepass").translate(_CASE))
    if not words:
        return 0
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    stop, n = ends[shingle - 1:], len(words) - shingle + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(
            starts[at:min(n, at + _CHUNK)].tolist(), stop[at:at + _CHUNK].tolist())], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` with ``_fp`` (the fingerprint's 64 bits as a signed long)."""
    @F.pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        found = pd.Series(np.array([fingerprint(t, shingle) for t in texts], np.uint64)
                          .astype(np.int64))
        release_memory()
        return found
    return docs.withColumn("_fp", fp(F.col("text")))


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links (a, b) that join exactly the fingerprints (``_fp``, each once)
    that chains of distance ``max_bits`` or less join."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2")
    if max_bits == 0:
        return fps.select(F.col("_fp").alias("a"), F.col("_fp").alias("b")).limit(0)
    width = 64 // SEGMENTS
    flips = [1 << b for b in range(64)]
    flips = [f - (1 << 64) if f >= 1 << 63 else f for f in flips]
    balls = F.array(F.lit(0).cast("long"), *[F.lit(f).cast("long") for s in range(SEGMENTS)
                                            for f in flips[s * width:(s + 1) * width]])
    entries = fps.select(F.col("_fp"), F.explode(balls).alias("_flip")).select(
        "_fp", F.col("_fp").bitwiseXOR(F.col("_flip")).alias("_entry"))
    if max_bits == 1:       # distance one: a flip of one is the other itself
        own = fps.select(F.col("_fp").alias("b"))
        return (entries.join(own, F.col("_entry") == F.col("b"))
                .where(F.col("_fp") > F.col("b")).select(F.col("_fp").alias("a"), "b"))
    # the fingerprints of an entry are pairwise within two bits: a chain through them is enough
    near = entries.withColumn("_next", F.lag("_fp").over(
        Window.partitionBy("_entry").orderBy("_fp")))
    return (near.where(F.col("_next").isNotNull()
                       & (F.bit_count(F.col("_fp").bitwiseXOR(F.col("_next"))) <= max_bits))
            .select(F.col("_fp").alias("a"), F.col("_next").alias("b")).distinct())


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id), a row per document: the
    fingerprint as 16 lowercase hex digits and the smallest doc_id that links
    reach."""
    marked = materialize(fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                                                  "text"), shingle)
                         .select("doc_id", "_fp"), "fingerprints")
    whole = classes(marked.groupBy("_fp").agg(F.min("doc_id").alias("_least")), max_bits)
    least = whole.groupBy("_part").agg(F.min("_least").alias("component_id"))
    ids = whole.join(least, "_part").select("_fp", "component_id")
    return marked.join(ids, "_fp").select(
        "doc_id", F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"), "component_id")


def classes(fps: DataFrame, max_bits: int) -> DataFrame:
    """``fps`` (a row per ``_fp``) with ``_part``, the same for all that links join."""
    parts = components(links(fps.select("_fp"), max_bits))
    return materialize(fps.join(parts, F.col("_fp") == F.col("node"), "left").select(
        *fps.columns, F.coalesce("component", "_fp").alias("_part")), "classes")


def representatives(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, t1, t2, rows), a row per component: the document that stands
    for it, told by id and 128-bit text key, and how many rows are equal in
    both. It has the smallest doc_id (null only if none there has an id), of
    several texts with that id the one with the smallest key."""
    t1, t2 = key128(F.coalesce("text", F.lit("")))
    marked = fingerprints(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), shingle)
    rows = (marked.select("_fp", "doc_id", t1.alias("t1"), t2.alias("t2"))
            .groupBy("_fp", "doc_id", "t1", "t2").agg(F.count("*").alias("rows")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2", "rows"))
    fps = materialize(rows.groupBy("_fp").agg(first.alias("_least")), "fingerprints")
    return (classes(fps, max_bits).groupBy("_part").agg(F.min("_least").alias("_least"))
            .select("_least.doc_id", "_least.t1", "_least.t2", "_least.rows"))

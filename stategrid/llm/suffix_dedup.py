"""Exact substring deduplication with suffix arrays built by induced sorting.

A byte is removed if it lies in a string of ``length`` bytes that starts
anywhere else too. Equal strings must meet in one array although they may be
in any two documents, so texts are cut at content-defined anchors: the places
of the smallest ``GRAM``-byte hash in every ``length`` bytes (winnowing).
Equal strings have equal anchors at equal distances. Anchors whose hash occurs
once can not be in a repeat and go no further; around the others the text
within reach (a context) goes to the shard of the anchor's hash. A shard joins
its contexts into one string and builds its suffix array
(``suffix_array.py``): suffixes are classified, leftmost-smaller substrings
are sorted by induction and named, the reduced string is sorted recursively,
all suffixes are induced from it, and permuted common prefixes tell which
neighbours agree in ``length`` bytes. Suffixes that agree so and lie at the
same distance from their anchors are repeats. The hashes of grams only decide
what meets; equal texts and equal contexts are told by 128-bit hashes.

Copies of a text are collapsed before (copies of ``length`` bytes or more go
whole), equal contexts are collapsed before the shards. An anchor with more
than ``hot`` different contexts is not put in one array: its strings are dealt
to many tasks and counted by a 128-bit hash.

Rules: null text is empty. A row is a document, so equal rows repeat each
other. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stategrid.llm.common import key128, put_back, ranges, set_aside
from stategrid.llm.suffix_array import common_prefixes, suffix_array
from stategrid.session import materialize

GRAM = 80
SHARD_BYTES = 2_000_000
HOT = 20_000
T, C = ["t1", "t2"], ["c1", "c2"]


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, hashes): in every ``length`` bytes the places where the hash
    of GRAM bytes is smallest, all of them if several are."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    h, width = data.astype(np.uint64) + np.uint64(1), 1
    factor = np.uint64(0x9E3779B97F4A7C15)
    while width < GRAM:             # hashes of 2, 4, 8 ... bytes from two parts
        step = min(width, GRAM - width)
        h = (h[:-step] * factor + h[step:]) * np.uint64(0xBF58476D1CE4E5B9)
        h ^= h >> np.uint64(29)
        width += step
    span = length - GRAM + 1
    low = _sliding(h, span, np.minimum)
    rim = np.zeros(span - 1, np.uint64)
    most = _sliding(np.concatenate([rim, low, rim]), span, np.maximum)
    places = np.flatnonzero(h == most)
    return places, h[places].view(np.int64)


def _sliding(x: np.ndarray, span: int, of) -> np.ndarray:
    w = 1
    while 2 * w <= span:
        x, w = of(x[:-w], x[w:]), 2 * w
    return of(x[:len(x) - (span - w)], x[span - w:]) if w < span else x


def _anchor_rows(length: int):
    def run(batches):
        for b in batches:
            h, p = [], []
            for text in b["text"]:
                places, hashes = anchors(np.frombuffer(
                    text.encode("utf-8", "surrogatepass"), np.uint8), length)
                h.append(hashes)
                p.append(places.astype(np.int32))
            yield pd.DataFrame({"doc_id": b["doc_id"].astype("Int64"), "t1": b["t1"], "t2": b["t2"],
                                "h": h, "p": p})
    return run


def _found_rows(length: int):
    """The different contexts of each text, without their bytes."""
    def run(batches):
        for b in batches:
            out = []
            for t1, t2, n, text, at in zip(b["t1"], b["t2"], b["n"], b["text"], b["at"]):
                data, made = text.encode("utf-8", "surrogatepass"), {}
                for x in at:
                    p = x["p"]
                    a = max(0, p - (length - GRAM))
                    made.setdefault((x["h"], p - a, data[a:p + length]), []).append(p)
                out += [(t1, t2, n, h, left, len(c), ps, xxhash.xxh64_intdigest(c, h & _LOW),
                         xxhash.xxh64_intdigest(c, (h ^ left) & _LOW)) for (h, left, c), ps
                        in made.items()]
            out = pd.DataFrame(out, columns=["t1", "t2", "n", "h", "left", "size", "places", *C])
            yield out.astype({"c1": "uint64", "c2": "uint64"}).astype({"c1": "int64", "c2": "int64"})
    return run


_LOW = (1 << 63) - 1
_FOUND = ("t1 long, t2 long, n long, h long, left int, size int, places array<int>, c1 long, "
          "c2 long")


def _context_rows(batches):
    for b in batches:
        out = []
        for text, at in zip(b["text"], b["at"]):
            data = text.encode("utf-8", "surrogatepass")
            out += [(x["h"], x["left"], x["weight"], x["c1"], x["c2"],
                     data[x["p"] - x["left"]:x["p"] - x["left"] + x["size"]]) for x in at]
        yield pd.DataFrame(out, columns=["h", "left", "weight", "c1", "c2", "context"])


_CONTEXT = "h long, left int, weight long, c1 long, c2 long, context binary"


def _shared(strings: list[bytes], width: int) -> np.ndarray:
    """Of each string of at most ``width`` bytes, how many it has in common
    with the start of any other one: in order, its neighbours have most."""
    rows = np.array(strings, f"S{width}")
    order = np.argsort(rows, kind="stable")
    flat = rows[order].view(np.uint8).reshape(-1, width)
    differ = flat[1:] != flat[:-1]
    near = np.where(differ.any(axis=1), differ.argmax(axis=1), width)
    most = np.zeros(len(strings), np.int64)
    most[order] = np.maximum(np.append(near, 0), np.append(0, near))
    return np.minimum(most, np.fromiter(map(len, strings), np.int64, len(strings)))


def repeated_parts(contexts: list[bytes], left: np.ndarray, weight: np.ndarray,
                   length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, lo, hi): the parts of contexts that repeated strings cover,
    as distances from the anchor. ``left``: the anchor's place, ``length`` less
    GRAM at most, with at most ``length`` bytes from there on; ``weight``: how
    often a context occurs. One that occurs often is covered whole. Every
    string holds the anchor, so it reaches no further to a side than some other
    context agrees: what is beyond, and contexts without room for a string, are
    not sorted, and what is then equal is sorted once."""
    at = left.tolist()
    before = np.minimum(_shared([c[:a + GRAM][::-1] for c, a in zip(contexts, at)], length) - GRAM, left)
    after = _shared([c[a:] for c, a in zip(contexts, at)], length)
    some = np.flatnonzero((before >= 0) & (before + after >= length))
    alike: dict[tuple[bytes, int], int] = {}    # what is left of contexts is often the same
    kind = np.array([alike.setdefault((contexts[i][at[i] - b:at[i] + n], b), len(alike)) for i, b, n in zip(
        some.tolist(), before[some].tolist(), after[some].tolist())], np.int64)
    of, lo, hi = _sorted_parts([c for c, _ in alike], np.array([b for _, b in alike], np.int64),
                               np.bincount(kind, weight[some]).astype(np.int64), length)
    part = np.full(len(alike), -1)
    part[of] = np.arange(len(of))               # all strings hold the anchor: one part at most
    part = part[kind]
    once = (part >= 0) & (weight[some] == 1)
    of, lo, hi = some[once], lo[part[once]], hi[part[once]]
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    whole = np.flatnonzero((weight > 1) & (sizes >= length))
    of = np.concatenate([of, whole])
    lo = np.concatenate([lo, -left[whole]])
    hi = np.concatenate([hi, (sizes - left)[whole]])
    order = np.argsort(of, kind="stable")
    return of[order], lo[order], hi[order]


def _sorted_parts(contexts: list[bytes], left: np.ndarray, weight: np.ndarray,
                  length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same, found by the suffix array of the contexts."""
    if not contexts:
        return (np.zeros(0, np.int64),) * 3
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    text = np.frombuffer(b"\xff".join(contexts) + b"\xff\xfe", np.uint8)   # not in UTF-8
    s = text.astype(np.uint16) + 1
    s[-1] = 0
    sa = suffix_array(s, 257)
    agree = common_prefixes(text, sa)[sa] >= length
    start = np.cumsum(sizes + 1) - sizes - 1
    room = np.zeros(len(s), bool)           # places where a string has room in its context
    room[ranges(start, np.maximum(sizes - length + 1, 0))] = True
    use = np.flatnonzero(room[sa])
    run = np.cumsum(~agree)[use]
    of = np.repeat(np.arange(len(contexts), dtype=np.int32), sizes + 1)[sa[use]]
    several = (np.bincount(run)[run] > 1) | (weight[of] > 1)
    run, of, use = run[several], of[several].astype(np.int64), use[several]
    offset = sa[use] - start[of]
    key = run.astype(np.int64) * (1 << 20) + (left[of] - offset + (1 << 19))
    _, inverse = np.unique(key, return_inverse=True)
    total = np.bincount(inverse, weight[of]) if len(key) else np.zeros(0)
    hit = total[inverse] > 1
    of, offset = of[hit], offset[hit]
    order = np.argsort((of << 20) + offset)
    of, offset = of[order], offset[order]
    if not len(of):
        return of, offset, offset
    fresh = np.concatenate(([True], (of[1:] != of[:-1]) | (offset[1:] > offset[:-1] + length)))
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(of)) - 1
    return of[first], offset[first] - left[of[first]], offset[last] + length - left[of[first]]


def _shard_rows(length: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        of, lo, hi = repeated_parts(frame["context"].tolist(), frame["left"].to_numpy(np.int64),
                                    frame["weight"].to_numpy(np.int64), length)
        return pd.DataFrame({"c1": frame["c1"].to_numpy()[of], "c2": frame["c2"].to_numpy()[of],
                             "lo": lo, "hi": hi})
    return run


def _hot_parts(contexts: DataFrame, length: int) -> DataFrame:
    """The same parts for anchors of many contexts, string by string."""
    part = F.substr("context", F.col("o") + 1, F.lit(length))
    s1, s2 = key128(part)
    each = (contexts.withColumn("o", F.explode(F.sequence(
        F.lit(0), F.octet_length("context") - length)))
        .select(*C, "h", "weight", (F.col("o") - F.col("left")).alias("lo"), s1.alias("s1"),
                s2.alias("s2")))
    twice = (each.groupBy("h", "lo", "s1", "s2").agg(F.sum("weight").alias("w"))
             .where("w > 1").drop("w"))
    # the strings of a context all hold its anchor, so what they cover is one run
    return each.join(twice, ["h", "lo", "s1", "s2"]).groupBy(*C).agg(
        F.min("lo").alias("lo"), (F.max("lo") + length).alias("hi"))


def _keep_rows(batches):
    for b in batches:
        out = []
        for t1, t2, text, parts in zip(b["t1"], b["t2"], b["text"], b["parts"]):
            data, spans = text.encode("utf-8", "surrogatepass"), []
            for x in sorted((x["a"], x["b"]) for x in parts):
                if spans and x[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], x[1])
                else:
                    spans.append([*x])
            kept, at = [], 0
            for a, z in spans:
                kept.append(data[at:a])
                at = z
            out.append((t1, t2, [{"start": a, "end": z} for a, z in spans],
                        b"".join(kept) + data[at:]))
        yield pd.DataFrame(out, columns=["t1", "t2", "spans", "kept"])


_CHANGED = "t1 long, t2 long, spans array<struct<start:long,end:long>>, kept binary"


def changed_texts(docs: DataFrame, length: int = 200, hot: int = HOT,
                  shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(t1, t2, spans, kept): for every different text that loses bytes, by
    its 128-bit key, the removed runs (start, end in bytes) and what stays."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    text = F.coalesce("text", F.lit(""))
    t1, t2 = key128(text)
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), t1.alias("t1"), t2.alias("t2"),
                      text.alias("text"))
    marked = materialize(own.mapInPandas(
        _anchor_rows(length), "doc_id long, t1 long, t2 long, h array<long>, p array<int>")
        .withColumn("row", F.monotonically_increasing_id()), "anchors")
    copies = own.groupBy(*T).agg(F.count("*").alias("n"), F.min("doc_id").alias("rep"),
                                 F.max(F.octet_length("text")).alias("bytes"))
    copies = materialize(copies, "copies")
    each = marked.select("row", F.explode(F.arrays_zip("h", "p")).alias("x")).select(
        "row", F.col("x.h").alias("h"), F.col("x.p").alias("p"))
    twice = each.groupBy("h").agg(F.count("*").alias("w")).where("w > 1").select("h")
    at = (each.join(twice, "h").groupBy("row")
          .agg(F.collect_list(F.struct("h", "p")).alias("at")))
    # of the copies of a text one goes on
    some = (marked.select("row", *T, "doc_id").join(at, "row")
            .join(copies.select(F.col("t1").alias("k1"), F.col("t2").alias("k2"), "n", "rep"),
                  (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2"))
                  & F.col("doc_id").eqNullSafe(F.col("rep")))
            .groupBy(F.col("t1").alias("k1"), F.col("t2").alias("k2"), F.col("rep"))
            .agg(F.max("n").alias("n"), F.max_by("at", "row").alias("at")))
    texts = materialize(
        own.join(some, (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2"))
                 & F.col("doc_id").eqNullSafe(F.col("rep"))).select(*T, "n", "text", "at"), "texts")
    found = materialize(texts.mapInPandas(_found_rows(length), _FOUND), "contexts")
    once = materialize(found.groupBy("h", "left", *C).agg(
        F.sum(F.col("n") * F.size("places")).alias("weight"),
        F.min(F.struct(*T, F.col("places")[0].alias("p"), "size")).alias("rep")), "different")
    # an anchor whose contexts are all equal has nothing to be sorted against
    kinds = materialize(once.groupBy("h").agg(F.count("*").alias("m"), F.sum("weight").alias(
        "weight")).withColumn("alike", F.col("m") == 1), "kinds")
    alike = kinds.where("alike and weight > 1").select("h")
    mixed = kinds.where("not alike")
    n_mixed, most = mixed.agg(F.coalesce(F.sum("m"), F.lit(0)), F.coalesce(F.max("m"), F.lit(0))
                              ).first()

    def contexts(of: DataFrame) -> DataFrame:
        """Each different context once, with its bytes."""
        at = (once.join(of.select("h"), "h").groupBy(F.col("rep.t1").alias("t1"), F.col("rep.t2").alias("t2"))
              .agg(F.collect_list(F.struct("h", "left", "weight", *C, "rep.p", "rep.size"))
                   .alias("at")))
        return texts.select(*T, "text").join(at, T).select("text", "at").mapInPandas(
            _context_rows, _CONTEXT)

    shards = max(1, -(-n_mixed * (2 * length - GRAM) // shard_bytes))
    parts = (contexts(mixed.where(F.col("m") <= hot))
             .withColumn("shard", F.pmod(F.xxhash64(F.col("h")), F.lit(shards)))
             .groupBy("shard").applyInPandas(
                 _shard_rows(length), "c1 long, c2 long, lo long, hi long"))
    if most > hot:
        parts = parts.unionByName(_hot_parts(contexts(mixed.where(F.col("m") > hot)), length).select(
            *C, F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi")))
    mine = found.where("n = 1")
    covered = mine.join(alike, "h", "left_semi").select(
        *T, F.explode("places").alias("p"), (-F.col("left")).cast("long").alias("lo"),
        (F.col("size") - F.col("left")).cast("long").alias("hi"))
    single = mine.select(*T, "places", *C).join(parts, C).select(
        *T, F.explode("places").alias("p"), "lo", "hi").unionByName(covered)
    spans = single.groupBy(*T).agg(F.collect_list(F.struct(
        (F.col("p") + F.col("lo")).alias("a"), (F.col("p") + F.col("hi")).alias("b"))).alias("parts"))
    cut = (texts.where("n = 1").select(*T, "text").join(spans, T)
           .mapInPandas(_keep_rows, _CHANGED))
    whole = copies.where((F.col("n") > 1) & (F.col("bytes") >= length)).select(
        *T, F.array(F.struct(F.lit(0).cast("long").alias("start"),
                             F.col("bytes").cast("long").alias("end"))).alias("spans"),
        F.lit(b"").alias("kept"))
    return cut.unionByName(whole)


def remove_repeats(docs: DataFrame, length: int = 200, hot: int = HOT) -> DataFrame:
    """``docs`` with ``_spans`` (removed runs) and ``_kept`` (bytes that stay);
    input columns of these two names give way, others may have any name."""
    t1, t2 = key128(F.coalesce("text", F.lit("")))
    through = [c for c in docs.columns if c not in ("_spans", "_kept")]
    docs = set_aside(docs.select(*["`" + c.replace("`", "``") + "`" for c in through]))
    changed = changed_texts(docs, length, hot).select(
        F.col("t1").alias("_c1"), F.col("t2").alias("_c2"), F.col("spans").alias("_spans"),
        F.col("kept").alias("_kept"))
    return (docs.withColumns({"_t1": t1, "_t2": t2})
            .join(changed, (F.col("_t1") == F.col("_c1")) & (F.col("_t2") == F.col("_c2")), "left")
            .select(*put_back(through),
                    F.coalesce("_spans", F.array()).alias("_spans"),
                    F.coalesce("_kept", F.coalesce("text", F.lit("")).cast("binary")).alias("_kept")))

"""Alignment of two tokenizers' tokens over the bytes of each text.

Both tokenizers read space+text. Offsets where a token of A and one of B end
together cut the tokens into groups; the two tokens that end there are linked.

Fragments form a monoid. The fragment of a byte range holds the tokens that
end in the range: an open prefix (up to its first common end), closed groups,
and an open suffix (after its last one); without a common end all of it is
open prefix. ``compose`` joins neighbouring fragments: left suffix and right
prefix close one group. It is associative, so documents over ``chunk`` bytes
are cut into byte ranges, each read by some Spark task, and their fragments
composed by a tree of ``FAN`` in rounds of grouped joins. The cuts fall
anywhere, also inside a token: the range's task reads the whole unit there and
keeps the tokens that end in its range.

A unit is the text from one single space between two visible characters to the
next. Neither tokenizer joins characters over such a space (the first one's
pattern starts a word there; of the second one ``Aligner`` checks the
vocabulary, and takes whole texts as units otherwise), so the tokens of a text
are those of its units, and a unit that a slice of texts repeats is encoded once. A
byte range that ends inside a unit of over ``LONG_UNIT`` bytes is moved to its
end, so that no unit is read by many tasks.

Rules: texts that are null, empty, or whose tokens' bytes do not give back
space+text have no tokens. Repeated rows count as often as they occur.
An empty table gives an empty result. Only doc_id and text are read.
"""

from __future__ import annotations

import os
import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce
from itertools import accumulate, chain, islice
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stategrid.llm.common import key128
from stategrid.session import materialize

_CUT = re.compile(r"(?<=\S) (?=\S)")
CHUNK, LONG_UNIT, FAN = 32 << 10, 4 << 10, 8
#: Bytes of text that are read together, units that are encoded as one text, and units that are
#: put together in one go.
SLICE, TOGETHER, BLOCK = 8 << 20, 4000, 150_000
#: Pair counts up to so many rows (about 64 bytes each) are broadcast; more are joined by shuffles.
BROADCAST_PAIRS = 1_000_000


class Fragment(NamedTuple):
    """What the tokens that end in a byte range come to."""
    ok: bool = True
    n_a: int = 0
    n_b: int = 0
    ends: int = 0               # common ends, each closes a group
    head_a: str = ""            # open prefix: ids, comma-separated
    head_b: str = ""
    body: str = ""              # closed groups, a1,a2|b1;a3|b2
    tail_a: str = ""            # open suffix
    tail_b: str = ""


def _join(sep: str, *parts: str) -> str:
    return sep.join(p for p in parts if p)


def compose(left: Fragment, right: Fragment) -> Fragment:
    """The fragment of two neighbouring ranges; ``Fragment()`` is neutral."""
    ok, n_a, n_b = left.ok and right.ok, left.n_a + right.n_a, left.n_b + right.n_b
    ends = left.ends + right.ends
    if not left.ends:
        return Fragment(ok, n_a, n_b, ends, _join(",", left.head_a, right.head_a),
                        _join(",", left.head_b, right.head_b), *right[6:])
    mid_a, mid_b = _join(",", left.tail_a, right.head_a), _join(",", left.tail_b, right.head_b)
    if not right.ends:
        return Fragment(ok, n_a, n_b, ends, *left[4:7], mid_a, mid_b)
    return Fragment(ok, n_a, n_b, ends, left.head_a, left.head_b,
                    _join(";", left.body, f"{mid_a}|{mid_b}", right.body), right.tail_a, right.tail_b)


def groups(f: Fragment) -> str:
    """The groups of a whole document's fragment."""
    return _join(";", f"{f.head_a}|{f.head_b}", f.body) if f.ok and f.ends else ""


def _csv(ids) -> str:
    return ",".join(map(str, ids))


def of_tokens(a: list, a_ends: list, b: list, b_ends: list, ok: bool = True) -> Fragment:
    """The fragment of the tokens ``a`` and ``b`` with their end offsets."""
    common = sorted(set(a_ends) & set(b_ends))
    if not common:
        return Fragment(ok, len(a), len(b), 0, _csv(a), _csv(b))
    ia = [0, *np.searchsorted(a_ends, common, "right").tolist(), len(a)]
    ib = [0, *np.searchsorted(b_ends, common, "right").tolist(), len(b)]
    cut = [(_csv(a[i:j]), _csv(b[k:m])) for i, j, k, m in zip(ia, ia[1:], ib, ib[1:])]
    return Fragment(ok, len(a), len(b), len(common), *cut[0],
                    ";".join(f"{x}|{y}" for x, y in cut[1:-1]), *cut[-1])


def links(a: list, a_ends: list, b: list, b_ends: list) -> list[int]:
    """a * 2^32 + b for every pair of tokens that end together."""
    at: dict[int, list[int]] = {}
    for x, e in zip(a, a_ends):
        at.setdefault(e, []).append(x)
    return [(x << 32) + y for y, e in zip(b, b_ends) for x in at.get(e, ())]


def _byte_decoder() -> dict[str, int]:
    """The byte of each character of byte-level vocabularies: printable Latin-1
    stands for itself, the other bytes for the characters from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Learnt(NamedTuple):
    """Of units, in order: groups as text, (failed, n_a, n_b, links), links."""
    whole: list[str]
    sums: np.ndarray
    links: np.ndarray


def _concat(parts: list[Learnt]) -> Learnt:
    return Learnt([w for x in parts for w in x.whole], *(np.concatenate([x[k] for x in parts])
                                                         for k in (1, 2)))


class Aligner:
    """Tokens of units and the fragments of texts, for one pair of tokenizers."""

    def __init__(self, bpe: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        decode = _byte_decoder()
        size = self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = [bytes(decode.get(c, 63) for c in self.a.id_to_token(i) or "")
                        for i in range(size)]
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i)
                        else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        self.a_len = np.array([len(t) for t in self.a_bytes])
        self.b_len = np.array([len(t) for t in self.b_bytes])
        self.units = not any(re.search("[^▁]▁", p) for p in names)

    def split(self, text: str) -> list[str]:
        """The units of a text, each without the space before it."""
        return _CUT.split(text) if self.units else [text]

    def tokens(self, units: list[str]) -> Iterator[tuple]:
        """(a, a_ends, b, b_ends, ok) of each unit, offsets from its space."""
        ea = self.a.encode_batch([" " + u for u in units], add_special_tokens=False)
        eb = self.b.encode(units, num_threads=1)
        for u, x, b in zip(units, ea, eb):
            a, whole = x.ids, (" " + u).encode()
            ba, bb = [self.a_bytes[i] for i in a], [self.b_bytes[i] for i in b]
            yield (a, list(accumulate(map(len, ba))), b, list(accumulate(map(len, bb))),
                   b"".join(ba) == whole and b"".join(bb) == whole)

    def _joined(self, units: list[str]) -> Learnt | None:
        """What is known of units that start and end visibly, encoded as one
        text; None if its tokens do not give back the bytes or its units."""
        text = " ".join(units)
        whole = (" " + text).encode()
        la, lb = self.a.encode_batch_fast([" " + text], add_special_tokens=False)[0].ids, \
            self.b.encode(text)
        a, b = np.array(la), np.array(lb)
        ends = np.cumsum([len(u.encode()) + 1 for u in units])
        if not (self.a_len[a].all() and self.b_len[b].all()
                and b"".join(map(self.a_bytes.__getitem__, la)) == whole
                and b"".join(map(self.b_bytes.__getitem__, lb)) == whole):
            return None
        a_ends, b_ends, mark = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b]), \
            np.zeros((2, len(whole) + 1), bool)
        mark[0, a_ends] = mark[1, b_ends] = True
        mark = mark[0] & mark[1]
        common = np.flatnonzero(mark)
        if not mark[ends].all():
            return None
        ia, ib = np.searchsorted(a_ends, common) + 1, np.searchsorted(b_ends, common) + 1
        sa, sb = list(map(str, la)), list(map(str, lb))
        cut_a, cut_b = [0, *ia.tolist()], [0, *ib.tolist()]
        text = [f"{sa[i]}|{sb[k]}" if j - i == 1 == m - k else
                f"{','.join(sa[i:j])}|{','.join(sb[k:m])}"
                for i, j, k, m in zip(cut_a, cut_a[1:], cut_b, cut_b[1:])]
        at = np.searchsorted(common, ends) + 1              # the groups of each unit
        of = [0, *at.tolist()]
        sums = np.diff(np.stack([np.zeros_like(at), ia[at - 1], ib[at - 1], at], axis=1), axis=0,
                       prepend=0)
        return Learnt([";".join(text[i:j]) for i, j in zip(of, of[1:])], sums,
                      (a[ia - 1] << 32) + b[ib - 1])

    def _each(self, units: list[str]) -> Learnt:
        """The same of any units, one by one."""
        whole, sums, found = [], [], []
        for t in self.tokens(units):
            f = of_tokens(*t)
            found += (own := links(*t[:4]) if t[4] else [])
            whole.append(groups(f))
            sums.append((not f.ok, f.n_a, f.n_b, len(own)))
        return Learnt(whole, np.array(sums, np.int64).reshape(-1, 4), np.array(found, np.int64))

    def _apart(self, units: list[str], odd: set[str]) -> Learnt:
        order = sorted(range(len(units)), key=lambda i: units[i] in odd)
        n = len(units) - sum(u in odd for u in units)
        parts = [self.learn([units[i] for i in order[:n]])] if n else []
        got = _concat([*parts, self._each([units[i] for i in order[n:]])])
        at = np.argsort(order)
        lens = got.sums[:, 3]
        starts = np.cumsum(lens) - lens
        links = [got.links[starts[i]:starts[i] + lens[i]] for i in at]
        return Learnt([got.whole[i] for i in at], got.sums[at], np.concatenate(links))

    def learn(self, units: list[str]) -> Learnt:
        """Of each unit its groups, (failed, n_a, n_b, links) and links."""
        out = []
        for i in range(0, len(units), TOGETHER):
            some = units[i:i + TOGETHER]
            odd = {u for u in some if not u or u[0].isspace() or u[-1].isspace()}
            if odd and self.units:      # the visible ones together, the others one by one
                out.append(self._apart(some, odd))
            else:
                out.append(self.units and not odd and self._joined(some) or self._each(some))
        return _concat(out)

    def read(self, rows: list[tuple]) -> tuple[list[Fragment], np.ndarray, np.ndarray, np.ndarray]:
        """rows: (text, lo, hi), for the tokens that end after byte ``lo`` of
        the first unit and up to ``hi`` of the last one (None: all). Gives
        their fragments, and as flat arrays offsets, pairs and counts of the
        links of each row, different pairs in different entries. A unit that
        occurs in several places is encoded once."""
        index: dict[str, int] = {}
        ids, edges = [], []
        for text, lo, hi in rows:
            units = self.split(text)
            i, j, n = int(lo > 0), len(units) - (hi is not None), len(units) - 1
            ids.append(array("q", [index.setdefault(u, len(index)) for u in units[i:j]]))
            cut = ([(0, lo, hi if n == 0 else None)] if lo or (n == 0 and hi is not None) else []) \
                + ([(n, 0, hi)] if n and hi is not None else [])
            edges.append([(at, *self._part(units[at], a, b)) for at, a, b in cut])
        known = self.learn(list(index)) if index else Learnt(
            [], np.zeros((0, 4), np.int64), np.zeros(0, np.int64))
        pairs, number = np.unique(np.concatenate([known.links, np.array(
            [p for cut in edges for *_, ps in cut for p in ps], np.int64)]), return_inverse=True)
        of_edges = iter(number[len(known.links):].tolist())
        out, sizes, found, counts, at = [], [0], [], [], 0
        while at < len(rows):               # some rows at a time, for short arrays
            units, upto = 0, at
            while upto < len(rows) and (units < BLOCK or upto == at):
                units, upto = units + len(ids[upto]), upto + 1
            key, count = self._links(known, number, ids[at:upto], [
                [n for *_, ps in cut for n in islice(of_edges, len(ps))] for cut in edges[at:upto]])
            out += self._fragments(known, ids[at:upto], edges[at:upto])
            sizes += np.bincount(key >> 32, minlength=upto - at).tolist()
            found.append(pairs[key & 0xFFFFFFFF])
            counts.append(count)
            at = upto
        none = [np.zeros(0, np.int64)]
        return out, np.cumsum(sizes), np.concatenate(none + found), np.concatenate(none + counts)

    def _fragments(self, known: Learnt, ids: list, edges: list) -> list[Fragment]:
        ends = np.cumsum([0, *map(len, ids)])
        flat = np.fromiter(chain.from_iterable(ids), np.int64, ends[-1])
        sums = np.stack([np.diff(np.append(0, np.cumsum(c[flat]))[ends]) for c in known.sums.T], 1)
        out = []
        for own, (bad, *n), cut in zip(ids, sums.tolist(), edges):
            f = Fragment()
            if own:             # a unit ends in a common end, so nothing stays open after it
                first, _, rest = ";".join(map(known.whole.__getitem__, own)).partition(";")
                f = Fragment(False, *n) if bad else Fragment(True, *n, *first.split("|"), rest)
            for at, edge, _ in cut:
                f = compose(f, edge) if at else compose(edge, f)
            out.append(f)
        return out

    def _links(self, known: Learnt, number: np.ndarray, ids: list, more: list) -> tuple:
        """(row * 2^32 + pair number, count) of the links of some rows."""
        flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(map(len, ids)))
        lens = known.sums[:, 3]
        starts, lens = (np.cumsum(lens) - lens)[flat], lens[flat]
        at = np.repeat(starts - np.cumsum(lens) + lens, lens) + np.arange(lens.sum())
        row = np.repeat(np.repeat(np.arange(len(ids)), [len(i) for i in ids]), lens)
        edge = np.array([(r << 32) + n for r, ns in enumerate(more) for n in ns], np.int64)
        return np.unique(np.concatenate([(row << 32) + number[at], edge]), return_counts=True)

    def _part(self, unit: str, lo: int, hi: int | None) -> tuple[Fragment, list[int]]:
        a, a_ends, b, b_ends, ok = next(self.tokens([unit]))
        hi = max([*a_ends, *b_ends]) if hi is None else hi
        own = (*_within(a, a_ends, lo, hi), *_within(b, b_ends, lo, hi))
        return of_tokens(*own, ok), links(*own)

    def chunks(self, text: str, size: int = CHUNK) -> Iterator[tuple[int, int, int | None, str]]:
        """(chunk, lo, hi, piece): byte ranges of about ``size`` of space+text
        with the whole units they touch; lo and hi as ``read`` takes them."""
        units = self.split(text)
        lens = np.array([len(u.encode()) + 1 for u in units])
        ends = np.cumsum(lens)
        border, cuts = size, [(0, 0)]
        while border < ends[-1]:
            i = int(np.searchsorted(ends, border))
            if ends[i] == border or lens[i] > LONG_UNIT:
                border = int(ends[i])
                cuts.append((i + 1, 0))
            else:
                cuts.append((i, border - int(ends[i] - lens[i])))
            border = (border // size + 1) * size
        if cuts[-1][0] < len(units):
            cuts.append((len(units), 0))
        for c, ((i, lo), (j, hi)) in enumerate(zip(cuts, cuts[1:])):
            yield c, lo, hi or None, " ".join(units[i:j + (hi > 0)])


def _within(ids: list, ends: list, lo: int, hi: int) -> tuple[list, list]:
    i, j = bisect_right(ends, lo), bisect_right(ends, hi)
    return ids[i:j], ends[i:j]


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(bpe: str, pieces: str) -> Aligner:
    """One aligner for each Python worker, kept between its tasks."""
    if (bpe, pieces) not in _ALIGNERS:
        _ALIGNERS[bpe, pieces] = Aligner(bpe, pieces)
    return _ALIGNERS[bpe, pieces]


LINKS = "pairs array<long>, ns array<long>"
FRAGMENT = ("ok boolean, n_a long, n_b long, ends long, head_a string, head_b string, body string, "
            "tail_a string, tail_b string")
ALIGNED = "n_a long, n_b long, n_groups long, groups string"


def _slices(batches, size_of):
    """Parts of the Arrow batches, of about SLICE bytes each."""
    for b in batches:
        lens = pc.binary_length(b[size_of]).to_pylist()
        at, held = 0, 0
        for i, n in enumerate(lens):
            held += n
            if held >= SLICE:
                yield b.slice(at, i + 1 - at)
                at, held = i + 1, 0
        if at < len(lens):
            yield b.slice(at)


def _lists(offsets, pairs, counts) -> list[pa.Array]:
    offsets = pa.array(offsets, pa.int32())
    return [pa.ListArray.from_arrays(offsets, pa.array(x, pa.int64())) for x in (pairs, counts)]


def _short(docs: DataFrame, bpe: str, pieces: str) -> DataFrame:
    """Alignments of texts that are read whole."""
    def run(batches):
        own = aligner(bpe, pieces)
        for b in _slices(batches, "text"):
            frags, *found = own.read([(t, 0, None) for t in b["text"].to_pylist()])
            kept = [(f.n_a, f.n_b, f.ends, groups(f)) if f.ok else (0, 0, 0, "") for f in frags]
            cols = [pa.array(c, t) for c, t in zip(zip(*kept), (pa.int64(),) * 3 + (pa.string(),))]
            yield pa.RecordBatch.from_arrays(
                [b["doc_id"], *cols, pa.array([f.ok for f in frags]), *_lists(*found)],
                ["doc_id", "n_a", "n_b", "n_groups", "groups", "ok", "pairs", "ns"])

    out = docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id long, {ALIGNED}, ok boolean, {LINKS}")
    return _without_bad(out)


def _without_bad(rows: DataFrame) -> DataFrame:
    none = F.array().cast("array<long>")
    return rows.withColumns({c: F.when(F.col("ok"), F.col(c)).otherwise(none)
                             for c in ("pairs", "ns")}).drop("ok")


def _fragments(texts: DataFrame, bpe: str, pieces: str, chunk: int) -> DataFrame:
    """(t1, t2, chunk) and the fragment and links of each byte range of each
    different text: ranges are dealt over all tasks."""
    def cut(batches):
        own = aligner(bpe, pieces)
        for b in batches:
            for t1, t2, text in zip(*(b[c].to_pylist() for c in ("t1", "t2", "text"))):
                rows = [(t1, t2, *c) for c in own.chunks(text, chunk)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(),) * 5 + (pa.string(),))],
                    ["t1", "t2", "chunk", "lo", "hi", "piece"])

    def run(batches):
        own = aligner(bpe, pieces)
        for b in _slices(batches, "piece"):
            frags, *found = own.read(list(zip(*(b[c].to_pylist() for c in (
                "piece", "lo", "hi")))))
            cols = [pa.array(c, t) for c, t in zip(
                zip(*frags), (pa.bool_(),) + (pa.int64(),) * 3 + (pa.string(),) * 5)]
            yield pa.RecordBatch.from_arrays(
                [b["t1"], b["t2"], b["chunk"], *cols, *_lists(*found)],
                ["t1", "t2", "chunk", *Fragment._fields, "pairs", "ns"])

    ranges = texts.mapInArrow(cut, "t1 long, t2 long, chunk long, lo long, hi long, piece string")
    return ranges.dropDuplicates(["t1", "t2", "chunk"]).mapInArrow(
        run, f"t1 long, t2 long, chunk long, {FRAGMENT}, {LINKS}")


def _composed(frags: DataFrame, fan: int) -> DataFrame:
    """Each ``fan`` neighbouring fragments as one."""
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("chunk")
        whole = reduce(compose, (Fragment(*r) for r in group[list(Fragment._fields)].itertuples(
            index=False)))
        pairs, at = np.unique(np.concatenate(group["pairs"].tolist()), return_inverse=True)
        ns = np.bincount(at, np.concatenate(group["ns"].tolist()), len(pairs)).astype(np.int64)
        head = group[["t1", "t2"]].iloc[:1].reset_index(drop=True)
        return head.assign(chunk=group["chunk"].iloc[0] // fan, **whole._asdict(),
                           pairs=[pairs.astype(np.int64)], ns=[ns])

    return frags.groupBy("t1", "t2", F.expr(f"chunk div {fan}")).applyInPandas(run, frags.schema)


def align(docs: DataFrame, bpe: str, pieces: str, chunk: int = CHUNK, fan: int = FAN) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups, pairs, ns): a row per document,
    the groups as text ``a1,a2|b1;a3|b2,b3`` and the links as pairs
    a * 2^32 + b with how often each occurs. ``bpe`` and ``pieces`` are the
    files of a byte-level BPE and of a sentence-piece model."""
    text = F.coalesce("text", F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    size = F.octet_length("text")
    short = _short(own.where((size > 0) & (size <= chunk)), bpe, pieces)
    empty = own.where(size == 0).select("doc_id", *[F.lit(0).cast("long").alias(c) for c in (
        "n_a", "n_b", "n_groups")], F.lit("").alias("groups"),
        *[F.array().cast("array<long>").alias(c) for c in ("pairs", "ns")])
    t1, t2 = key128(F.col("text"))
    large = own.where(size > chunk).select("doc_id", t1.alias("t1"), t2.alias("t2"), "text")
    frags = materialize(_fragments(large.select("t1", "t2", "text"), bpe, pieces, chunk), "fragments")
    most = frags.agg(F.max("chunk")).first()[0] or 0
    while most > 0:
        frags, most = _composed(frags, fan), most // fan
    whole = F.col("ok") & (F.col("ends") > 0)
    texts = _without_bad(frags.select(
        F.col("t1").alias("k1"), F.col("t2").alias("k2"), whole.alias("ok"),
        *[F.when(whole, F.col(c)).otherwise(0).alias(n) for c, n in (
            ("n_a", "n_a"), ("n_b", "n_b"), ("ends", "n_groups"))],
        F.when(whole, F.concat_ws(";", F.concat_ws("|", "head_a", "head_b"),
                                  F.when(F.col("body") != "", F.col("body")))).otherwise("")
        .alias("groups"), "pairs", "ns"))
    long = large.select("doc_id", "t1", "t2").join(
        texts, (F.col("t1") == F.col("k1")) & (F.col("t2") == F.col("k2"))).select(*short.columns)
    return short.unionByName(long).unionByName(empty)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, count, best): links of all documents by pair; ``best`` is 1 if
    no other pair of the same B id has more. A B id has at most as many pairs
    as A has ids, so the window's groups have that bound."""
    counts = aligned.select(F.explode(F.arrays_zip("pairs", "ns")).alias("l")).groupBy(
        F.col("l.pairs").alias("pair")).agg(F.sum("l.ns").alias("count"))
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    most = F.max("count").over(Window.partitionBy(b))
    return counts.withColumn("best", (F.col("count") == most).cast("long"))


def score(aligned: DataFrame, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``aligned`` (columns pairs and ns of ``align``, any others) with n_links,
    n_best and count_sum in their place. The rows are written first, with an
    identity of their own; the counts are broadcast up to ``broadcast_pairs``
    rows and joined by shuffles beyond, with the same result."""
    rows = materialize(aligned.withColumn("_row", F.expr("uuid()")), "aligned")
    counts = materialize(pair_counts(rows), "pair-counts")
    if counts.count() <= broadcast_pairs:
        counts = F.broadcast(counts)
    each = rows.select("_row", F.explode(F.arrays_zip("pairs", "ns")).alias("l")).select(
        "_row", F.col("l.pairs").alias("pair"), F.col("l.ns").alias("n"))
    sums = each.join(counts, "pair").groupBy("_row").agg(
        F.sum("n").alias("n_links"), F.sum(F.col("n") * F.col("best")).alias("n_best"),
        F.sum(F.col("n") * F.col("count")).alias("count_sum"))
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_links", "n_best", "count_sum")}
    return rows.drop("pairs", "ns").join(sums, "_row", "left").withColumns(zero).drop("_row")

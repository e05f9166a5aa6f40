"""Packing of token sequences: first-fit decreasing with a tournament tree of
bin capacities, run independently in randomised groups of documents.

Documents are tokenised in Spark tasks; a document's ids end with an end id
and are cut into pieces of ``capacity`` and a rest. Documents are dealt to
groups by a hash of id and text; a group is packed in one task and holds about
``group_docs`` documents at every corpus size. Sequence ids are unique, not
gapless.

Rules: null text is empty (its only id is the end id). Equal rows are packed
as rows of their own. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import os
import re
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stategrid.llm.common import ranges, release_memory

#: Words as the tokenizer's pattern cuts them, for texts in which Python's classes agree with it.
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_UNSURE = re.compile("[^\t\n\r\x20-\x7e¡-©«¬®-±´¶-¸"
                     "»¿-įı-ňŊ-ž–—‘’"
                     "“”…€]|<\\|")
_SAFE = bytes(b for b in range(256) if not _UNSURE.search(chr(b)))
#: The rules of tokenizers whose words ``_WORDS`` cuts (the normaliser's type, what it
#: replaces, and the pattern of its words); texts of any other tokenizer are encoded whole.
_RULES = ("Lowercase", "\\s+", r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: A letter or digit and what is neither: there the tokenizer's words end as they do at white space.
_EDGE = r"([\pL\pN])([^\s\pL\pN])"
#: Strings that an encoder remembers, and bytes of them and their ids.
KNOWN, KNOWN_BYTES = 400_000, 24 << 20
#: Words that go through the tokenizer together.
CALL = 2000


def _certain(text: str) -> bool:
    try:
        return not text.encode("latin-1").translate(None, _SAFE) and "<|" not in text
    except UnicodeEncodeError:
        return not _UNSURE.search(text)


class Memory:
    """Ids by string, as columns that a whole slice of text is looked up in at
    once. When there are too many strings, the half that is used most stays."""

    def __init__(self):
        self._hold(pa.array([], pa.string()), np.zeros(0, "<u4"), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _hold(self, strings: pa.Array, ids: np.ndarray, sizes: np.ndarray, uses: np.ndarray) -> None:
        self.strings, self.ids, self.sizes, self.uses = strings, ids, sizes, uses
        self.starts = np.cumsum(sizes) - sizes

    def find(self, keys: pa.Array, uses: np.ndarray, learn) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, start, size) of different ``keys``, each used so often;
        ``learn(new)`` gives the ids of unknown ones."""
        at = pc.index_in(keys, value_set=self.strings)
        new = keys.filter(at.is_null())
        known = len(self.strings)
        at = at.fill_null(-1).to_numpy().astype(np.int64)
        at[at < 0] = known + np.arange(len(new))
        if len(new):
            got = learn(new.to_pylist())
            self._hold(pa.concat_arrays([self.strings, new]),
                       np.concatenate([self.ids, np.frombuffer(b"".join(got), "<u4")]),
                       np.concatenate([self.sizes, np.fromiter(map(len, got), np.int64, len(got)) // 4]),
                       np.concatenate([self.uses, np.zeros(len(new), np.int64)]))
        self.uses[at] += uses
        found = self.ids, self.starts[at], self.sizes[at]
        self._forget()
        return found

    def _forget(self) -> None:
        held = self.strings.nbytes + 4 * len(self.ids)
        if len(self.strings) <= KNOWN and held <= KNOWN_BYTES:
            return
        order = np.argsort(-self.uses, kind="stable")
        weight = 4 * self.sizes[order] + pc.binary_length(self.strings).to_numpy()[order] + 4
        order = order[:KNOWN // 2]
        stay = np.sort(order[np.cumsum(weight[:len(order)]) <= KNOWN_BYTES // 2])
        sizes = self.sizes[stay]
        self._hold(self.strings.take(pa.array(stay)), self.ids[ranges(self.starts[stay], sizes)], sizes,
                   self.uses[stay] // 2)


class Encoder:
    """Ids of whole texts. The tokenizer's words never span white space nor go
    from a letter or digit to anything else, so texts are cut there, and the ids
    of every different part are found once and remembered. Texts with characters
    whose class or case is not certain here, and all texts if the tokenizer has
    other rules than ``_RULES``, go through the tokenizer whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = self._rules() == _RULES
        self.known = Memory()

    def _rules(self) -> tuple | None:
        rules = json.loads(self.tokenizer.to_str())
        normal = (rules["normalizer"] or {}).get("normalizers", [])
        cut = (rules["pre_tokenizer"] or {}).get("pretokenizers", [])
        if [n["type"] for n in normal] != ["NFC", "Replace", "Lowercase"] \
                or [c["type"] for c in cut] != ["Split", "ByteLevel"] or cut[1]["add_prefix_space"] \
                or cut[0]["behavior"] != "Removed" or not cut[0]["invert"]:
            return None
        return normal[2]["type"], normal[1]["pattern"].get("Regex"), cut[0]["pattern"].get("Regex")

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _of_words(self, words: list[str]) -> list[bytes]:
        """The ids of each word, found for ``CALL`` words at a time: the
        tokenizer's own record of a text is many times as large as the text."""
        return [ids for i in range(0, len(words), CALL) for ids in self._of_call(words[i:i + CALL])]

    def _of_call(self, words: list[str]) -> list[bytes]:
        """One call; a word of the joined text is a word of its own."""
        e = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        of = np.array(e.word_ids, np.int64)
        ends = (4 * np.searchsorted(of, np.arange(len(words)), "right")).tolist()
        raw = np.array(e.ids, "<u4").tobytes()
        return [raw[a:b] for a, b in zip([0, *ends], ends)]

    def _of_parts(self, parts: list[str]) -> list[bytes]:
        cut = [[p] if p.isalpha() else _WORDS.findall(p) for p in parts]
        words = dict.fromkeys(chain.from_iterable(cut))
        words = dict(zip(words, self._of_words(list(words))))
        return [words[ws[0]] if len(ws) == 1 else b"".join(map(words.get, ws)) for ws in cut]

    def __call__(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; a part that several texts hold is looked up once."""
        sure = [self.by_words and _certain(t) for t in texts]
        lower = pa.array([t.lower() for t, s in zip(texts, sure) if s], pa.string())
        cut = pc.ascii_split_whitespace(pc.replace_substring_regex(lower, _EDGE, r"\1 \2"))
        parts = cut.flatten().dictionary_encode()
        of = parts.indices.to_numpy()
        ids, starts, sizes = self.known.find(parts.dictionary, np.bincount(of, minlength=len(
            parts.dictionary)), self._of_parts)
        starts, sizes = starts[of], sizes[of]
        ids = ids[ranges(starts, sizes)]
        edges = np.append(0, np.cumsum(sizes))[cut.offsets.to_numpy() - cut.offsets[0].as_py()].tolist()
        found = (ids[i:j].tobytes() for i, j in zip(edges, edges[1:]))
        return [next(found) if s else self._whole(t) for t, s in zip(texts, sure)]


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each Python worker, kept between its tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


#: Texts are encoded together up to so many characters.
SLICE = 6 << 20


def _slices(batch: pd.DataFrame, size: int):
    """Parts of a batch of about ``size`` characters of text."""
    part = batch["text"].str.len().cumsum() // size
    for _, rows in batch.groupby(part, sort=False):
        yield rows


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length; the longest first, each into the first
    bin with room. The tree's inner nodes hold the largest room below."""
    n = len(lengths)
    leaves = 1 << max(0, (n - 1).bit_length())
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[i]), 1
        while node < leaves:
            node *= 2
            if room[node] < need:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= need
        while node > 1:
            node //= 2
            most = max(room[2 * node], room[2 * node + 1])
            if room[node] == most:
                break
            room[node] = most
    return bins, offsets


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids) and ``_group_key``."""
    def cut(batches):
        encode = encoder(tokenizer)
        end = np.array([end_id], "<u4").tobytes()
        for b in batches:
            for b in _slices(b, SLICE):
                rows = []
                for doc_id, key, ids in zip(b["doc_id"], b["_group_key"], encode(list(b["text"]))):
                    ids += end
                    n = len(ids) // 4
                    rows += [(doc_id, key, s, min(capacity, n - s), n, ids[4 * s:4 * (s + capacity)])
                             for s in range(0, n, capacity)]
                yield _frame(rows)
                release_memory()

    def _frame(rows):
        out = pd.DataFrame(rows, columns=["doc_id", "_group_key", "start", "length", "doc_tokens",
                                          "ids"])
        return out.astype({"doc_id": "Int64"})

    text = F.coalesce("text", F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"),
                      F.xxhash64(F.col("doc_id").cast("long"), text).alias("_group_key"))
    return own.mapInPandas(cut, "doc_id long, _group_key long, start long, length long, "
                                "doc_tokens long, ids binary")


def assign(cut: DataFrame, groups: int, capacity: int = 4096, seed: int = 7) -> DataFrame:
    """The rows of ``pieces`` (with any other columns) and their sequence_id
    and offset there; ``groups`` randomised groups of documents are packed
    independently."""
    def ffd(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "start", "_group_key"],
                                  ascending=[False, True, True, True], kind="stable")
        bins, offsets = first_fit_decreasing(group["length"].to_numpy(), capacity)
        return group.assign(sequence_id=(int(key[0]) << 32) + bins, offset=offsets).drop(
            columns=["_group_key", "_group"])

    group = F.pmod(F.xxhash64("_group_key", F.lit(seed)), F.lit(groups))
    schema = ", ".join(f"{c} {t}" for c, t in cut.dtypes if c != "_group_key")
    return cut.withColumn("_group", group).groupBy("_group").applyInPandas(
        ffd, f"{schema}, sequence_id long, offset long")


def group_count(docs: DataFrame, group_docs: int = 1500) -> int:
    return max(1, -(-docs.count() // group_docs))


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2, capacity: int = 4096,
         group_docs: int = 1500) -> DataFrame:
    """The pieces of all documents, with their ids, sequence_id and offset."""
    return assign(pieces(docs, tokenizer, end_id, capacity), group_count(docs, group_docs), capacity)


def sequences(packed: DataFrame, capacity: int = 4096, pad_id: int = 0) -> DataFrame:
    """(sequence_id, tokens, ids binary): whole sequences, padded to
    ``capacity`` unless their token count is a power of two."""
    joined = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("tokens"),
        F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("ps"))
    hexed = F.array_join(F.transform("ps", lambda p: F.hex(p["ids"])), "")
    pad = F.lit(int(pad_id).to_bytes(4, "little").hex().upper())
    power = F.bit_count("tokens") == 1
    return joined.select("sequence_id", "tokens", F.unhex(F.concat(hexed, F.when(
        power, F.lit("")).otherwise(F.repeat(pad, (F.lit(capacity) - F.col("tokens")).cast("int")))))
        .alias("ids"))

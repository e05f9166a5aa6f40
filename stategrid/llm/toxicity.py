"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's score is logistic in its words
and word beginnings; the document's score is their noisy-or,
``1 - prod(1 - p)``. Only document labels are needed to train: the gradient of
the noisy-or shares a label out to the sentences that explain it. The model
then scores whole texts and locates the offending sentences.

Training reads at most ``max_train`` labelled documents (half of each label,
chosen by a hash of the id) in one task, and keeps at most ``max_features``
features; everything else runs over all rows.

Rules: null text is empty; a text without words scores 0. A row is a document.
Documents with several labels train with the largest. Without labels of both
kinds there is no evidence and every score is 0.
"""

from __future__ import annotations

import re
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stategrid.llm.common import release_memory

MAX_TRAIN = 4000
MAX_FEATURES = 4000
PREFIXES = (4, 5, 6)
_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")
_MEMORY = 200_000


def word_features(word: str) -> list[str]:
    return [word] + [word[:k] + "*" for k in PREFIXES if len(word) > k]


def training_rows(docs: DataFrame, labels: DataFrame, label: str, keep: Column,
                  max_train: int) -> DataFrame:
    """(y, text) of at most max_train / 2 documents of each label: those of
    smallest hash. ``keep`` says which ids may be learnt from."""
    known = (labels.where(F.col(label).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("_id"))
             .agg(F.max(label).cast("int").alias("y")))
    known = known.where(keep(F.col("_id")))
    present = known.join(docs.select(F.col("doc_id").cast("long").alias("_id")).distinct(),
                         "_id", "left_semi")
    # the half * 2 smallest hashes of each label, by two ordered limits: no label in one task
    half = max_train // 2
    chosen = [present.where(F.col("y") == y).orderBy(F.xxhash64("_id"), "_id").limit(half)
              for y in (0, 1)]
    chosen = chosen[0].unionByName(chosen[1])
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"),
                       F.coalesce("text", F.lit("")).alias("text")).join(chosen, "_id")
    return rows.groupBy("_id").agg(F.max("y").alias("y"), F.max("text").alias("text")).select(
        "y", "text")


def _indexed(texts):
    """Feature names; the document of every sentence that has words; and the
    (sentence, feature) pairs, each once, as two arrays. A word's features are
    found once, so that memory follows the vocabulary and not the words."""
    ids: dict[str, int] = {}
    of_word: dict[str, list[int]] = {}
    doc, sentence, feature = array("i"), array("i"), array("i")
    for d, text in enumerate(texts):
        for s in _SENTENCE.finditer(text.lower()):
            words = set(_WORD.findall(s[0]))
            if not words:
                continue
            for w in words:
                if w not in of_word:
                    of_word[w] = [ids.setdefault(f, len(ids)) for f in word_features(w)]
            held = sorted({f for w in words for f in of_word[w]})
            feature.extend(held)
            sentence.extend([len(doc)] * len(held))
            doc.append(d)
    return (list(ids), *(np.frombuffer(x, np.int32) if x else np.zeros(0, np.int32)
                         for x in (doc, sentence, feature)))


def fit_noisy_or(texts, labels, max_features: int = MAX_FEATURES, steps: int = 250,
                 rate: float = 0.1, ridge: float = 1e-4) -> list[tuple[str, float]]:
    """Weights of features, and the bias under the empty name."""
    y = np.asarray(labels, np.float64)
    if len(set(labels)) < 2:
        return []
    names, doc, sentence, feature = _indexed(texts)
    seen = np.zeros((2, len(names)), np.int64)
    starts = np.searchsorted(doc, np.arange(len(y) + 1))      # sentences of a document
    ends = np.searchsorted(sentence, starts)                  # and their features
    for label, i, j in zip(labels, ends[:-1], ends[1:]):
        seen[label, np.unique(feature[i:j])] += 1
    n1, n0 = y.sum(), len(y) - y.sum()
    p, q, both = seen[1] / n1, seen[0] / n0, seen.sum(axis=0)
    m = both / (n1 + n0)
    evidence = np.abs(p - q) / np.sqrt(m * (1 - m) * (1 / n1 + 1 / n0) + 1e-12)
    picked = sorted(np.flatnonzero((both >= 4) & (evidence >= 2.5)).tolist(),
                    key=lambda f: (-evidence[f], names[f]))[:max_features]
    strong = [names[f] for f in picked]
    index = np.full(len(names), -1, np.int64)
    index[picked] = np.arange(len(picked))
    hit = index[feature] >= 0
    feature, sentence = index[feature[hit]], sentence[hit]
    w, b = np.zeros(len(strong)), -5.0
    m, v = np.zeros(len(strong) + 1), np.zeros(len(strong) + 1)
    balance = np.where(y > 0, 0.5 / n1, 0.5 / n0) * len(y)
    balance = np.sqrt(balance)          # halfway to equal weight of the two labels
    for t in range(1, steps + 1):
        z = b + np.bincount(sentence, w[feature], len(doc))
        p = 1 / (1 + np.exp(-z))
        total = np.bincount(doc, np.logaddexp(0, z), len(y))
        none = np.exp(-total)
        by_doc = balance * np.where(y > 0, -none / np.maximum(1 - none, 1e-9), 1.0) / len(y)
        g = by_doc[doc] * p
        grad = np.append(np.bincount(feature, g[sentence], len(w)) + ridge * w, g.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w, b = w - step[:-1], b - step[-1]
    return [("", float(b))] + [(f, float(x)) for f, x in zip(strong, w) if x]


def train(docs: DataFrame, labels: DataFrame, keep=lambda i: F.lit(True), label: str = "toxic",
          max_train: int = MAX_TRAIN, max_features: int = MAX_FEATURES) -> dict[str, float]:
    """The model: feature -> weight, "" the bias. Empty without evidence."""
    def fit(batches):
        rows = pd.concat(list(batches) or [pd.DataFrame({"y": [], "text": []})])
        rows = rows.sort_values(["y", "text"])
        yield pd.DataFrame(fit_noisy_or(rows["text"].tolist(), rows["y"].astype(int).tolist(),
                                        max_features), columns=["feature", "weight"])
        del rows
        release_memory()
    rows = training_rows(docs, labels, label, keep, max_train).repartition(1)
    return {r["feature"]: r["weight"] for r in
            rows.mapInPandas(fit, "feature string, weight double").collect()}


class Scorer:
    def __init__(self, model: dict[str, float]):
        self.model, self.bias, self.known = model, model.get("", -np.inf), {}

    def weight(self, word: str) -> float:
        w = self.known.get(word)
        if w is None:
            if len(self.known) > _MEMORY:
                self.known.clear()
            get = self.model.get
            w = self.known[word] = get(word, 0.0) + sum(
                get(word[:k] + "*", 0.0) for k in PREFIXES if len(word) > k)
        return w

    def sentences(self, text: str):
        """(start, end, score) of the sentences that have words. Features
        count once in a sentence, as in training."""
        low = text.lower()
        if len(low) != len(text):       # few letters grow when lower-cased; keep the places right
            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
        for s in _SENTENCE.finditer(low):
            words = set(_WORD.findall(s[0]))
            if words:
                hits = [w for w in words if self.weight(w)]
                z = self.bias + sum(self.model.get(f, 0.0) for f in {
                    f for w in hits for f in word_features(w)})
                yield s.start(), s.end(), z

    def score(self, text: str | None) -> float:
        z = np.array([z for _, _, z in self.sentences(text or "")])
        return float(-np.expm1(-np.logaddexp(0, z).sum())) if len(z) else 0.0


def score(text: Column, model: dict[str, float]) -> Column:
    """The document's noisy-or score, 0 to 1."""
    @F.pandas_udf("double")
    def of(batches: "pd.Series") -> pd.Series:
        scorer = _scorer(model)
        scores = pd.Series([scorer.score(t) for t in batches], dtype="float64")
        release_memory()
        return scores
    return of(text)


def offending(text: Column, model: dict[str, float], least: float = 0.5) -> Column:
    """The sentences that score ``least`` or more: start and end in code
    points, score."""
    @F.pandas_udf("array<struct<start:long,end:long,score:double>>")
    def of(batches: pd.Series) -> pd.Series:
        scorer = _scorer(model)
        return pd.Series([[{"start": a, "end": b, "score": float(1 / (1 + np.exp(-z)))}
                           for a, b, z in scorer.sentences(t or "") if 1 / (1 + np.exp(-z)) >= least]
                          for t in batches])
    return of(text)


_LAST: list = [None, None]


def _scorer(model: dict[str, float]) -> Scorer:
    """One scorer per Python worker and model, so that words stay known over batches."""
    if _LAST[0] is not model and _LAST[0] != model:
        _LAST[:] = [model, Scorer(model)]
    return _LAST[1]

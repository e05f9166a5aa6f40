"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's emission score is linear in shape features
of the line and of its two neighbours; a transition matrix ties neighbouring
labels. The field is trained by conditional likelihood on document labels (all
lines of a training document carry its label). Forward-backward gives each
line's marginal, and the marginals weighted by line length give the
document's quality.

Training reads at most ``max_train`` labelled documents (half of each label,
chosen by a hash of the id) in one task; everything else runs over all rows.

Rules: null text is empty, and the empty text is one empty line, which is
scored like any line. A row is a document. Documents with several labels train
with the largest. Without labels of both kinds every score is 0.5.
"""

from __future__ import annotations

import json

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stategrid.llm.toxicity import training_rows

MAX_TRAIN = 3000
N_FEATURES = 12
#: Classes of UTF-8 bytes: 1 upper-case ASCII letter, 2 lower-case ASCII letter, 3 digit,
#: 4 common punctuation, 5 other ASCII sign, 6 white space, 7 start of a longer character.
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = 5
_CLASS[ord("A"):ord("Z") + 1] = 1
_CLASS[ord("a"):ord("z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[[ord(c) for c in ".,;:'\"-?"]] = 4
_CLASS[[9, 10, 11, 12, 13, 32]] = 6
_CLASS[0xC0:] = 7


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(features of each line and its neighbours, length of each line + 1)."""
    lines = text.encode("utf-8", "surrogatepass").split(b"\n")
    n = len(lines)
    flat = np.frombuffer(b"\n".join(lines) + b"\n", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, lines), np.int64, n) + 1)
    starts = ends - np.fromiter(map(len, lines), np.int64, n) - 1
    kind = _CLASS[flat]
    count = lambda k: np.add.reduceat((kind == k).astype(np.int32), starts)
    upper, lower, digit, mark, sign, blank, wide = (count(k) for k in range(1, 8))
    size = upper + lower + digit + mark + sign + wide
    letters = np.maximum(upper + lower + wide, 1)
    words = np.zeros((n, 3))
    for i, line in enumerate(lines):
        ws = line.split()
        if ws:
            words[i] = (len(ws), len(set(ws)), sum(map(bytes.__eq__, ws, ws[1:])))
    total = np.maximum(words[:, 0], 1)
    some = np.maximum(size, 1)
    x = np.zeros((n, N_FEATURES))
    x[:, 0] = upper / letters
    x[:, 1] = np.minimum(1, 4 * sign / some)
    x[:, 2] = digit / some
    x[:, 3] = mark / some * 4
    x[:, 4] = 1 - words[:, 1] / total
    x[:, 5] = words[:, 2] / total
    x[:, 6] = np.minimum(2, size / total / 8)
    x[:, 7] = np.log1p(size) / 8
    x[:, 8] = size == 0
    x[:, 9] = sign > 0
    x[:, 10] = (upper > 0.5 * letters) & (words[:, 0] > 1)
    x[:, 11] = (x[:, 4] > 0.4) & (words[:, 0] > 6)
    pad = np.zeros((1, N_FEATURES))
    full = np.hstack([x, np.vstack([pad, x[:-1]]), np.vstack([x[1:], pad]), np.ones((n, 1))])
    return full, (ends - starts).astype(np.float64)


def _forward_backward(e: np.ndarray, length: np.ndarray, trans: np.ndarray):
    """e: (sequences, steps) emission scores of "good" over "bad"; sequences
    sorted by falling length. Returns the marginals of "good" (same shape), the
    expected transitions per sequence (sequences, 2, 2) and log Z."""
    s, t = e.shape
    alive = np.array([(length > i).sum() for i in range(t)])
    emit = np.stack([np.zeros_like(e), e], 2)
    a = np.zeros((s, t, 2))
    a[:, 0] = emit[:, 0]
    for i in range(1, t):
        k = alive[i]
        p = a[:k, i - 1]
        a[:k, i, 0] = np.logaddexp(p[:, 0] + trans[0, 0], p[:, 1] + trans[1, 0])
        a[:k, i, 1] = np.logaddexp(p[:, 0] + trans[0, 1], p[:, 1] + trans[1, 1]) + e[:k, i]
    last = a[np.arange(s), length - 1]
    z = np.logaddexp(last[:, 0], last[:, 1])
    b = np.zeros((s, t, 2))
    pairs = np.zeros((s, 2, 2))
    for i in range(t - 1, 0, -1):
        k = alive[i]
        q = b[:k, i] + emit[:k, i]
        b[:k, i - 1, 0] = np.logaddexp(q[:, 0] + trans[0, 0], q[:, 1] + trans[0, 1])
        b[:k, i - 1, 1] = np.logaddexp(q[:, 0] + trans[1, 0], q[:, 1] + trans[1, 1])
        pairs[:k] += np.exp(a[:k, i - 1, :, None] + trans + q[:, None, :] - z[:k, None, None])
    with np.errstate(over="ignore"):
        marginal = np.exp(np.minimum(0, a[:, :, 1] + b[:, :, 1] - z[:, None]))
    return marginal, pairs, z


def _padded(parts: list[np.ndarray]):
    order = sorted(range(len(parts)), key=lambda i: (-len(parts[i]), i))
    length = np.array([len(parts[i]) for i in order])
    e = np.zeros((len(parts), length[0]))
    for r, i in enumerate(order):
        e[r, :length[r]] = parts[i]
    return order, length, e


def fit_field(texts, labels, steps: int = 120, rate: float = 0.1, ridge: float = 1e-3) -> dict:
    if len(set(labels)) < 2:
        return {}
    made = [line_features(t) for t in texts]
    order = sorted(range(len(texts)), key=lambda i: (-len(made[i][1]), i))
    length = np.array([len(made[i][1]) for i in order])
    y = np.array([labels[i] for i in order], np.float64)
    x = np.vstack([made[i][0] for i in order])
    weight = np.vstack([made[i][1][:, None] for i in order])[:, 0]
    row = np.repeat(np.arange(len(order)), length)
    step_of = np.concatenate([np.arange(n) for n in length])
    share = np.where(y > 0, 0.5 / y.sum(), 0.5 / (1 - y).sum())      # both labels count alike
    w, trans = np.zeros(x.shape[1]), np.zeros((2, 2))
    m, v = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    real = np.zeros((len(order), 2, 2))
    real[:, 0, 0], real[:, 1, 1] = (1 - y) * (length - 1), y * (length - 1)
    for t in range(1, steps + 1):
        e = np.zeros((len(order), length[0]))
        e[row, step_of] = x @ w
        marginal, pairs, _ = _forward_backward(e, length, trans)
        per = share / length
        g = (marginal[row, step_of] - y[row]) * per[row]
        gt = ((pairs - real) * per[:, None, None]).sum(0) + ridge * trans
        grad = np.concatenate([x.T @ g + ridge * w, gt.ravel()])
        m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
        move = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.99 ** t)) + 1e-9)
        w, trans = w - move[:-4], trans - move[-4:].reshape(2, 2)
    return {"w": w.tolist(), "trans": trans.tolist()}


def train(docs: DataFrame, labels: DataFrame, keep=lambda i: F.lit(True), label: str = "quality",
          max_train: int = MAX_TRAIN) -> dict:
    """The field: {"w": emission weights, "trans": transitions}; {} without evidence."""
    def fit(batches):
        rows = pd.concat(list(batches) or [pd.DataFrame({"y": [], "text": []})])
        rows = rows.sort_values(["y", "text"])
        yield pd.DataFrame({"model": [json.dumps(fit_field(
            rows["text"].tolist(), rows["y"].astype(int).tolist()))]})
    rows = training_rows(docs, labels, label, keep, max_train).repartition(1)
    return next((json.loads(r["model"]) for r in
                 rows.mapInPandas(fit, "model string").collect()), {})


_CELLS = 2_000_000


def marginals(texts: list[str], model: dict) -> list[tuple[np.ndarray, np.ndarray]]:
    """(marginal of "good" per line, line weights) of each text; texts go
    through forward-backward together as long as the padded table is small."""
    if not model:
        made = [line_features(t)[1] for t in texts]
        return [(np.full(len(n), 0.5), n) for n in made]
    w, trans = np.array(model["w"]), np.array(model["trans"])
    made = [line_features(t) for t in texts]
    out: list = [None] * len(texts)
    todo = sorted(range(len(texts)), key=lambda i: -len(made[i][1]))
    while todo:
        count = max(1, _CELLS // len(made[todo[0]][1]))
        part, todo = todo[:count], todo[count:]
        order, length, e = _padded([made[i][0] @ w for i in part])
        good, _, _ = _forward_backward(e, length, trans)
        for r, k in enumerate(order):
            out[part[k]] = (good[r, :length[r]], made[part[k]][1])
    return out


def score(text: Column, model: dict) -> Column:
    """The document's quality, 0 to 1: length-weighted mean marginal."""
    @F.pandas_udf("double")
    def of(batch: pd.Series) -> pd.Series:
        scores = []
        for at in range(0, len(batch), 256):
            texts = [t or "" for t in batch.iloc[at:at + 256]]
            scores += [float(np.clip((m * n).sum() / n.sum(), 0, 1))
                       for m, n in marginals(texts, model)]
        return pd.Series(scores, dtype="float64")
    return of(text)


def line_labels(text: Column, model: dict) -> Column:
    """Every line's marginal of "good", in order."""
    @F.pandas_udf("array<double>")
    def of(batch: pd.Series) -> pd.Series:
        return pd.Series([m.tolist() for t in batch for m, _ in marginals([t or ""], model)])
    return of(text)

"""Quality classifier: naive Bayes support vectors.

A document's features are n-gram indicators: its words, and runs of one to three
word shapes (case, ending, length, whether the word repeats the one before).
Each indicator is scaled by the log-ratio of its class counts; on these a linear
hinge-loss model is fitted by dual coordinate descent.  Margins become
probabilities by a logistic curve fitted to the margins of left-out rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import docs_of, list_array, release, stored, text_parts
from .sampling import labelled
from .textwords import Words, mix

FEATURES = 1 << 18
#: Rows of each class that the model is fitted on, about.
SAMPLE_ROWS = 3000
#: Features of these rows that come to the driver at most; beyond that rows are left out, those with the largest hash of doc_id first.
SAMPLE_FEATURES = 1 << 25


def _letter_table() -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[97:123], table[65:91], table[48:58], table[128:] = 1, 2, 3, 1
    return table


_TABLE = _letter_table()


def _shapes(words: Words) -> np.ndarray:
    """A number for each word's shape: case of its first and last letters, digits, last bytes that are no letters, length, repetition."""
    kind = _TABLE[words.data]
    start, end = words.start, words.end
    size = end - start
    upto = [np.concatenate([[0], np.cumsum(kind == k)]) for k in (0, 1, 2, 3)]
    other, low, up, digit = (u[end] - u[start] for u in upto)
    case = np.where(up == 0, 0, np.where(low > 0, np.where(kind[start] == 2, 1, 2), np.where(up > 1, 3, 4)))
    tail = np.zeros(len(start), np.int64)
    for k in range(1, 4):
        at = np.maximum(end - k, start)
        odd = (kind[at] == 0) & (size >= k)
        tail = tail * 257 + np.where(odd, words.data[at] + 1, 0)
    same = np.concatenate([[False], words.hash[1:] == words.hash[:-1]])
    first = np.cumsum(words.counts) - words.counts
    same[first[words.counts > 0]] = False
    return ((((tail * 5 + case) * 4 + np.minimum(digit, 3)) * 8 + np.minimum(size // 3, 7)) * 4 + np.minimum(other, 3)) * 2 + same


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct feature numbers of each text, one text after another, and each text's count.  Feature 0 is in every text."""
    words = Words(texts)
    doc = np.repeat(np.arange(len(texts)), words.counts)
    shape = mix(_shapes(words).astype(np.uint64) + np.uint64(1))
    keys = [np.arange(len(texts), dtype=np.int64) * FEATURES]
    gram = shape
    found = [(doc, words.hash), (doc, shape)]
    for n in range(1, 3):
        gram = mix(gram[:-1] * np.uint64(31) + shape[n:]) if len(gram) else gram
        inside = doc[n:] == doc[: len(doc) - n]
        found.append((doc[: len(gram)][inside], gram[inside]))
    for d, h in found:
        keys.append(d * FEATURES + 1 + (h % np.uint64(FEATURES - 1)).astype(np.int64))
    key = np.unique(np.concatenate(keys))
    return key % FEATURES, np.bincount(key // FEATURES, minlength=len(texts))


def hinge_dual(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: np.ndarray, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Weights of the linear model that minimises |w|^2 / 2 + the sum of cost * hinge loss, by dual coordinate descent.

    Row i has the value scale[j] at the features j in rows[i]; y is -1 or 1.
    """
    w = np.zeros(len(scale))
    alpha = np.zeros(len(rows))
    norm = np.array([float((scale[r] ** 2).sum()) for r in rows]) + 1e-12
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in rng.permutation(len(rows)).tolist():
            r = rows[i]
            x = scale[r]
            slope = y[i] * float(w[r] @ x) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), cost[i])
            if (step := new - alpha[i]) != 0.0:
                w[r] += step * y[i] * x  # a row's features are distinct
                alpha[i] = new
                moved = max(moved, abs(step) * norm[i])
        if moved < 1e-3:
            break
    return w


def logistic_1d(margin: np.ndarray, label: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """a, b of 1 / (1 + exp(-(a * margin + b))), by damped Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, h = (label - p) * weight, p * (1 - p) * weight
        grad = np.array([(g * margin).sum() - 0.01 * a, g.sum() - 0.01 * b])
        hess = np.array([[(h * margin**2).sum() + 0.01, (h * margin).sum()], [(h * margin).sum(), h.sum() + 0.01]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(1e-9, float(np.abs(step).max())))
        a, b = a + float(step[0]), b + float(step[1])
        if np.abs(step).max() < 1e-6:
            break
    return a, b


@dataclass
class QualityModel:
    weight: np.ndarray  # of each feature, with the log-count ratio multiplied in
    a: float
    b: float

    def score(self, texts: list[str | None]) -> np.ndarray:
        feats, counts = features(texts)
        margin = np.add.reduceat(self.weight[feats], np.cumsum(counts) - counts) if len(counts) else np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.a * margin + self.b, -30, 30)))


def fit_rows(rows: list[np.ndarray], label: np.ndarray, rates: tuple[float, float] = (1.0, 1.0)) -> QualityModel:
    """``rates``: the share of class 0 and 1 that the rows are a sample of."""
    if len(set(label.tolist())) < 2:
        return QualityModel(np.zeros(FEATURES), 0.0, 4.0 if len(label) and label[0] else 0.0 if not len(label) else -4.0)

    def train(pick: np.ndarray) -> np.ndarray:
        count = np.ones((2, FEATURES))
        for i in pick.tolist():
            count[int(label[i]), rows[i]] += 1
        count /= np.array([[max(1, int((label[pick] == k).sum())) + 2] for k in (0, 1)])
        ratio = np.log(count[1]) - np.log(count[0])
        ratio[0] = 1.0
        y = np.where(label[pick] == 1, 1.0, -1.0)
        each = np.where(y > 0, 1 / max(1, int((y > 0).sum())), 1 / max(1, int((y < 0).sum()))) * len(pick) / 2
        return hinge_dual([rows[i] for i in pick.tolist()], ratio, y, 0.1 * each) * ratio

    part = np.arange(len(rows)) % 4 == 3
    held = train(np.flatnonzero(~part))
    at = np.flatnonzero(part)
    margin = np.array([float(held[rows[i]].sum()) for i in at.tolist()])
    a, b = logistic_1d(margin, label[at].astype(float), np.where(label[at] == 1, 1 / rates[1], 1 / rates[0]) * min(rates))
    return QualityModel(train(np.arange(len(rows))), a, b)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Fits on about ``sample_rows`` labelled rows of each class, the curve at the classes' ratio in all labels.

    Rows with a null text or label are left out; without labels every score is 0.5.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_parts(batches):
            feats, counts = features(texts)
            yield pa.record_batch([part.column(0), part.column(2), list_array(feats.astype(np.int32), counts, pa.int32())], ["doc_id", "label", "features"])

    rows, rates = labelled(docs, labels, label, sample_rows)
    found = stored(rows.select("doc_id", "text", "label").mapInArrow(run, "doc_id long, label int, features array<int>"), "quality-sample")
    sizes = found.select("doc_id", F.xxhash64("doc_id").alias("h"), F.size("features").alias("n")).toArrow().sort_by("h")  # 2 * sample_rows rows, about
    fits = np.cumsum(sizes["n"].to_numpy()) <= SAMPLE_FEATURES
    if not fits.all():
        last = sizes["h"][max(0, int(fits.sum()) - 1)].as_py()
        found = found.where(F.xxhash64("doc_id") <= last)
    got = found.toArrow().sort_by("doc_id")  # SAMPLE_FEATURES numbers at most
    y = got["label"].to_numpy()
    model = fit_rows(list(_arrays(got["features"])), y, rates)
    release(found)
    return model


def _arrays(column: pa.ChunkedArray) -> Iterator[np.ndarray]:
    for chunk in column.chunks:
        flat, cuts = chunk.flatten().to_numpy(), chunk.offsets.to_numpy() - chunk.offsets[0].as_py()
        yield from np.split(flat, cuts[1:-1]) if len(chunk) else []


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """doc_id and score, the probability of label 1, of every whole text.

    Null and empty texts get the score of a text without words.  Repeated rows
    stay; other columns are left out.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_parts(batches):
            yield pa.record_batch([part.column(0), pa.array(sent.value.score(texts))], ["doc_id", "score"])

    return docs_of(docs).mapInArrow(run, "doc_id long, score double")

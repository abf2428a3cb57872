"""Document quality from a linear-chain conditional random field over lines."""

from __future__ import annotations

from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, fresh, lean, sized_batches
from tidemark.llm.ragged import steps
from tidemark.llm.sample import Adam, fit_line, labelled_sample, sigmoid

ACCEPT = 0.3
ROUNDS = 120
FIT_DOCS = 250
DECAY = 1e-3


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.uint8)
    table[list(chars)] = 1
    return table


UPPER = _class(bytes(range(65, 91)))
LOWER = _class(bytes(range(97, 123)) + bytes(range(128, 256)))
DIGIT = _class(b"0123456789")
STOP = _class(b".,;:'\"-()?")
PIPE, BANG = _class(b"|"), _class(b"!")
MARK = _class(b"#$%&*+/<=>@[\\]^_`{}~")
OWN = 13
FEATURES = OWN + 8


def line_features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, length of each line, number of lines of each document) of lines that are not blank.

    Features of a line: its shares of upper case, digits, marks, bars, exclamation and stops, its
    length, its words' length, how many of its words repeat (anywhere, and at once), whether the document holds it again;
    then the telling ones of the line before and the line after.
    """
    lines: list[bytes] = []
    counts = np.zeros(len(texts), np.int64)
    again: list[bool] = []
    for i, text in enumerate(texts):
        own = [x for x in (text or "").encode().split(b"\n") if x and not x.isspace()]
        counts[i] = len(own)
        lines += own
        if len(own) > 1:
            seen = {}
            for x in own:
                seen[x] = seen.get(x, 0) + 1
            again += [seen[x] > 1 for x in own]
        else:
            again += [False] * len(own)
    if not lines:
        return np.zeros((0, FEATURES), np.float32), np.zeros(0, np.int64), counts
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    data = np.frombuffer(b"".join(lines), np.uint8)
    starts = np.cumsum(lengths) - lengths

    def total(table: np.ndarray) -> np.ndarray:
        return np.add.reduceat(table[data], starts, dtype=np.int64)

    words = [x.split() for x in lines]
    n_words = np.fromiter(map(len, words), np.int64, len(lines))
    distinct = np.fromiter((len(set(w)) for w in words), np.int64, len(lines))
    upper, lower = total(UPPER), total(LOWER)
    solid = np.maximum(lengths - n_words + 1, 1)
    x = np.zeros((len(lines), FEATURES), np.float32)
    x[:, 0] = 1
    x[:, 1] = upper / np.maximum(upper + lower, 1)
    for column, table in enumerate((DIGIT, MARK, PIPE, BANG, STOP), 2):
        x[:, column] = np.minimum(1, 5 * total(table) / solid)
    x[:, 7] = np.log1p(n_words) / 5
    x[:, 8] = np.minimum(3, solid / n_words / 8)
    x[:, 9] = 1 - distinct / n_words
    x[:, 10] = again
    x[:, 11] = lengths < 20
    x[:, 12] = np.fromiter((sum(map(eq, w, w[1:])) for w in words), np.int64, len(lines)) / n_words
    first = np.cumsum(counts) - counts
    inner = np.ones(len(lines), bool)
    inner[first[counts > 0]] = False
    telling = x[:, [1, 3, 4, 5]] + x[:, 12:13]
    x[1:, OWN:OWN + 4] = telling[:-1] * inner[1:, None]
    x[:-1, OWN + 4:] = telling[1:] * inner[1:, None]
    return x, lengths, counts


def forward_backward(good: np.ndarray, trans: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """(chance that each line is good, expected transitions, sum of log normalisers).

    `good` is a line's score for being good against 0 for bad; `trans` adds to each pair of labels.
    """
    score = np.stack([np.zeros_like(good), good], axis=1)
    alpha, beta = score.copy(), np.zeros_like(score)
    order = list(steps(counts))
    for rows in order[1:]:
        alpha[rows] += np.logaddexp(alpha[rows - 1, :1] + trans[0], alpha[rows - 1, 1:] + trans[1])
    for rows in reversed(order[1:]):
        after = score[rows] + beta[rows]
        beta[rows - 1] = np.logaddexp(after[:, :1] + trans[:, 0], after[:, 1:] + trans[:, 1])
    both = alpha + beta
    z = np.logaddexp(both[:, 0], both[:, 1])
    pairs = np.zeros((2, 2))
    for rows in order[1:]:
        joint = alpha[rows - 1][:, :, None] + trans + (score[rows] + beta[rows])[:, None, :] - z[rows][:, None, None]
        pairs += np.exp(joint).sum(axis=0)
    heads = (np.cumsum(counts) - counts)[counts > 0]
    return sigmoid(both[:, 1] - both[:, 0]), pairs, float(z[heads].sum())


def document_quality(chance: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Mean chance of a document's lines, weighted by length; nan without lines."""
    owner = np.repeat(np.arange(len(counts)), counts)
    weight = np.bincount(owner, lengths, len(counts))
    good = np.bincount(owner, lengths * chance, len(counts))
    return np.where(weight > 0, good / np.maximum(weight, 1), np.nan)


class QualityModel:
    """Weights of the field, the curve from weighted marginals to a chance, and the base rate."""

    def __init__(self, weights: np.ndarray, trans: np.ndarray, curve: tuple[float, float], prior: float):
        self.weights, self.trans, self.curve, self.prior = weights, trans, curve, prior

    def raw(self, x: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
        chance, _, _ = forward_backward(x.astype(np.float64) @ self.weights, self.trans, counts)
        return document_quality(chance, lengths, counts)

    def score(self, texts: list[str | None]) -> np.ndarray:
        raw = self.raw(*line_features(texts))
        return np.where(np.isnan(raw), self.prior, sigmoid(self.curve[0] + self.curve[1] * np.nan_to_num(raw)))


def fit(texts: list[str], labels: np.ndarray) -> QualityModel:
    """Train on documents; every line takes its document's label.

    Without labels of both kinds the model gives the smoothed base rate to all documents.
    """
    labels = np.asarray(labels, np.float64)
    prior = float((labels.sum() + 1) / (len(labels) + 2))
    # The words of a few documents at a time: those of the whole sample would take some 200 MB of the driver.
    parts = [line_features(texts[i:i + FIT_DOCS]) for i in range(0, max(1, len(texts)), FIT_DOCS)]
    x, lengths, counts = (np.concatenate(p) for p in zip(*parts))
    x = x.astype(np.float64)
    if not len(x) or labels.min() == labels.max():
        flat = float(np.log(prior / (1 - prior)))
        return QualityModel(np.zeros(FEATURES), np.zeros((2, 2)), (flat, 0.0), prior)
    y = np.repeat(labels, counts)
    observed = np.zeros((2, 2))
    for rows in list(steps(counts))[1:]:
        np.add.at(observed, (y[rows - 1].astype(int), y[rows].astype(int)), 1)
    params = {"w": np.zeros(FEATURES), "t": np.zeros((2, 2))}
    adam = Adam(params, 0.1)
    for _ in range(ROUNDS):
        chance, pairs, _ = forward_backward(x @ params["w"], params["t"], counts)
        adam.step({"w": x.T @ (chance - y) / len(y) + DECAY * params["w"],
                   "t": (pairs - observed) / len(y) + DECAY * params["t"]})
    model = QualityModel(params["w"], params["t"], (0.0, 0.0), prior)
    raw = model.raw(x, lengths, counts)
    has = ~np.isnan(raw)
    model.curve = fit_line(raw[has], labels[has])
    return model


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> QualityModel:
    """Fit on the bounded sample of `labelled_sample`, brought to the driver."""
    rows = labelled_sample(docs, labels, label, key, text).orderBy("key").toArrow()
    return fit(rows.column("text").to_pylist(), np.array(rows.column("label").to_pylist(), np.float64))


def score_documents(docs: DataFrame, model: QualityModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for every row; one pass, no shuffle. Null, empty and blank texts get the base rate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, "text"):
            score = model.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(score, pa.float64())], ["key", "score"])

    rows = fresh(docs, key, text)
    return rows.mapInArrow(lean(run), f"key {rows.schema['key'].dataType.simpleString()}, score double")


def keep_good(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """Rows of `docs` whose score is at least `accept`, with all their columns."""
    model, hidden = train(docs, labels, key, text), free_name(docs, "quality_score")
    at = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, hidden):
            yield batch.filter(pa.array(model.score(batch.column(hidden).to_pylist()) >= accept)).select(range(batch.num_columns - 1))

    tagged = docs.withColumn(hidden, F.col(docs.columns[at]).cast("string"))
    return tagged.mapInArrow(lean(run), docs.schema)

"""Toxicity from a convolutional text classifier over hashed word embeddings."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import fresh, lean, lower_words, sized_batches
from tidemark.llm.sample import Adam, labelled_sample, sigmoid

BUCKETS = 1 << 15
DIM = 16
FILTERS = {1: 12, 2: 6, 3: 6}
PREFIXES = (4, 5)
STEPS = 500
BATCH = 64
DROP = 0.1
MIN_DOCS = 4
DECAY = 1e-4
RATE = 0.01
CACHE_WORDS = 500_000
STRIP = b".,;:!?\"'()[]|*#$%&"
# Frequent words by which a text's language is guessed.
COMMON_WORDS = {
    "en": b"the of and to in is that it for was on with as are by this from".split(),
    "de": "der die und das den von zu mit ist im nicht ein eine auf für sich".encode().split(),
    "fr": b"le la les des et est une un du que qui dans pour pas sur au".split(),
    "es": b"el la los las de que y en un una por con para se no del".split(),
}
LANGUAGES = (*COMMON_WORDS, "other")
CALIBRATION_SHARE = 5


def buckets(word: bytes) -> list[int]:
    """Hash buckets of the word and of its first letters, so that forms of one stem share weights."""
    word = word.strip(STRIP)
    return [zlib.crc32(word) % BUCKETS, *[zlib.crc32(word[:n], n) % BUCKETS for n in PREFIXES]]


class Words:
    """Numbers words as they are met; word 0 is padding."""

    def __init__(self):
        self.number: dict[bytes, int] = {}

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
        """(word numbers with padding after every text, start of every text, words met first)."""
        number, fresh_words, ids, starts, at = self.number, [], [], [], 0
        pad = max(FILTERS) - 1
        for text in texts:
            words = lower_words(text)
            for w in words:
                if w not in number:
                    number[w] = len(number) + 1
                    fresh_words.append(w)
            starts.append(at)
            at += len(words) + pad
            ids += [number[w] for w in words]
            ids += [0] * pad
        return np.array(ids, np.int64), np.array(starts, np.int64), fresh_words


def language_votes(words: list[bytes]) -> np.ndarray:
    """For each word, which languages count it as frequent."""
    votes = np.zeros((len(words), len(COMMON_WORDS)), np.float32)
    for row, word in enumerate(words):
        if len(word) < 6:
            word = word.strip(STRIP)
            for column, listed in enumerate(COMMON_WORDS.values()):
                votes[row, column] = word in listed
    return votes


def _languages(votes: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Number of the language with most frequent words; `other` where no such word is met."""
    sums = np.add.reduceat(votes[ids], starts, axis=0)
    return np.where(sums.max(axis=1) > 0, sums.argmax(axis=1), len(COMMON_WORDS))


class ToxicModel:
    def __init__(self, params: dict[str, np.ndarray], shift: np.ndarray, prior: float):
        self.params, self.shift, self.prior = params, shift, prior
        self._words: Words | None = None

    def __getstate__(self):
        return self.params, self.shift, self.prior

    def __setstate__(self, state):
        self.__init__(*state)

    def project(self, rows: np.ndarray) -> np.ndarray:
        """All filters' terms of words, one column block for each width and offset."""
        embedded = self.params["e"][rows].sum(axis=1)
        return np.concatenate([embedded @ self.params[f"f{k}"][j] for k in FILTERS for j in range(k)], axis=1).astype(np.float32)

    def pooled(self, table: np.ndarray, ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Largest response of every filter in every text; 0 if none is above 0."""
        parts, at = [], 0
        for k, n in FILTERS.items():
            total = table[ids, at:at + n]
            at += n
            for j in range(1, k):
                total[:-j] += table[ids[j:], at:at + n]
                at += n
            parts.append(np.maximum.reduceat(total, starts, axis=0) + self.params[f"b{k}"])
        return np.maximum(np.concatenate(parts, axis=1), 0)

    def logits(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(logit, language number) of every text."""
        if self._words is None or len(self._words.number) > CACHE_WORDS:
            self._words = Words()
            self._table = np.zeros((1 << 16, sum(k * n for k, n in FILTERS.items())), np.float32)
            self._votes = np.zeros((1 << 16, len(COMMON_WORDS)), np.float32)
        ids, starts, new = self._words.encode(texts)
        last = len(self._words.number) + 1
        while last > len(self._table):
            self._table = np.concatenate([self._table, np.zeros_like(self._table)])
            self._votes = np.concatenate([self._votes, np.zeros_like(self._votes)])
        if new:
            self._table[last - len(new):last] = self.project(np.array([buckets(w) for w in new], np.int32))
            self._votes[last - len(new):last] = language_votes(new)
        out = self.pooled(self._table, ids, starts) @ self.params["o"] + self.params["c"]
        return out, _languages(self._votes, ids, starts)

    def score(self, texts: list[str | None]) -> np.ndarray:
        """Chance of being toxic, shifted so that 0.5 is the threshold of the text's language."""
        if not texts:
            return np.zeros(0)
        if not self.params:
            return np.full(len(texts), self.prior)
        logit, language = self.logits(texts)
        return sigmoid(logit.astype(np.float64) - self.shift[language])


def _backward(params, rows, ids, starts, stops, y, weight):
    """Loss gradients of one batch; only the positions that won the pooling take part."""
    used, local = np.unique(ids, return_inverse=True)
    embedded = params["e"][rows[used]].sum(axis=1)
    embedded[used == 0] = 0
    grads = {k: DECAY * v for k, v in params.items() if k != "e"}
    pooled, wins = [], []
    for k, n in FILTERS.items():
        total = embedded @ params[f"f{k}"][0]
        total = total[local]
        for j in range(1, k):
            total[:-j] += (embedded @ params[f"f{k}"][j])[local[j:]]
        win = np.stack([a + total[a:b].argmax(axis=0) for a, b in zip(starts, stops)])
        pooled.append(np.take_along_axis(total, win, axis=0) + params[f"b{k}"])
        wins.append(win)
    hidden = np.concatenate(pooled, axis=1)
    active = np.maximum(hidden, 0)
    chance = sigmoid(active @ params["o"] + params["c"])
    delta = (chance - y) * weight / weight.sum()
    grads["o"] = grads["o"] + active.T @ delta
    grads["c"] = np.atleast_1d(delta.sum())
    back = delta[:, None] * params["o"] * (hidden > 0)
    touched, pushed, at = [], [], 0
    for (k, n), win in zip(FILTERS.items(), wins):
        part = back[:, at:at + n]
        at += n
        grads[f"b{k}"] = grads[f"b{k}"] + part.sum(axis=0)
        for j in range(k):
            word = local[np.minimum(win + j, len(local) - 1)]
            grads[f"f{k}"][j] += np.einsum("bn,bnd->dn", part, embedded[word])
            touched.append(used[word].ravel())
            pushed.append((part[:, :, None] * params[f"f{k}"][j].T[None]).reshape(-1, DIM))
    return grads, np.concatenate(touched), np.concatenate(pushed)


def fit(texts: list[str], labels: np.ndarray, seed: int = 7) -> ToxicModel:
    """Train on documents; one in CALIBRATION_SHARE is kept to set the threshold of each language.

    Without labels of both kinds the model gives the smoothed base rate to all documents.
    """
    labels = np.asarray(labels, np.float64)
    prior = float((labels.sum() + 1) / (len(labels) + 2))
    if not len(labels) or labels.min() == labels.max():
        return ToxicModel({}, np.zeros(len(LANGUAGES)), prior)
    rng = np.random.default_rng(seed)
    words = Words()
    ids, starts, met = words.encode(texts)
    stops = np.r_[starts[1:], len(ids)]
    rows = np.concatenate([np.zeros((1, 1 + len(PREFIXES)), np.int32), np.array([buckets(w) for w in met], np.int32).reshape(-1, 1 + len(PREFIXES))])
    params = {"e": rng.normal(0, 0.1, (BUCKETS, DIM)), "o": np.full(sum(FILTERS.values()), 0.5), "c": np.array([-2.0])}
    for k, n in FILTERS.items():
        params[f"f{k}"], params[f"b{k}"] = rng.normal(0, 0.3, (k, DIM, n)), np.zeros(n)
    # Buckets that few documents share would only be learnt by heart; they and unseen ones stay 0.
    owner = np.repeat(np.arange(len(labels)), stops - starts)[ids > 0]
    seen = [np.unique(owner * BUCKETS + rows[ids[ids > 0], i]) % BUCKETS for i in range(rows.shape[1])]
    live = sum(np.bincount(s, minlength=BUCKETS) for s in seen) >= MIN_DOCS
    params["e"][~live] = 0
    adam = Adam({k: v for k, v in params.items() if k != "e"}, RATE)
    squares = np.full(BUCKETS, 1e-6)
    aside = np.arange(len(labels)) % CALIBRATION_SHARE == 0
    learn = np.flatnonzero(~aside)
    done = 0
    while done < STEPS:
        for part in np.array_split(rng.permutation(learn), -(-len(learn) // BATCH)):
            done += 1
            chosen = np.concatenate([ids[starts[i]:stops[i]] for i in part])
            chosen = np.where(rng.random(len(chosen)) < DROP, 0, chosen)
            size = stops[part] - starts[part]
            first = np.cumsum(size) - size
            grads, touched, pushed = _backward(params, rows, chosen, first, first + size, labels[part], np.ones(len(part)))
            adam.step(grads)
            # A pattern may only speak for toxicity: else the many words of a long text drown a few.
            np.maximum(params["o"], 0, out=params["o"])
            touched, pushed = touched[real := touched > 0], pushed[real]
            where = rows[touched].ravel()
            push = np.repeat(pushed, rows.shape[1], axis=0) * live[where, None]
            np.add.at(squares, where, (push * push).mean(axis=1))
            np.add.at(params["e"], where, -0.05 * push / np.sqrt(squares[where])[:, None])
    model = ToxicModel({k: v.astype(np.float32) for k, v in params.items()}, np.zeros(len(LANGUAGES)), prior)
    logit, language = model.logits(texts)
    everywhere = _threshold(logit[aside], labels[aside])
    model.shift = np.array([
        _threshold(logit[own], labels[own], everywhere) if (own := aside & (language == i)).any() else everywhere
        for i in range(len(LANGUAGES))])
    return model


def _threshold(logit: np.ndarray, y: np.ndarray, otherwise: float = 0.0) -> float:
    """Middle of the gap at which the F1 score is highest; `otherwise` with fewer than five of a kind."""
    if min(y.sum(), len(y) - y.sum()) < 5:
        return otherwise
    order = np.argsort(-logit)
    hit = np.cumsum(y[order])
    f1 = 2 * hit / (np.arange(1, len(y) + 1) + y.sum())
    best = int(f1.argmax())
    ranked = logit[order]
    return float((ranked[best] + ranked[min(best + 1, len(y) - 1)]) / 2)


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> ToxicModel:
    """Fit on the bounded sample of `labelled_sample`, brought to the driver."""
    rows = labelled_sample(docs, labels, label, key, text).orderBy("key").toArrow()
    return fit(rows.column("text").to_pylist(), np.array(rows.column("label").to_pylist(), np.float64))


def score_documents(docs: DataFrame, model: ToxicModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) for every row; one pass over whole texts, no shuffle. Null and empty texts have no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sized_batches(batches, "text", 1 << 21):
            score = model.score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(score, pa.float64())], ["key", "score"])

    rows = fresh(docs, key, text)
    return rows.mapInArrow(lean(run), f"key {rows.schema['key'].dataType.simpleString()}, score double")

"""Operator 3: toxicity by subword-bag embeddings under a linear softmax, trained in numpy.

A word is the bag of its character n-grams (with word marks), each hashed to a row
of an embedding table; the bag's mean goes through a linear softmax of two
classes.  A document's logit pools the softmax margins of its distinct words by
log-sum-exp, so a single insult in a long text counts, and embeddings and
softmax are trained jointly against the document labels.  A misspelling shares
most n-grams, hence most of its vector, with the words seen in training.

The model is fitted on a bounded sample of labelled rows (about `sample_rows` of
each label, chosen by a hash of the id); from each of them the driver gets its
distinct words only.  Training is full-batch Adam from a fixed seed.

Defined results: a null text is the empty text; a text without words gets the
bias alone.  Without labels of both kinds every score is 0.5, predicted 1.  Repeated
rows get equal scores, rows of equal or null ids each their own.  Labels other than 0 and 1 and labels of unknown ids are
ignored.  An empty table gives an empty table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexweave.llm.common import append_columns
from lexweave.llm.quality import labelled_sample

#: Letters and digits, and signs that stand in for letters within a word or before it.
WORD = re.compile(r"[@$]?[^\W_]+(?:[@$!*#%&+|]+[^\W_]+)*")
SHORTEST, LONGEST = 3, 5
#: Longer runs of letters are split into windows of this size, which overlap by half or more.
WORD_CHARS = 80
#: Distinct words whose margins a worker remembers.
CACHE_WORDS = 400_000


def distinct_words(text: str | None) -> list[str]:
    words = dict.fromkeys(WORD.findall((text or "").lower()))
    if not words or max(map(len, words)) <= WORD_CHARS:
        return list(words)
    return list(dict.fromkeys(part for w in words for part in windows(w)))


def windows(word: str) -> list[str]:
    """The word, or overlapping windows that hold all n-grams of a long one."""
    if len(word) <= WORD_CHARS:
        return [word]
    last = len(word) - WORD_CHARS
    return [word[at : at + WORD_CHARS] for at in [*range(0, last, WORD_CHARS // 2), last]]


def grams(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of the embedding table of all words' character n-grams, the word each belongs to)."""
    points = np.frombuffer("".join([f"<{w}>" for w in words]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    sizes = np.array([len(w) + 2 for w in words], np.int64)
    owner = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
    room = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))  # characters up to the word's end
    rows, owners = [], []
    h = np.zeros(len(points), np.uint64)
    for n in range(1, LONGEST + 1):
        if n > 1 and len(points) >= n:
            h[: len(points) - n + 1] = h[: len(points) - n + 1] * np.uint64(0x100000001B3)
        h[: max(0, len(points) - n + 1)] += points[n - 1 :] + np.uint64(n)
        if n >= SHORTEST:
            at = np.flatnonzero(room >= n)
            mixed = h[at] * np.uint64(0x9E3779B97F4A7C15)
            rows.append(((mixed >> np.uint64(32)) % np.uint64(buckets)).astype(np.int32))
            owners.append(owner[at])
    return np.concatenate(rows), np.concatenate(owners)


@dataclass
class Model:
    """table: the embeddings; softmax: class weights by dimension; bias: the pooled margin's."""

    table: np.ndarray
    softmax: np.ndarray
    bias: float
    flat: bool = False
    _rows: np.ndarray | None = field(default=None, repr=False)
    _cache: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"table": self.table, "softmax": self.softmax, "bias": self.bias, "flat": self.flat, "_rows": None, "_cache": {}}

    def learn(self, words: set[str]) -> dict[str, float]:
        """The margins (class-1 minus class-0 logit) of remembered words, with these among them."""
        if self._rows is None:
            self._rows = self.table @ (self.softmax[:, 1] - self.softmax[:, 0])
        if len(self._cache) > CACHE_WORDS:
            self._cache.clear()
        new = [w for w in words if w not in self._cache]
        for at in range(0, len(new), 50_000):
            part = new[at : at + 50_000]
            rows, owner = grams(part, len(self.table))
            sums = np.bincount(owner, self._rows[rows], minlength=len(part))
            self._cache.update(zip(part, (sums / np.bincount(owner, minlength=len(part))).tolist()))
        return self._cache

    def margins(self, words: list[str]) -> np.ndarray:
        known = self.learn(set(words))
        return np.array([known[w] for w in words])

    def scores(self, texts: list[str | None]) -> list[float]:
        """One score a text."""
        if self.flat:
            return [0.5] * len(texts)
        out = []
        for at in range(0, len(texts), 512):
            docs = [set(distinct_words(t)) for t in texts[at : at + 512]]
            known = self.learn(set().union(*docs))
            for words in docs:
                m = np.array([0.0, *map(known.__getitem__, sorted(words))])
                top = m.max()
                out.append(self.bias + top + np.log(np.exp(m - top).sum()))
        return (1 / (1 + np.exp(-np.clip(out, -500, 500)))).tolist()


def train(docs: list[list[str]], y: np.ndarray, buckets: int = 1 << 16, size: int = 8, rounds: int = 70, rate: float = 0.15, ridge: float = 2e-5, seed: int = 11) -> Model:
    """Joint training of the embeddings and the softmax on documents given by their distinct words."""
    draw = np.random.default_rng(seed)
    table = draw.normal(0, 0.1, (buckets, size))
    softmax = np.zeros((size, 2))
    softmax[:, 1] = draw.normal(0, 0.3, size)
    if len(set(y.tolist())) < 2:
        return Model(table, softmax, 0.0, flat=True)
    number: dict[str, int] = {}
    flat_words = np.array([number.setdefault(w, len(number)) for d in docs for w in d], np.int64)
    counts = np.array([len(d) for d in docs])
    filled = np.flatnonzero(counts)
    begin = (np.cumsum(counts) - counts)[filled]
    rows, owner = grams(list(number), buckets)
    sizes = np.bincount(owner, minlength=len(number))
    used, slots = np.unique(rows, return_inverse=True)
    slots = slots.astype(np.int32)
    part = table[used]
    weight = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    bias = -4.0
    state = {k: [np.zeros_like(v), np.zeros_like(v)] for k, v in (("t", part), ("s", softmax), ("b", np.zeros(1)))}

    def adam(key: str, gradient: np.ndarray, step: int) -> np.ndarray:
        m, v = state[key]
        m += 0.1 * (gradient - m)
        v += 0.01 * (gradient * gradient - v)
        return rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)

    for step in range(1, rounds + 1):
        w = softmax[:, 1] - softmax[:, 0]
        margin = np.bincount(owner, (part @ w)[slots], minlength=len(sizes)) / sizes  # the bag's mean under the softmax
        each = margin[flat_words]
        top = np.zeros(len(docs))
        top[filled] = np.maximum(0.0, np.maximum.reduceat(each, begin))
        total = np.exp(-top)
        raised = np.exp(each - np.repeat(top, counts))
        total[filled] += np.add.reduceat(raised, begin)
        z = bias + top + np.log(total)
        error = weight * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
        to_words = np.bincount(flat_words, raised * np.repeat(error / total, counts), minlength=len(sizes))
        to_rows = np.bincount(slots, (to_words / sizes)[owner], minlength=len(used))
        to_softmax = part.T @ to_rows
        gradient = to_rows[:, None] * w[None, :]
        part -= adam("t", gradient + ridge * part / 10, step)
        softmax -= adam("s", np.stack([-to_softmax, to_softmax], axis=1) + ridge * softmax, step)
        bias -= float(adam("b", np.array([error.sum()]), step)[0])
    table = np.zeros((buckets, size), np.float32)
    table[used] = part
    return Model(table, softmax, bias)


def fit(df: DataFrame, labels: DataFrame, train_rows: Column, label: str = "toxic", text: str = "text", doc_id: str = "doc_id", sample_rows: int = 2000) -> Model:
    """Fits on labelled rows for which `train_rows` (an expression over __id) holds."""
    sample, _ = labelled_sample(df, labels, label, train_rows, sample_rows, doc_id, text)

    def run(texts: pa.Array) -> list[pa.Array]:
        return [pa.array([distinct_words(t) for t in texts.to_pylist()], pa.list_(pa.string()))]

    rows = append_columns(sample, run, "text", ["y"], [("words", T.ArrayType(T.StringType()), pa.list_(pa.string()))]).collect()
    rows = sorted((list(r.words), r.y) for r in rows)
    return train([r[0] for r in rows], np.array([r[1] for r in rows], np.float64))


def score(df: DataFrame, model: Model, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds score (double, 0 to 1)."""
    shared = df.sparkSession.sparkContext.broadcast(model)  # bounded: the embedding table's fixed size

    def run(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(shared.value.scores(texts.to_pylist()), pa.float64())]

    keep = [c for c in (keep if keep is not None else df.columns) if c != "score"]
    return append_columns(df, run, text, keep, [("score", T.DoubleType(), pa.float64())])

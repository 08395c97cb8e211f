"""Quality classifier: a factorisation machine over hashed words, statistics of a text's structure and its metadata.

Metadata are what a table keeps about a text beside it: its length in characters and the bytes that a character
takes. They are taken from the text itself, so that equal texts score alike whatever a row says of them.

y = w0 + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j. The pairs cost no more than the features
themselves, since they equal half of (sum v x)^2 - sum (v x)^2, factor by factor.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from duelframe.llm.common import Cache, id_crc, labelled_sample, texts_of

#: Documents of each label that the model learns from at most; a bounded sample.
SAMPLE = 2000
THRESHOLD = 0.3
BUCKETS = 1 << 14
FACTORS = 8
ROUNDS = 120
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
DIGITS = b"0123456789"
SYMBOLS = b"#*$%&|<>"
STATISTICS = ["one", "length", "symbols", "bars", "calls", "capitals", "digits", "echo", "variety", "word_length", "lines", "dup_lines", "others"]
METADATA = ["chars", "bytes_per_char"]


def statistics(text: str, words: list[bytes], raw: bytes, hashed: np.ndarray) -> list[float]:
    """Structure and metadata of a text as numbers from 0 to about 1; the same for the same text."""
    n, size = max(1, len(words)), max(1, len(raw))
    share = lambda drop: (len(raw) - len(raw.translate(None, drop))) / size
    lines = [x for x in raw.split(b"\n") if x]
    echo = float((hashed[1:] == hashed[:-1]).mean()) if len(hashed) > 1 else 0.0
    variety = len(set(words)) / n
    chars = max(1, len(text))
    return [
        1.0, np.log1p(len(words)) / 10, min(1.0, sum(raw.count(bytes([c])) for c in SYMBOLS) / n / 3), min(1.0, raw.count(b"|") / n), min(1.0, raw.count(b"!") / n / 2),
        share(CAPITALS), share(DIGITS), echo, variety, min(2.0, size / n / 10), min(1.0, len(lines) / n), 1 - len(set(lines)) / max(1, len(lines)),
        share(b".,;:?'\"()-"),
        np.log1p(len(text)) / 15, size / chars - 1,
    ]


def hashed_word(word: bytes) -> int:
    return zlib.crc32(word.lower()) % BUCKETS


def describe(text: str, cache: Cache) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features: shares of hashed words, then the statistics."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    hashed = np.fromiter(map(cache.__getitem__, words), np.int64, len(words))
    index, count = np.unique(hashed, return_counts=True)
    value = count / max(1, len(words))
    more = statistics(text, words, raw, hashed)
    return np.concatenate([index, BUCKETS + np.arange(len(more))]), np.concatenate([value, more])


@dataclass
class Model:
    w0: float
    w: np.ndarray
    v: np.ndarray

    def margin(self, index: np.ndarray, value: np.ndarray) -> float:
        """Linear time: the sum-of-squares identity stands for the pairs."""
        vx = self.v[index] * value[:, None]
        total = vx.sum(0)
        return float(self.w0 + self.w[index] @ value + 0.5 * (total @ total - (vx * vx).sum()))


def gradients(params, inner, value, owner, first, labels, weight) -> tuple[float, list[np.ndarray]]:
    """Loss, with a slight pull of all weights to zero, and its gradient by w0, w and v.

    Feature k has the weights of number inner[k], the value value[k], and belongs to text owner[k], whose features begin at
    first[owner[k]].
    """
    w0, w, v = params
    vx = v[inner] * value[:, None]
    total = np.add.reduceat(vx, first, axis=0)
    y = w0[0] + np.add.reduceat(w[inner] * value, first) + 0.5 * ((total**2).sum(1) - np.add.reduceat((vx * vx).sum(1), first))
    y = np.clip(y, -40, 40)
    loss = weight @ (np.logaddexp(0, y) - labels * y) + 0.5e-5 * ((w**2).sum() + (v**2).sum())
    g = (1 / (1 + np.exp(-y)) - labels) * weight
    gx = g[owner] * value
    gv = gx[:, None] * (total[owner] - vx)
    by_factor = [np.bincount(inner, gv[:, k], len(w)) for k in range(v.shape[1])]
    return float(loss), [np.array([g.sum()]), np.bincount(inner, gx, len(w)) + 1e-5 * w, np.stack(by_factor, 1) + 1e-5 * v]


def fit(sample: list[tuple[str, int]], rounds: int = ROUNDS, rate: float = 0.05, seed: int = 7) -> Model:
    """Logistic loss with both labels weighted alike, by gradient steps with momentum over the whole sample."""
    size = BUCKETS + len(STATISTICS) + len(METADATA)
    labels = np.array([y for _, y in sample], dtype=float)
    start = np.random.default_rng(seed).normal(0, 0.05, (size, FACTORS))
    if not len(sample) or labels.min() == labels.max():
        return Model(20.0 if len(sample) and labels.min() else -20.0 if len(sample) else 0.0, np.zeros(size), np.zeros((size, FACTORS)))
    cache = Cache(hashed_word)
    rows = [describe(t, cache) for t, _ in sample]
    index, value = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
    lengths = np.array([len(r[0]) for r in rows])
    owner, first = np.repeat(np.arange(len(rows)), lengths), np.concatenate([[0], np.cumsum(lengths)[:-1]])
    used, inner = np.unique(index, return_inverse=True)
    params = [np.zeros(1), np.zeros(len(used)), start[used]]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    weight = np.where(labels == 1, 0.5 / labels.sum(), 0.5 / (1 - labels).sum())
    for step in range(1, rounds + 1):
        grads = gradients(params, inner, value, owner, first, labels, weight)[1]
        for i, (p, d) in enumerate(zip(params, grads, strict=True)):
            m, s = moments[i]
            m, s = 0.9 * m + 0.1 * d, 0.99 * s + 0.01 * d * d
            moments[i] = (m, s)
            params[i] = p - rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.99**step)) + 1e-6)
    w, v = np.zeros(size), np.zeros((size, FACTORS))  # unseen words have no weight
    w[used], v[used] = params[1], params[2]
    return Model(float(params[0][0]), w, v)


def learn(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """A model from labelled documents whose crc32 of the id can't be divided by 5."""
    return fit(labelled_sample(documents, labels, "quality", most, lambda key: id_crc(key) % 5 != 0))


def score(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score (0 to 1, higher: better) and predicted for each row of `documents`.

    Null texts are empty; an empty text is scored by its statistics. Equal texts score alike; repeated
    rows are scored one by one; other columns are not read.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = Cache(hashed_word)
        for frame in frames:
            y = np.array([model.margin(*describe(x, cache)) for x in texts_of(frame["text"])])
            p = 1 / (1 + np.exp(-np.clip(y, -40, 40)))
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "score": p, "predicted": (p >= threshold).astype("int32")})

    return documents.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, score double, predicted int")

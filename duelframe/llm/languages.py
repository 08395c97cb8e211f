"""Language of texts by a linear-chain conditional random field over their words.

A word's features are its affixes, its n-grams and the lexicon of words that the learning sample has in one
language alone. Transitions between the labels of neighbouring words are learned from sequences that
switch between languages. Forward-backward gives each word its probability of each language, whatever
stands around it, so a text in several languages is labelled word by word; a document's language is the
one with the largest share of its words.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import CACHE_WORDS, bounded_sample, id_crc, texts_of

#: Documents of each language that the model learns from at most; a bounded sample.
SAMPLE = 200
UNKNOWN = "und"
BUCKETS = 1 << 16
#: Sequences and their words in one learning set; segments of one language in them have 3 to 16 words.
SEQUENCES, LENGTH = 3000, 32
ROUNDS = 40
#: A line is a chain of its own; longer ones are cut after so many words.
CHAIN = 256
#: Characters whose words are labelled at once.
BATCH = 2_000_000


def letters(token: str) -> str:
    """The token's letters in lower case; empty if it has none. Signs that stand for numbers, such as a half, are none."""
    return token.lower() if token.isalpha() else "".join(filter(str.isalpha, token)).lower()


def feature_table(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of two to four characters with the word's borders, and where each word's begin.

    Grams that hold a border are the word's affixes of one to three letters.
    """
    joined = np.frombuffer("".join(f"\x01{w}\x02\x02\x02" for w in words).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint32)
    size = np.array([len(w) for w in words])
    starts = np.concatenate([[0], np.cumsum(size + 4)[:-1]])
    at = np.repeat(starts - np.concatenate([[0], np.cumsum(size + 1)[:-1]]), size + 1) + np.arange(int((size + 1).sum()))  # border and letters
    a, b, c, d = joined[at], joined[at + 1], joined[at + 2], joined[at + 3]
    with np.errstate(over="ignore"):
        two = (a * np.uint32(0x9E3779B1) + b) * np.uint32(0x85EBCA6B)
        three = (two + c) * np.uint32(0xC2B2AE35)
        four = (three + d) * np.uint32(0x27D4EB2F)
    grams = np.stack([(x ^ (x >> np.uint32(15))) % np.uint32(BUCKETS) for x in (two, three ^ np.uint32(0x5BD1E995), four ^ np.uint32(0x1B873593))], 1)
    return grams.astype(np.int64), np.concatenate([[0], np.cumsum(size + 1)[:-1]])


@dataclass
class Model:
    """Weights by hashed gram and language, by lexicon language and language, and between neighbours."""

    labels: list[str]
    grams: np.ndarray
    lexicon: dict[str, int]
    lexical: np.ndarray
    transitions: np.ndarray

    def emissions(self, words: list[str]) -> np.ndarray:
        """Score of each word for each language."""
        if not words:
            return np.zeros((0, len(self.labels)), np.float32)
        grams, starts = feature_table(words)
        size = np.diff(starts, append=len(grams)) * 3
        scores = np.add.reduceat(self.grams[grams].sum(1), starts) / np.sqrt(size)[:, None]
        known = np.fromiter((self.lexicon.get(w, -1) for w in words), np.int64, len(words))
        return (scores + np.where(known[:, None] >= 0, self.lexical[known], 0)).astype(np.float32)


def passes(scores: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, ...]:
    """Forward and backward messages and potentials of chains that lie end to end in `scores`.

    Chains go side by side, longest first, so that a step treats the next word of all that are not over.
    """
    k = scores.shape[1]
    potential = np.exp(scores - scores.max(1, keepdims=True))
    move = np.exp(transitions - transitions.max()).astype(potential.dtype)
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    active = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")  # chains longer than t
    forward, backward = np.empty_like(potential), np.ones_like(potential)
    for t, n in enumerate(active):
        at = starts[:n] + t
        now = potential[at] if t == 0 else (forward[at - 1] @ move) * potential[at]
        forward[at] = now / now.sum(1, keepdims=True)
    for t in range(len(active) - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        now = (backward[at + 1] * potential[at + 1]) @ move.T
        backward[at] = now / now.sum(1, keepdims=True) * k
    return forward, backward, potential


def marginals(forward: np.ndarray, backward: np.ndarray) -> np.ndarray:
    """Each word's probability of each label."""
    both = forward * backward
    return both / both.sum(1, keepdims=True)


def sequences(texts: list[tuple[str, int]], n_labels: int, seed: int = 11) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Words, and word numbers and labels of SEQUENCES code-switched sequences of LENGTH words."""
    rng = np.random.default_rng(seed)
    index: dict[str, int] = {}
    own: list[list[np.ndarray]] = [[] for _ in range(n_labels)]
    for text, label in texts:
        words = [w for w in map(letters, text.split()) if w]
        if words:
            own[label].append(np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, len(words)))
    there = [i for i in range(n_labels) if own[i]]
    number, label = np.zeros((SEQUENCES, LENGTH), np.int64), np.zeros((SEQUENCES, LENGTH), np.int64)
    for row in range(SEQUENCES if there else 0):
        at, lang = 0, int(rng.choice(there))
        while at < LENGTH:
            words = own[lang][rng.integers(len(own[lang]))]
            first = int(rng.integers(len(words)))
            part = words[first : first + int(rng.integers(3, 17))][: LENGTH - at]
            number[row, at : at + len(part)], label[row, at : at + len(part)] = part, lang
            at += len(part)
            lang = int(rng.choice(there)) if rng.random() < 0.5 else lang
    return list(index), number, label


def fit(texts: list[tuple[str, str]], rounds: int = ROUNDS, rate: float = 0.1, seed: int = 11) -> Model:
    """Conditional likelihood of the labels of code-switched sequences, by gradient steps with momentum."""
    labels = sorted({lang for _, lang in texts})
    k = len(labels)
    grams, lexical, transitions = np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros((k, k))
    words, number, label = sequences([(t, labels.index(lang)) for t, lang in texts], k, seed)
    if k < 2 or not words:
        return Model(labels, grams, {}, lexical, transitions)
    counts = Counter((w, lang) for lang in range(k) for t, name in texts if name == labels[lang] for w in map(letters, t.split()) if w)
    total: Counter = Counter()
    for (w, _), n in counts.items():
        total[w] += n
    lexicon = {w: lang for (w, lang), n in counts.items() if n >= 3 and n == total[w]}
    table, starts = feature_table(words)
    size = np.diff(starts, append=len(table))
    owner, scale = np.repeat(np.arange(len(words)), size), 1 / np.sqrt(3 * size)
    lex = np.fromiter((lexicon.get(w, -1) for w in words), np.int64, len(words))
    flat, truth = number.ravel(), np.eye(k)[label.ravel()]
    lengths = np.full(len(number), LENGTH)
    inner = np.arange(len(flat)).reshape(number.shape)
    seen = np.einsum("np,nq->pq", truth[inner[:, :-1].ravel()], truth[inner[:, 1:].ravel()])
    params = [grams, lexical, transitions]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    rng = np.random.default_rng(seed)
    for step in range(1, rounds + 1):
        grams, lexical, transitions = params
        told = (lex[flat] >= 0) & (rng.random(len(flat)) < 0.5)  # the lexicon knows every sampled word, not every word
        scores = (np.add.reduceat(grams[table].sum(1), starts) * scale[:, None])[flat] + np.where(told[:, None], lexical[lex[flat]], 0)
        forward, backward, potential = passes(scores, lengths, transitions)
        p = marginals(forward, backward)
        miss = (p - truth) / len(number)
        by_word = np.stack([np.bincount(flat, miss[:, j], len(words)) for j in range(k)], 1) * scale[:, None]
        g_grams = np.zeros_like(grams)
        for j in range(k):
            g_grams[:, j] = np.bincount(table.ravel(), np.repeat(by_word[owner, j], 3), BUCKETS)
        g_lex = np.stack([np.bincount(lex[flat][told], miss[told, j], k) for j in range(k)], 1)
        left, right = inner[:, :-1].ravel(), inner[:, 1:].ravel()
        pair = forward[left][:, :, None] * np.exp(transitions)[None] * (potential[right] * backward[right])[:, None, :]
        pair /= pair.sum((1, 2), keepdims=True)
        g_move = (pair.sum(0) - seen) / len(number)
        for i, d in enumerate((g_grams + 1e-6 * grams, g_lex + 1e-4 * lexical, g_move + 1e-3 * transitions)):
            m, v = moments[i]
            m, v = 0.9 * m + 0.1 * d, 0.99 * v + 0.01 * d * d
            moments[i] = (m, v)
            params[i] = params[i] - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Model(labels, params[0].astype(np.float32), lexicon, params[1], params[2])


def learn(documents: DataFrame, most: int = SAMPLE) -> Model:
    """A model from documents with a language whose crc32 of the id leaves another remainder than 1 by 3."""
    rows = documents.select("doc_id", F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    chosen = bounded_sample(rows.where((id_crc() % 3 != 1) & F.col("doc_id").isNotNull()).select("doc_id", "lang"), "lang", most)
    found = rows.join(F.broadcast(chosen.distinct()), ["doc_id", "lang"]).collect()  # a bounded sample
    return fit([(r["text"], r["lang"]) for r in sorted(found, key=lambda r: (r["doc_id"], r["lang"], r["text"]))])


class Labeller:
    """Labels words of texts; remembers the scores of up to CACHE_WORDS tokens between batches."""

    def __init__(self, model: Model):
        self.model = model
        self.forget()

    def forget(self) -> None:
        self.index: dict[str, int] = {}
        self.scores = np.zeros((0, len(self.model.labels)), np.float32)
        self.filled = np.zeros(0, bool)

    def label(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of all words with letters, end to end, and each word's text."""
        if len(self.index) > CACHE_WORDS:
            self.forget()
        index, numbers, cut, owner = self.index, [], [], []
        for i, text in enumerate(texts):
            for line in text.split("\n"):
                tokens = line.split()
                if tokens:
                    numbers.append(np.fromiter((index.setdefault(t, len(index)) for t in tokens), np.int64, len(tokens)))
                    owner.append(i)
        fresh = [letters(t) for t in list(index)[len(self.filled) :]]
        some = np.array([bool(w) for w in fresh], bool)
        scores = np.zeros((len(fresh), self.scores.shape[1]), np.float32)
        scores[some] = self.model.emissions([w for w in fresh if w])
        self.scores, self.filled = np.concatenate([self.scores, scores]), np.concatenate([self.filled, some])
        if not numbers:
            return np.zeros((0, self.scores.shape[1])), np.zeros(0, np.int64)
        number = np.concatenate(numbers)
        line = np.repeat(np.arange(len(numbers)), [len(x) for x in numbers])
        keep = self.filled[number]
        number, line = number[keep], line[keep]
        size = np.bincount(line, minlength=len(numbers))
        place = np.arange(len(line)) - np.repeat(np.cumsum(size) - size, size)
        _, lengths = np.unique(line * (1 + place.max(initial=0) // CHAIN) + place // CHAIN, return_counts=True)
        forward, backward, _ = passes(self.scores[number], lengths, self.model.transitions)
        return marginals(forward, backward), np.array(owner)[line]


def predict_texts(labeller: Labeller, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and its share of the words of each text."""
    k = len(labeller.model.labels)
    if not k:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    p, owner = labeller.label(texts)
    share = np.stack([np.bincount(owner, p[:, j], len(texts)) for j in range(k)], 1)
    n = np.bincount(owner, minlength=len(texts))
    best = share.argmax(1)
    langs = [labeller.model.labels[b] if c else UNKNOWN for b, c in zip(best, n, strict=True)]
    return langs, [float(min(1.0, share[i, b] / c)) if c else 0.0 for i, (b, c) in enumerate(zip(best, n, strict=True))]


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score for each row of `documents`; ties go to the first language by name.

    Null texts and texts without a letter are `und` with score 0, as are all texts if nothing could be learned.
    Equal texts get equal answers; repeated rows are labelled one by one; other columns are not read.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        labeller = Labeller(model)
        for frame in frames:
            texts, langs, scores, first, size = texts_of(frame["text"]), [], [], 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size >= BATCH or i == len(texts) - 1:
                    found = predict_texts(labeller, texts[first : i + 1])
                    langs, scores, first, size = langs + found[0], scores + found[1], i + 1, 0
            yield pd.DataFrame({"doc_id": frame["doc_id"].to_numpy(), "lang_pred": langs, "score": scores})

    return documents.select("doc_id", "text").mapInPandas(run, f"doc_id {kind}, lang_pred string, score double")

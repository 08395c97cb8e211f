"""Toxicity by multiple-instance learning: document labels train a model of sentences.

A sentence's score comes from its words and their beginnings. The document's score is the noisy-or of its
sentences: it is toxic unless every sentence is clean. Only documents carry labels; the gradient of the
noisy-or hands them down to the sentences that explain them, so the model also tells which sentences
offend.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelframe.llm.common import Cache, id_crc, labelled_sample, texts_of

#: Documents of each label that the model learns from at most; a bounded sample.
SAMPLE = 2000
THRESHOLD = 0.3
#: A sentence with at least this score is reported.
SENTENCE_THRESHOLD = 0.5
ROUNDS = 400
#: How much more the weights of short beginnings are pulled to 0: clean words share them.
PULL = {3: 6.0, 4: 2.0}
_ENDS = (".", "!", "?")
_STRIP = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def features(token: str) -> list[tuple[int, str]]:
    """A word without marks around it (0, word), and its first three to six letters (n, letters); none for bare marks."""
    word = token.strip(_STRIP).lower()
    return [(0, word), *((n, word[:n]) for n in range(3, 7) if len(word) >= n)] if word else []


def tokens_of(text: str) -> list[str]:
    """Words parted by blanks; each line break is a token of its own, which ends a sentence."""
    return text.replace("\n", " \n ").split(" ")


def ends(token: str) -> bool:
    return token == "\n" or token.rstrip("%*#$&")[-1:] in _ENDS


@dataclass
class Model:
    """Weights by kind of feature: 0 for whole words, n for the first n letters. All weights are positive."""

    weights: dict[int, dict[str, float]]
    bias: float

    def coded(self, token: str) -> float:
        """The token's weight, plus 1000 if it ends a sentence and 10000 if it is no word."""
        if not token:
            return 10000.0
        word = token.strip(_STRIP).lower()
        weight = sum(found.get(word[:n] if n else word, 0.0) for n, found in self.weights.items()) if word else 0.0
        if token == "\n":
            return 11000.0
        return min(weight, 500.0) + (1000.0 if ends(token) else 0.0)


def evidence(toxic: int, clean: int, n_toxic: float, n: int) -> float:
    """G statistic of a feature that `toxic` of `n_toxic` and `clean` of the other texts have; 0 if clean ones have it more often."""
    n_clean, both = n - n_toxic, toxic + clean
    if toxic * n_clean <= clean * n_toxic:
        return 0.0
    seen = [(toxic, both * n_toxic / n), (clean, both * n_clean / n), (n_toxic - toxic, (n - both) * n_toxic / n), (n_clean - clean, (n - both) * n_clean / n)]
    return 2 * sum(o * np.log(o / e) for o, e in seen if o > 0 and e > 0)


def fit(sample: list[tuple[str, int]], rounds: int = ROUNDS, rate: float = 0.1, shrink: float = 2e-3) -> Model:
    """Noisy-or likelihood of the labels, by gradient steps with momentum and a pull of small weights to 0.

    Only features take part that toxic documents have more often than others, by a G statistic
    that chance hardly reaches in that many features; noise in long texts would pass for evidence otherwise. A noisy-or adds
    evidence for and none against, so weights don't fall below 0. A sample without both labels gives a
    constant score.
    """
    sample = sorted(sample, key=lambda x: -x[1])  # toxic ones first: they name the features that may count
    labels = np.array([y for _, y in sample], dtype=float)
    if not len(sample) or labels.min() == labels.max():
        return Model({0: {}}, 20.0 if len(sample) and labels.min() else -20.0)
    index: dict[str, int] = {}
    known: dict[tuple[int, str], int] = {}
    closes, pairs_w, pairs_f, words, sentence, owner, base = array("b"), array("i"), array("i"), [], [], [], 0
    for d, (text, label) in enumerate(sample):
        tokens = [t for t in tokens_of(text) if t]
        for t in dict.fromkeys(tokens):
            if t not in index:
                closes.append(ends(t))
                ids = [known.setdefault(f, len(known)) if label else known[f] for f in features(t) if label or f in known]
                pairs_w.extend([len(index)] * len(ids))
                pairs_f.extend(ids)
                index[t] = len(index)
        own = np.fromiter(map(index.__getitem__, tokens), np.int32, len(tokens))
        place = np.concatenate([[0], np.cumsum(np.frombuffer(closes, "b")[own], dtype=np.int32)[:-1]]) if len(own) else np.zeros(0, np.int32)
        n = int(place[-1]) + 1 if len(own) else 0
        words.append(own)
        sentence.append((place + base).astype(np.int32))
        owner.append(np.full(n, d, np.int32))
        base += n
    pw, pf = np.array(pairs_w), np.array(pairs_f)
    word, sent, own = np.concatenate(words), np.concatenate(sentence), np.concatenate(owner)
    n_words, n_docs = len(index), len(sample)
    # In how many texts of each label a feature occurs.
    seen = np.unique(np.repeat(np.arange(n_docs), [len(x) for x in words]) * n_words + word)
    del words, sentence, owner, pairs_w, pairs_f
    first_of, many_of = np.searchsorted(pw, np.arange(n_words)), np.bincount(pw, minlength=n_words)
    toxic, clean = np.zeros(len(known)), np.zeros(len(known))
    for part in np.array_split(seen, np.searchsorted(seen // n_words, np.arange(200, n_docs, 200))):  # 200 texts at a time
        first, many = first_of[part % n_words], many_of[part % n_words]
        at = np.repeat(first - (np.cumsum(many) - many), many) + np.arange(many.sum())
        in_texts = np.unique(np.repeat(part // n_words, many) * (len(known) + 1) + pf[at])
        text_label, feature = labels[in_texts // (len(known) + 1)], in_texts % (len(known) + 1)
        toxic += np.bincount(feature, text_label, len(known))
        clean += np.bincount(feature, 1 - text_label, len(known))
    least = 2 * np.log(len(known) + 1)
    chosen = [f for f in np.flatnonzero(toxic >= 3) if evidence(toxic[f], clean[f], labels.sum(), len(labels)) >= least]
    # From here on only chosen features and the words that have them.
    every = list(known)
    names = [every[f] for f in chosen]
    number = np.full(len(known) + 1, -1)
    number[chosen] = np.arange(len(chosen))
    pw, pf = pw[number[pf] >= 0], number[pf][number[pf] >= 0]
    told = np.isin(word, pw)
    word, sent = word[told], sent[told]
    pull = np.array([PULL.get(n, 1.0) for n, _ in names])
    theta, bias = np.zeros(len(names)), -4.0
    m, v, mb, vb = np.zeros_like(theta), np.zeros_like(theta), 0.0, 0.0
    weight = np.where(labels == 1, 0.1 / labels.sum(), 0.9 / (1 - labels).sum())  # about as rare as they are
    for step in range(1, rounds + 1):
        value = np.bincount(pw, theta[pf], n_words)
        z = bias + np.bincount(sent, value[word], base)
        spread = np.logaddexp(0, z)
        total = np.bincount(own, spread, n_docs)
        odds = 1 / np.expm1(np.clip(total, 1e-9, 50))  # (1 - P) / P
        g = np.where(labels == 1, -odds, 1.0) * weight
        gz = g[own] * (1 - np.exp(-spread))
        gt = np.bincount(pf, np.bincount(word, gz[sent], n_words)[pw], len(theta)) + 1e-5 * theta
        gb = gz.sum()
        m, v = 0.9 * m + 0.1 * gt, 0.99 * v + 0.01 * gt * gt
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        a, b = 1 - 0.9**step, 1 - 0.99**step
        theta -= rate * (m / a) / (np.sqrt(v / b) + 1e-6)
        theta = np.maximum(0, theta - shrink * pull)
        bias -= rate * (mb / a) / (np.sqrt(vb / b) + 1e-6)
    weights: dict[int, dict[str, float]] = {}
    for i, (n, name) in enumerate(names):
        if theta[i] > 1e-3:
            weights.setdefault(n, {})[name] = float(theta[i])
    return Model(weights, float(bias))


def learn(documents: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Model:
    """A model from labelled documents whose crc32 of the id leaves another remainder than 2 by 4."""
    return fit(labelled_sample(documents, labels, "toxic", most, lambda key: id_crc(key) % 4 != 2))


def score_text(text: str, cache: Cache, bias: float) -> tuple[float, int, list[tuple[int, int, float]]]:
    """The text's score, its number of sentences, and (first character, end, score) of those that offend."""
    tokens = tokens_of(text)
    code = np.fromiter(map(cache.__getitem__, tokens), float, len(tokens))
    blank = code >= 9000
    code = code - 10000 * blank
    closed = code >= 900
    value = code - 1000 * closed
    place = np.concatenate([[0], np.cumsum(closed)[:-1]])
    n = int(place[-1]) + 1
    filled = np.bincount(place, ~blank, n) > 0  # has a word
    z = np.bincount(place, value, n) + bias
    spread = np.where(filled, np.logaddexp(0, z), 0)
    score = float(-np.expm1(-spread.sum()))
    spans = []
    bad = np.flatnonzero(filled & (z >= np.log(SENTENCE_THRESHOLD / (1 - SENTENCE_THRESHOLD))))
    if len(bad):
        full = np.fromiter(map(len, tokens), np.int64, len(tokens))
        breaks = blank & closed
        begin = np.concatenate([[0], np.cumsum(full + 1)[:-1]]) - 2 * np.concatenate([[0], np.cumsum(breaks)[:-1]]) - breaks
        for s in bad:
            inside = np.flatnonzero((place == s) & ~blank)
            spans.append((int(begin[inside[0]]), int(begin[inside[-1]] + full[inside[-1]]), float(1 / (1 + np.exp(-z[s])))))
    return score, int(filled.sum()), spans


def score(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, score, predicted, n_sentences and the offending sentences' spans for each row of `documents`.

    Null and empty texts have no sentence and score 0. Equal texts score alike, whatever their id or source;
    repeated rows are scored one by one; other columns are not read.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = Cache(model.coded)
        for frame in frames:
            rows = [score_text(x, cache, model.bias) for x in texts_of(frame["text"])]
            yield pd.DataFrame({
                "doc_id": frame["doc_id"], "score": [r[0] for r in rows], "predicted": pd.Series([int(r[0] >= threshold) for r in rows], dtype="int32", index=frame.index),
                "n_sentences": [r[1] for r in rows], "offending": [[{"start": a, "end": b, "score": p} for a, b, p in r[2]] for r in rows],
            })

    schema = f"doc_id {kind}, score double, predicted int, n_sentences long, offending array<struct<start long, end long, score double>>"
    return documents.select("doc_id", F.col("text")).mapInPandas(run, schema)


def keep(documents: DataFrame, model: Model, threshold: float) -> DataFrame:
    """The rows of `documents` that score below `threshold`, with all their columns."""

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        cache = Cache(model.coded)
        for texts in batches:
            yield pd.Series([score_text(x, cache, model.bias)[0] for x in texts_of(texts)], dtype="float64")

    rows = documents.select(F.struct(*documents.columns).alias("d"), scores("text").alias("score"))
    return rows.where(F.col("score") < threshold).select("d.*")

"""The factorisation machine and multiple-instance learning."""

from __future__ import annotations

import itertools
import zlib

import numpy as np

from duelframe.llm import factorisation, toxicity
from duelframe.llm.common import Cache, bounded_sample, discard, labelled_sample, ship, stored
from duelframe.llm.queries import QUERIES
from tests.llm.rows import CLASHES, LONG, PROSE, ROWS, edges, nothing

MEDIUM = "/root/testdata/sf0.01"


def held_out(spark, name: str, label: str, parts: int, rest: int) -> list[tuple[float, int, int]]:
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{MEDIUM}/labels.parquet").collect()}
    rows = QUERIES[name](spark, MEDIUM).collect()
    assert len(rows) == spark.read.parquet(f"{MEDIUM}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % parts == rest) for r in rows)
    return [(r["score"], r["predicted"], truth[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in truth]


def test_quality_of_held_out_documents(spark):
    found = held_out(spark, "op7_factorisation", "quality", 5, 0)
    assert sum(p == y for _, p, y in found) / len(found) > 0.95


def test_toxicity_of_held_out_documents(spark):
    found = held_out(spark, "op9_multiple_instance", "toxic", 4, 2)
    assert sum(p == y for _, p, y in found) / len(found) > 0.93


def test_sum_of_squares_stands_for_all_pairs():
    rng = np.random.default_rng(3)
    model = factorisation.Model(0.3, rng.normal(size=50), rng.normal(size=(50, 4)))
    index, value = np.array([1, 7, 30, 49]), np.array([0.5, 1.0, 0.2, 2.0])
    pairs = sum(model.v[i] @ model.v[j] * a * b for (i, a), (j, b) in itertools.combinations(zip(index, value, strict=True), 2))
    assert np.isclose(model.margin(index, value), 0.3 + model.w[index] @ value + pairs)


def test_gradients_are_those_of_finite_differences():
    rng = np.random.default_rng(4)
    lengths = np.array([3, 1, 4])
    inner, value = rng.integers(0, 6, 8), rng.normal(size=8)
    owner, first = np.repeat(np.arange(3), lengths), np.array([0, 3, 4])
    labels, weight = np.array([1.0, 0.0, 1.0]), np.array([0.2, 0.5, 0.3])
    params = [rng.normal(size=1), rng.normal(size=6), rng.normal(size=(6, 3))]
    of = lambda: factorisation.gradients(params, inner, value, owner, first, labels, weight)
    for p, d in zip(params, of()[1], strict=True):
        for i in np.ndindex(p.shape):
            kept, step = p[i], 1e-6
            p[i] = kept + step
            above = of()[0]
            p[i] = kept - step
            below = of()[0]
            p[i] = kept
            assert np.isclose((above - below) / (2 * step), d[i], atol=1e-7)


def test_metadata_come_from_the_text():
    cache = Cache(factorisation.hashed_word)
    meta = lambda text: factorisation.describe(text, cache)[1][-2:]
    assert np.allclose(meta("ab"), [np.log1p(2) / 15, 0]) and np.allclose(meta("日本"), [np.log1p(2) / 15, 2]) and np.allclose(meta(""), [0, 0])


def test_factorisation_learns_an_interaction():
    """Two words are good together or apart from both, bad alone: no linear score can tell."""
    texts = [("alpha beta", 1), ("alpha gamma", 0), ("delta beta", 0), ("delta gamma", 1)] * 10
    model, cache = factorisation.fit(texts, rounds=400), Cache(factorisation.hashed_word)
    assert all((model.margin(*factorisation.describe(t, cache)) > 0) == bool(y) for t, y in texts[:4])


def test_noisy_or_over_sentences_and_spans():
    model = toxicity.Model({0: {"bad": 9.0, "odd": 4.0}}, -5.0)
    text = "A good day. What a bad,\nbad thing! Odd? Fine"
    score, n, spans = toxicity.score_text(text, Cache(model.coded), model.bias)
    margins = [-5.0, 4.0, 4.0, -1.0, -5.0]
    assert n == 5 and np.isclose(score, 1 - np.prod([1 / (1 + np.exp(z)) for z in margins]))
    assert [text[a:b] for a, b, _ in spans] == ["What a bad,", "bad thing!"]
    assert toxicity.score_text("", Cache(model.coded), model.bias) == (0.0, 0, [])
    assert toxicity.score_text(" \n \n", Cache(model.coded), model.bias) == (0.0, 0, [])


def test_labels_of_documents_find_the_sentences():
    clean = ["the sun is up.", "we walk along the river.", "dinner was good.", "trains are late again.", "he reads a book."]
    sample = []
    for i in range(60):
        body = [clean[(i + j) % 5] for j in range(4)]
        sample.append((" ".join(body), 0))
        sample.append((" ".join([*body[:2], f"you are a zorg{i % 20}.", *body[2:]]), 1))
    model = toxicity.fit(sample)
    text = "the sun is up. you are a zorgnew. dinner was good."
    score, _, spans = toxicity.score_text(text, Cache(model.coded), model.bias)
    assert score > 0.5 and [text[a:b] for a, b, _ in spans] == ["you are a zorgnew."]
    assert toxicity.score_text("the sun is up. dinner was good.", Cache(model.coded), model.bias)[0] < 0.3


def test_edge_rows(spark):
    ship(spark)
    docs = edges(spark)
    tox = toxicity.fit([(PROSE, 0), ("you foul zorg.", 1)] * 5)
    good = factorisation.fit([(PROSE, 1), ("### $$$ ###", 0)] * 5)
    for rows in (toxicity.score(docs, tox).collect(), factorisation.score(docs, good).collect()):
        assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] in (1, 2)}) == 1  # null as empty
    assert toxicity.score(nothing(spark), tox).count() == 0 and factorisation.score(nothing(spark), good).count() == 0
    kept = toxicity.keep(docs, tox, 2.0)
    assert kept.columns == docs.columns and kept.count() == len(ROWS) and all(r[c] == f"clash {c}" for r in kept.collect() for c in CLASHES)
    assert len(LONG) == max(r["n_chars"] or 0 for r in kept.collect())


def test_samples_are_bounded_and_labels_settled(spark):
    ship(spark)
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(500)] + [(None, "no id"), (3, "text 3")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(1, 0), (None, 1), (9, None), (9999, 1)], "doc_id long, quality int")
    found = labelled_sample(docs, labels, "quality", 50, lambda key: rules_true())
    assert 90 <= len(found) <= 100 and all(int(t.split()[1]) % 2 == y for t, y in found)
    assert labelled_sample(docs, labels.limit(0), "quality", 50, lambda key: rules_true()) == []
    few = bounded_sample(labels.select("doc_id", "quality"), "quality", 10_000)
    assert few.count() == labels.where("quality IS NOT NULL").count()
    assert toxicity.learn(docs, labels.withColumnRenamed("quality", "toxic").limit(0)).bias < -10
    assert factorisation.learn(nothing(spark), labels).w0 == 0.0


def test_stored_tables_can_be_discarded(spark):
    from pathlib import Path

    frame = stored(spark.range(3), "numbers")
    folder = Path(frame.inputFiles()[0].removeprefix("file://")).parents[1]
    assert frame.count() == 3 and folder.exists()
    discard(spark)
    assert not folder.exists()


def rules_true():
    from pyspark.sql import functions as F

    return F.lit(True)

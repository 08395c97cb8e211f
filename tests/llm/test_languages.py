from __future__ import annotations

import itertools
import zlib

import numpy as np

from duelframe.llm import languages
from duelframe.llm.common import ship
from duelframe.llm.queries import op4_crf_language
from tests.llm.rows import edges, nothing

EN = "the old house stands near the river and the children play with their dogs in the morning while their mother is working"
DE = "das alte haus steht nahe dem fluss und die kinder spielen mit ihren hunden am morgen während ihre mutter arbeitet"


def test_forward_backward_as_by_enumeration():
    rng = np.random.default_rng(5)
    scores, moves, lengths = rng.normal(size=(9, 3)), rng.normal(size=(3, 3)), np.array([4, 1, 4])
    forward, backward, _ = languages.passes(scores, lengths, moves)
    found, at = languages.marginals(forward, backward), 0
    for n in lengths:
        total = np.zeros((n, 3))
        for path in itertools.product(range(3), repeat=int(n)):
            weight = np.exp(sum(scores[at + i, y] for i, y in enumerate(path)) + sum(moves[a, b] for a, b in itertools.pairwise(path)))
            for i, y in enumerate(path):
                total[i, y] += weight
        assert np.allclose(found[at : at + n], total / total.sum(1, keepdims=True))
        at += n


def test_words_of_a_switching_line_get_their_own_language():
    model = languages.fit([(EN, "en"), (DE, "de")] * 3)
    line = " ".join(EN.split()[:8] + DE.split()[:8])
    p, owner = languages.Labeller(model).label([line, "", "12 !"])
    assert [model.labels[i] for i in p.argmax(1)] == ["en"] * 8 + ["de"] * 8 and set(owner) == {0}


def test_chains_may_be_cut_and_caches_forgotten(monkeypatch):
    model = languages.fit([(EN, "en"), (DE, "de")] * 3)
    text = (EN + " ") * 40
    monkeypatch.setattr(languages, "CACHE_WORDS", 3)
    labeller = languages.Labeller(model)
    assert [languages.predict_texts(labeller, [text, DE])[0] for _ in range(3)] == [["en", "de"]] * 3


def test_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op4_crf_language(spark, folder).collect()
    assert len(rows) == len(truth) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) / len(held) > 0.97


def test_edge_rows(spark):
    ship(spark)
    docs = edges(spark)
    model = languages.learn(docs)
    rows = languages.predict(docs, model).collect()
    assert len(rows) == docs.count()
    assert {r["doc_id"]: r["lang_pred"] for r in rows if r["doc_id"] in (1, 2, 3, 7)} == dict.fromkeys((1, 2, 3, 7), "und")
    assert languages.predict(nothing(spark), languages.learn(nothing(spark))).count() == 0
    assert {r["lang_pred"] for r in languages.predict(docs, languages.learn(nothing(spark))).collect()} == {"und"}


def test_signs_that_stand_for_numbers_are_no_letters(spark):
    ship(spark)
    docs = spark.createDataFrame([(i, f"{EN} {i}" if i % 2 else f"{DE} {i}", "en" if i % 2 else "de") for i in range(300)], "doc_id long, text string, lang string")
    texts = ["²", "½ 12", "①", "Ⅷ", "12 % — ٣", "_ _", "² x", "ª"]
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in languages.predict(asked, languages.learn(docs)).collect()}
    assert {texts[i] for i, (lang, _) in found.items() if lang == "und"} == {x for x in texts if not any(map(str.isalpha, x))}
    assert all(score == 0 for lang, score in found.values() if lang == "und")

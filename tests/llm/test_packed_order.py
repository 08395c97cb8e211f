from __future__ import annotations

import random
from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from duelframe.llm import packing
from duelframe.llm.common import in_stored_order, ship
from tests.llm.rows import ROWS, edges
from tests.llm.test_packing import check, tokenizer  # noqa: F401

#: Source: documents and words in each; lengths differ, so that an order by length shows.
SOURCES = {"long": (400, 2500), "short": (6000, 40), "some": (100, 700)}


@pytest.fixture(scope="module")
def packed(spark, tmp_path_factory):
    """The stored mix of documents of three sources, and its pieces with their sources."""
    rng, words = random.Random(8), "one two three four five six seven eight nine ten red blue tree house".split()
    rows = [(s, " ".join(rng.choices(words, k=k))) for s, (n, k) in SOURCES.items() for _ in range(n)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, text, "en", s, len(text)) for i, (s, text) in enumerate(rows)], "doc_id long, text string, lang string, source string, n_chars long")
    path = str(tmp_path_factory.mktemp("mixed") / "out")
    corpus_pipeline.mixed(spark, docs, "").write.parquet(path)
    mixed = spark.read.parquet(path)
    return mixed, corpus_pipeline.packed(spark, mixed, "").collect(), {i: s for i, (s, _) in enumerate(rows)}


def test_prefixes_of_sequences_hold_each_sources_share(packed):
    _, pieces, source = packed
    tokens: dict = defaultdict(Counter)
    for p in pieces:
        tokens[p["sequence_id"]][source[p["doc_id"]]] += p["length"]
    whole, total = sum(tokens.values(), Counter()), sum(p["length"] for p in pieces)
    so_far: Counter = Counter()
    for i, sequence in enumerate(sorted(tokens), 1):
        so_far += tokens[sequence]
        if i * 2048 > total / 10:
            n = sum(so_far.values())
            for s in SOURCES:
                assert abs(so_far[s] - n * whole[s] / total) < 0.02 * total, (i, s)


def test_epochs_tell_copies_apart_and_are_spread(packed):
    mixed, pieces, _ = packed
    copies = Counter(r["doc_id"] for r in mixed.select("doc_id").collect())
    assert max(copies.values()) > 1
    assert len({(p["doc_id"], p["epoch"], p["start"]) for p in pieces}) == len(pieces)
    first = {(p["doc_id"], p["epoch"]): p["sequence_id"] for p in pieces if p["start"] == 0}
    assert Counter(d for d, _ in first) == copies and all((d, n - 1) in first for d, n in copies.items())
    last = max(p["sequence_id"] for p in pieces)
    for (doc, epoch), sequence in first.items():
        if epoch:
            assert sequence - first[doc, epoch - 1] > last / 10


def test_rows_are_numbered_as_they_were_written(spark, tmp_path):
    path = str(tmp_path / "out")
    sizes = [10, 5000, 300, 40, 2000]  # readers take large files first
    frame = spark.createDataFrame([(i, "x" * sizes[i % 5]) for i in range(400)], "n long, text string").repartitionByRange(7, "n").sortWithinPartitions("n")
    frame.write.parquet(path)
    assert all(r["n"] == r["at"] for r in in_stored_order(spark.read.parquet(path), "at").collect())


def test_edge_rows_in_an_order_come_back_whole(spark, tokenizer):  # noqa: F811
    ship(spark)
    expected = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [packing.END_ID]) for r in ROWS]
    check(packing.pack(in_stored_order(edges(spark), "nth"), window=96, grain=8, order="nth"), expected, 96)

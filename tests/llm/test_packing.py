from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from duelframe.llm import packing
from duelframe.llm.common import ship, vocabulary_file
from tests.llm.rows import ROWS, edges, nothing


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(vocabulary_file(packing.VOCABULARY))


def check(pieces, expected: list[list[int]], window: int) -> None:
    """Every document's ids come back whole, and all sequences are gapless, and full or as long as a power of two."""
    rows = pieces.collect()
    by_sequence = defaultdict(list)
    for r in rows:
        assert r["length"] > 0 and len(r["ids"]) == 4 * r["length"]
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at == window or (at < window and at & (at - 1) == 0)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    # Pieces of rows with one id are matched by what they hold: each expected list is found once.
    left = defaultdict(list)
    for r in rows:
        left[r["doc_id"]].append((r["start"], r["length"], r["doc_tokens"], np.frombuffer(r["ids"], "<u4").tolist()))
    total = 0
    for doc, ids in expected:
        at = 0
        while at < len(ids):
            found = next(p for p in left[doc] if p[0] == at and p[2] == len(ids) and p[3] == ids[at : at + p[1]])
            left[doc].remove(found)
            at += found[1]
        total += len(ids)
    assert not any(left.values()) and total == sum(r["length"] for r in rows)


def test_edge_rows_come_back_whole(spark, tokenizer):
    ship(spark)
    expected = [(r[0], tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [packing.END_ID]) for r in ROWS]
    check(packing.pack(edges(spark)), expected, packing.WINDOW)
    check(packing.pack(edges(spark), window=96, grain=8), expected, 96)


def test_small_table_round_trip(spark, tokenizer):
    ship(spark)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    expected = [(r["doc_id"], tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [packing.END_ID]) for r in docs.collect()]
    check(packing.pack(docs), expected, packing.WINDOW)


def test_empty_table_gives_no_piece(spark):
    ship(spark)
    assert packing.pack(nothing(spark)).count() == 0


def test_words_between_blanks_have_the_texts_ids(tokenizer):
    words, kind = packing.word_encoder(vocabulary_file(packing.VOCABULARY))
    for text in ["don't we'll I'M it's", "a<|endoftext|>b", "x́é é", "１２3 ab12 4.5", "\x1c a\x85b c\xa0d", "ΟΔΥΣΣΕΥΣ σς ß İ", "tab\tword\rcr", "  ", "Él, ÑANDÚ!! (été);"]:
        ids = np.frombuffer(b"".join(map(words.__getitem__, text.replace("\n", " ").split(" "))), kind).tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids


def test_combinations_fill_the_window():
    found = packing.combinations(20)
    assert len(found) == len(set(found)) and all(sum(w) == 20 and min(w) > 0 and list(w) == sorted(w, reverse=True) for w in found)
    assert {w for w in found if len(w) == 2} == {(a, 20 - a) for a in range(10, 20)}


def test_nnls_is_optimal_and_plan_keeps_to_the_histogram():
    rng = random.Random(3)
    steps = 24
    histogram = {i: rng.randrange(0, 500) for i in range(steps)}
    ways = packing.combinations(steps)
    a = np.array([[w.count(i) for w in ways] for i in range(steps)], dtype=float)
    h = np.array([histogram[i] for i in range(steps)], dtype=float) / 500
    x = packing.nnls(a[1:], h[1:], 20000)
    slope = a[1:].T @ (a[1:] @ x - h[1:])
    assert (x >= 0).all() and slope.min() > -1e-3 and np.abs(slope[x > 1e-3]).max(initial=0) < 1e-3
    used = [0] * steps
    for way, n in packing.plan(histogram, steps):
        for length in way:
            used[length] += n
    assert all(u <= histogram[i] for i, u in enumerate(used)) and sum(used) > 0.8 * sum(histogram.values())
